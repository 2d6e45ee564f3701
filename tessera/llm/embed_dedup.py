"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2 t) of each other, in
every orthogonal projection too.  Vectors are projected on their leading
principal dimensions (moments over all vectors), sorted by the grid cells of
width eps along those dimensions, and cut in that order into blocks.  A block
and a run of blocks know the box around their projections.  Runs are joined
first, then the blocks of the runs that remain; boxes farther apart than eps are
skipped at both steps.  What is left is compared block by block in double
precision.  A comparison writes link counts per vector and a spanning tree of
its links, never the links themselves.

Equal vectors are one node with a weight, named by a 64-bit hash, so a vector
that is copied often is compared once.

Edge cases: a vector that is null, zero, or holds null or non-finite components
links with nothing and is its own component; vectors of different lengths never
link; repeated rows count as vectors of their own; a null vec_id stays, and
names no component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.components import components

BLOCK, RUN, DIMS = 4096, 16, 4


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def principal_dimensions(nodes: DataFrame, size: int, dims: int = DIMS) -> np.ndarray:
    """The leading eigenvectors of the unit vectors' covariance.  Tasks add up
    moments; size x size sums reach the driver."""
    def moments(batches):
        total = np.zeros((size + 1, size + 1))
        for pdf in batches:
            if len(pdf):
                x = _matrix(pdf["v"])
                x = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((len(x), 1))])
                total += x.T @ x
        yield pd.DataFrame({"k": np.arange(total.size), "s": total.ravel()})

    got = nodes.select("v").mapInPandas(moments, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).toPandas()
    m = np.zeros((size + 1) ** 2)
    m[got["k"].to_numpy()] = got["s"].to_numpy()
    m = m.reshape(size + 1, size + 1)
    n = max(m[-1, -1], 1.0)
    mean = m[:-1, -1] / n
    _, vectors = np.linalg.eigh(m[:-1, :-1] / n - np.outer(mean, mean))
    return vectors[:, ::-1][:, :dims]


def _grid_blocks(nodes: DataFrame, basis: np.ndarray, eps: float, block: int) -> DataFrame:
    """Nodes in grid order, one row per block: its box, and its vectors as bytes."""
    dims = basis.shape[1]
    cells, places = [f"c{i}" for i in range(dims)], [f"p{i}" for i in range(dims)]

    def project(batches):
        for pdf in batches:
            if len(pdf):
                x = _matrix(pdf["v"])
                p = x @ basis / np.linalg.norm(x, axis=1, keepdims=True)
                out = pdf[["node", "weight", "v"]].copy()
                for i in range(dims):
                    out[cells[i]], out[places[i]] = np.floor(p[:, i] / eps).astype(np.int64), p[:, i]
                yield out

    schema = "node long, weight long, v array<float>, " + ", ".join(f"{c} long, {p} double" for c, p in zip(cells, places))
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*cells, *places, "node"]
    placed = nodes.mapInPandas(project, schema).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("part", F.spark_partition_id())

    def pack(batches):
        rest, n = None, 0

        def row(pdf, part):
            p = pdf[places].to_numpy()
            return {"block": (part << 32) + n, "run": (part << 32) + n // RUN, "lo": p.min(0), "hi": p.max(0), "size": len(pdf),
                    "nodes": pdf["node"].to_numpy(np.int64).tobytes(), "weights": pdf["weight"].to_numpy(np.int64).tobytes(),
                    "vectors": np.stack(pdf["v"].to_list()).astype(np.float32).tobytes()}

        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            while len(rest) >= block:
                yield pd.DataFrame([row(rest.iloc[:block], int(rest["part"].iloc[0]))])
                rest, n = rest.iloc[block:], n + 1
        if rest is not None and len(rest):
            yield pd.DataFrame([row(rest, int(rest["part"].iloc[0]))])

    return placed.mapInPandas(pack, "block long, run long, lo array<double>, hi array<double>, size long, nodes binary, "
                                    "weights binary, vectors binary")


def _close(eps: float):
    """Whether two boxes are within eps: squared gaps over the dimensions."""
    gaps = F.zip_with(F.zip_with("lo", "hi_2", lambda a, b: a - b), F.zip_with("lo_2", "hi", lambda a, b: a - b),
                      lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= (eps + 1e-9) ** 2


def _near_boxes(boxes: DataFrame, key: str, eps: float) -> DataFrame:
    """Pairs key <= key_2 of boxes within eps, met on cells of the first dimension."""
    cell = lambda c: F.floor(F.element_at(c, 1) / eps)
    one = boxes.select(key, "lo", "hi", F.explode(F.sequence(cell("lo"), cell("hi"))).alias("cell"))
    two = boxes.select(*[F.col(c).alias(f"{c}_2") for c in (key, "lo", "hi")], F.explode(F.sequence(cell("lo") - 1, cell("hi") + 1)).alias("cell"))
    return one.join(two, "cell").where((F.col(key) <= F.col(f"{key}_2")) & _close(eps)).select(key, f"{key}_2").distinct()


def _compare(size: int, threshold: float):
    """Task: link counts (b null) and spanning edges of pairs of blocks."""

    def unpack(row, side: str):
        x = np.frombuffer(row[f"vectors{side}"], np.float32).reshape(-1, size).astype(np.float64)
        return x, np.linalg.norm(x, axis=1), np.frombuffer(row[f"nodes{side}"], np.int64), np.frombuffer(row[f"weights{side}"], np.int64)

    def run(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                x, nx, ids_x, w_x = unpack(row, "")
                y, ny, ids_y, w_y = unpack(row, "_2")
                same = row["block"] == row["block_2"]
                count_x, count_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
                up = list(range(len(x) + len(y)))
                edges: list[tuple[int, int]] = []

                def root(a):
                    while up[a] != a:
                        up[a] = up[up[a]]
                        a = up[a]
                    return a

                for at in range(0, len(x), 512):
                    cos = (x[at:at + 512] @ y.T) / (nx[at:at + 512, None] * ny[None])
                    hit = cos >= threshold
                    if same:
                        hit[np.arange(len(hit)), at + np.arange(len(hit))] = False
                    if not hit.any():
                        continue
                    count_x[at:at + 512] += hit @ w_y
                    if not same:
                        count_y += w_x[at:at + 512] @ hit
                    for i in np.flatnonzero(hit.any(1)):
                        cols = np.flatnonzero(hit[i])
                        a = root(at + int(i))
                        for j in cols.tolist():
                            b = root(j if same else len(x) + j)
                            if a != b:
                                up[max(a, b)] = min(a, b)
                                a = min(a, b)
                                edges.append((int(ids_x[at + i]), int(ids_y[j])))
                rows = [(int(ids_x[i]), None, int(count_x[i])) for i in np.flatnonzero(count_x)]
                rows += [(int(ids_y[i]), None, int(count_y[i])) for i in np.flatnonzero(count_y)]
                rows += [(a, b, 0) for a, b in edges]
                a, b, links = zip(*rows) if rows else ((), (), ())
                # built as integers: a column of None and hashes would pass through doubles
                yield pd.DataFrame({"a": pd.array(a, "Int64"), "b": pd.array(b, "Int64"), "links": pd.array(links, "Int64")})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    eps = float(np.sqrt(2 - 2 * threshold))
    v = F.col("embedding").cast("array<float>")
    good = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = staged(vectors.select("vec_id", F.when(good, v).alias("v")).withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "embed-rows")
    nodes = staged(rows.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("weight"), F.first("v").alias("v")), "embed-nodes")
    found = None
    for size in [r["d"] for r in nodes.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()]:
        own = nodes.where(F.size("v") == size)
        blocks = staged(_grid_blocks(own, principal_dimensions(own, size), eps, block), "embed-blocks")
        boxes = blocks.select("block", "run", "lo", "hi")
        least = [F.array(*[F.min(F.element_at("lo", i + 1)) for i in range(min(DIMS, size))]).alias("lo"),
                 F.array(*[F.max(F.element_at("hi", i + 1)) for i in range(min(DIMS, size))]).alias("hi")]
        runs = _near_boxes(boxes.groupBy("run").agg(*least), "run", eps)
        other = boxes.select(*[F.col(c).alias(f"{c}_2") for c in boxes.columns])
        close = runs.join(boxes, "run").join(other, "run_2").where((F.col("run") < F.col("run_2")) | (F.col("block") <= F.col("block_2")))
        close = close.where(_close(eps)).select("block", "block_2")
        data = blocks.select("block", "nodes", "weights", "vectors")
        work = close.join(data, "block").join(data.select(*[F.col(c).alias(f"{c}_2") for c in data.columns]), "block_2")
        parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        made = work.repartition(4 * parts, "block", "block_2").mapInPandas(_compare(size, threshold), "a long, b long, links long")
        found = made if found is None else found.unionByName(made)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = staged(found, "embed-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(found.where("b IS NOT NULL").select("a", "b"))
    known = nodes.select("node", "weight").join(counts, "node", "left").join(classes, "node", "left") \
        .select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    linked = rows.select("vec_id", "node").where("node IS NOT NULL").join(known, "node")
    least = linked.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    linked = linked.join(least, "component").select("vec_id", "n_links", "component_id")
    alone = rows.where("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
