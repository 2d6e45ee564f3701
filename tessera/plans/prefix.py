"""Distributed prefix scan: running sums / row numbers without a hot task.

``Window.partitionBy(g).orderBy(o)`` sorts a whole group inside one task,
and ``row_number()`` with no partition pulls the whole table into one.  When
one key may hold a third of all rows, neither survives.  This plan:

1. range-partitions on ``(group..., order...)`` (one shuffle; a hot group is
   split across many partitions) and sorts within partitions;
2. computes the *local* running value per group inside each partition with
   ``mapInArrow`` (numpy over Arrow batches, restarted at each group; whole
   numbers stay 64-bit integers) and writes the rows once into the shared
   folder, so that the range bounds, which are sampled, are drawn once;
3. reads one stats row per partition from that table (first group, last group,
   the last group's local total) - size bounded by the partition count;
4. turns the stats into per-partition offsets with a window over that tiny
   table, and adds them back with a broadcast join on the partition id
   (broadcast size = number of partitions, a proven bound).

The order columns must be a total order (add an id tie-break).
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _local_scan_fn(group_cols: list[str], value_col: str, op: str = "sum"):
    def seg_scan(v, new):
        g = pd.Series(v).groupby(np.cumsum(new))  # starts anew in each group: neighbours can't disturb it
        return {"sum": g.cumsum, "min": g.cummin, "max": g.cummax}[op]().to_numpy()

    def combine(local, carry):
        if op == "sum":
            return local + carry
        return np.minimum(local, carry) if op == "min" else np.maximum(local, carry)

    def run(batches):
        carry_key = None
        carry_sum = 0
        pos = 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            v = np.asarray(batch.column(value_col).to_numpy(zero_copy_only=False))
            keys = [np.asarray(batch.column(g).to_numpy(zero_copy_only=False), dtype=object) for g in group_cols]
            new = np.zeros(n, dtype=bool)
            new[0] = True
            for k in keys:
                if n > 1:
                    new[1:] |= k[1:] != k[:-1]
            first_key = tuple(k[0] for k in keys)
            seg = np.cumsum(new) - 1
            local = seg_scan(v, new)
            if carry_key is not None and first_key == carry_key:
                local[seg == 0] = combine(local[seg == 0], carry_sum)
            carry_key = tuple(k[-1] for k in keys)
            carry_sum = local[-1]
            positions = np.arange(pos, pos + n, dtype=np.int64)
            pos += n
            yield batch.append_column("_pos", pa.array(positions)).append_column("_local", pa.array(local))
    return run


def prefix_scan(df: DataFrame, group_cols, order_cols, value_col: str | None = None,
                out_col: str = "running", num_partitions: int | None = None,
                integral: bool = True, op: str = "sum", materialize: bool = False) -> DataFrame:
    """Inclusive running ``op`` (sum | min | max) of ``value_col`` (1 per row
    when None) per group.

    ``group_cols`` may be empty (one global sequence, e.g. global row numbers).
    A null value adds nothing.  Range partitioning samples its input in
    a separate job; pass ``materialize=True`` when the input is expensive to
    recompute (it is checkpointed into the shared folder first).
    """
    from tessera.session import scratch_path
    if materialize:
        from tessera.session import cut_lineage
        df = cut_lineage(df)
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    grp = group_cols if group_cols else ["_g"]
    base = df if group_cols else df.withColumn("_g", F.lit(0))
    whole = value_col is None or (op == "sum" and isinstance(df.schema[value_col].dataType, T.IntegralType))
    kind = T.LongType() if whole else T.DoubleType()
    value = F.lit(1) if value_col is None else F.col(value_col)
    if op == "sum":
        value = F.coalesce(value, F.lit(0))
    base = base.withColumn("_v", value.cast(kind))
    ranged = (base.repartitionByRange(n, *[F.col(c) for c in grp + order_cols])
              .sortWithinPartitions(*grp, *order_cols)
              .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField("_pos", T.LongType()),
                                                  T.StructField("_local", kind)])
    path = scratch_path(spark, f"prefix-{uuid.uuid4().hex}")
    ranged.mapInArrow(_local_scan_fn(grp, "_v", op), schema).write.parquet(path)
    local = spark.read.schema(schema).parquet(path)
    key = F.struct(*[F.col(c) for c in grp])
    stats = (local.groupBy("_pid").agg(
        F.min_by(key, F.col("_pos")).alias("first_key"),
        F.max_by(key, F.col("_pos")).alias("last_key"),
        F.max_by(F.col("_local"), F.col("_pos")).alias("last_total")))
    w_same = Window.partitionBy("last_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.orderBy("_pid")
    agg = {"sum": F.sum, "min": F.min, "max": F.max}[op]
    # the stats table has one row per partition: these windows are tiny
    offsets = (stats.withColumn("cum_same", agg("last_total").over(w_same))
               .withColumn("prev_last", F.lag("last_key").over(w_all))
               .withColumn("prev_cum", F.lag("cum_same").over(w_all))
               .select("_pid", "first_key",
                       F.when(F.col("prev_last").eqNullSafe(F.col("first_key")), F.col("prev_cum")).alias("_offset")))
    joined = local.join(F.broadcast(offsets), "_pid")
    carried = F.when(key.eqNullSafe(F.col("first_key")), F.col("_offset"))
    if op == "sum":
        total = F.col("_local") + F.coalesce(carried, F.lit(0).cast(kind))
    else:
        f = F.least if op == "min" else F.greatest
        total = f(F.col("_local"), F.coalesce(carried, F.col("_local")))
    res = joined.withColumn(out_col, F.round(total).cast("bigint") if integral else total.cast("double"))
    drop = ["_v", "_pid", "_pos", "_local", "first_key", "_offset"] + ([] if group_cols else ["_g"])
    return res.drop(*drop)


def row_numbers(df: DataFrame, group_cols, order_cols, out_col: str = "rn",
                num_partitions: int | None = None, materialize: bool = False) -> DataFrame:
    """1-based row number per group in ``order_cols`` order, skew-safe."""
    return prefix_scan(df, group_cols, order_cols, None, out_col, num_partitions, integral=True,
                       materialize=materialize)


def _local_scans_fn(group_cols: list[str], specs: dict[str, tuple[str, str]]):
    """Per spec: ``_i_<out>``, the scan up to and with the row, and ``_b_<out>``, before it."""
    def run(batches):
        carry_key, carry, pos = None, {}, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            keys = [np.asarray(batch.column(g).to_pylist(), dtype=object) for g in group_cols]
            new = np.ones(n, dtype=bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            first = tuple(k[0] for k in keys)
            if carry_key != first:
                carry = {}
            seg = np.cumsum(new)
            out = batch.append_column("_pos", pa.array(np.arange(pos, pos + n)))
            pos += n
            for name, (op, value) in specs.items():
                v = batch.column(value)
                have = np.asarray(v.is_valid())
                kind = "int64" if pa.types.is_integer(v.type) else "float64"
                own = v.fill_null(0).to_numpy(zero_copy_only=False).astype(kind)
                if op == "sum":
                    incl = pd.Series(own).groupby(seg).cumsum().to_numpy()
                    some = np.ones(n, dtype=bool)
                else:
                    # the place of the row that holds the value so far, -1 for none
                    at = np.where(have, np.arange(n), -1)
                    if op == "last":
                        at = pd.Series(at).groupby(seg).cummax().to_numpy()
                        incl = own[np.maximum(at, 0)]
                        some = at >= 0
                    else:
                        edge = (np.iinfo if kind == "int64" else np.finfo)(kind)
                        own = np.where(have, own, edge.max if op == "min" else edge.min)
                        by = pd.Series(own).groupby(seg)
                        incl = (by.cummin if op == "min" else by.cummax)().to_numpy()
                        some = pd.Series(have).groupby(seg).cummax().to_numpy()
                if name in carry:
                    here, c = seg == 1, carry[name]
                    if op == "sum":
                        incl = np.where(here, incl + c, incl)
                    elif op == "last":
                        incl = np.where(here & ~some, c, incl)
                    else:
                        incl = np.where(here, np.where(some, (np.minimum if op == "min" else np.maximum)(incl, c), c), incl)
                    some = some | here
                before = np.concatenate([incl[:1], incl[:-1]])
                known = np.concatenate([[False], some[:-1]]) & ~new
                if name in carry:
                    before[0], known[0] = carry[name], True
                out = out.append_column(f"_i_{name}", pa.array(incl, mask=~some)).append_column(f"_b_{name}", pa.array(before, mask=~known))
                carry.pop(name, None)
                if some[-1]:
                    carry[name] = incl[-1]
            carry_key = tuple(k[-1] for k in keys)
            yield out
    return run


def scans(df: DataFrame, group_cols, order_cols, specs: dict[str, tuple[str, str]], num_partitions: int | None = None) -> DataFrame:
    """Several scans per group over one range-partitioned sort: ``{out: (op, value
    column)}`` with op ``sum`` (up to and with the row), or ``min``, ``max`` and
    ``last`` of the rows before it that are not null (null where there is none).

    As in ``prefix_scan`` a group may span any number of tasks; a task holds one
    Arrow batch, and one row a task tells the next ones what to carry on from.
    Nulls add nothing to a sum."""
    from tessera.session import scratch_path
    spark = df.sparkSession
    group_cols, order_cols = list(group_cols), list(order_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *group_cols, *order_cols).sortWithinPartitions(*group_cols, *order_cols)
              .withColumn("_pid", F.spark_partition_id()))
    kinds = {o: T.LongType() if isinstance(df.schema[v].dataType, T.IntegralType) else T.DoubleType() for o, (_, v) in specs.items()}
    added = [T.StructField(f"_{x}_{o}", kinds[o]) for o in specs for x in "ib"]
    schema = T.StructType([*ranged.schema.fields, T.StructField("_pos", T.LongType()), *added])
    path = scratch_path(spark, f"scans-{uuid.uuid4().hex}")
    ranged.mapInArrow(_local_scans_fn(group_cols, specs), schema).write.parquet(path)
    local = spark.read.schema(schema).parquet(path)
    key = F.struct(*group_cols)
    stats = local.groupBy("_pid").agg(F.min_by(key, "_pos").alias("first_key"), F.max_by(key, "_pos").alias("last_key"),
                                      *[F.max_by(f"_i_{o}", "_pos").alias(f"_t_{o}") for o in specs])
    same = Window.partitionBy("last_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    order = Window.orderBy("_pid")  # one row a task

    def total(op: str, c: str):
        return {"sum": F.sum, "min": F.min, "max": F.max}[op](c) if op != "last" else F.last(c, ignorenulls=True)

    offsets = stats.withColumns({f"_c_{o}": total(op, f"_t_{o}").over(same) for o, (op, _) in specs.items()})
    offsets = offsets.withColumn("prev_key", F.lag("last_key").over(order))
    offsets = offsets.select("_pid", "first_key", *[
        F.when(F.col("prev_key").eqNullSafe(F.col("first_key")), F.lag(f"_c_{o}").over(order)).alias(f"_o_{o}") for o in specs])
    joined = local.join(F.broadcast(offsets), "_pid")  # as many rows as tasks
    outs = []
    for o, (op, _) in specs.items():
        off = F.when(key.eqNullSafe(F.col("first_key")), F.col(f"_o_{o}"))
        if op == "sum":
            value = F.col(f"_i_{o}") + F.coalesce(off, F.lit(0).cast(kinds[o]))
        elif op == "last":
            value = F.coalesce(F.col(f"_b_{o}"), off)
        else:
            value = (F.least if op == "min" else F.greatest)(F.col(f"_b_{o}"), off)
        outs.append(value.cast(kinds[o]).alias(o))
    return joined.select(*df.columns, *outs)
