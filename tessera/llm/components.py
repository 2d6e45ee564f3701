"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Point neighbours of each node ``u`` at the least of them and ``u``:
    those larger than ``u``, or those smaller and ``u`` itself."""
    if larger:
        sides = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = pairs
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = sides.join(least, "u")
    if larger:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its least
    node.  Large-star and small-star steps alternate until nothing changes: the
    number of rounds grows with the logarithm of the longest path, each round is
    written to the shared folder, and no step gathers a neighbourhood."""
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    pairs = staged(pairs, "components")

    def mark(p: DataFrame):
        return p.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(pairs)
    while True:
        pairs = staged(_star(_star(pairs, True), False).distinct(), "components")
        now = mark(pairs)
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
