"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

# White space of every word rule here; Java and Python regex syntax alike.
SPACE = r"\x20\x09-\x0D"
RADIX_BITS = 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back:
    lineage ends there, later readers see one evaluation, and the planner
    knows the table's real size when it chooses a join."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as keep it apart from the columns."""
    out = []
    for name in names:
        while name in docs.columns:
            name += "_"
        out.append(name)
    return out


def running_total(df: DataFrame, group: list[str], order: str, value: str | list[str], out: str | list[str],
                  ties: list[str] = (), levels: int = 4) -> DataFrame:
    """Exclusive running sums of ``value`` by ``order`` (a long) within ``group``.

    A window over a whole group would put a hot group into one task.  Here
    the order key is cut into digits of base 512: rows are summed within
    ``(group, order div 512)``, those buckets within ``order div 512^2``, and
    so on, so a window holds at most 512 distinct keys whatever the group's
    size (the last level holds ``max(order) / 512^levels`` buckets).  The cut
    depends on the key alone, never on row counts.  Null keys form a bucket
    that comes first; rows with one key are ordered by ``ties``.
    """
    values, outs = ([value], [out]) if isinstance(value, str) else (value, out)
    return _running(df, group, F.shiftright(order, RADIX_BITS), [order, *ties], values, outs, levels)


def _running(df: DataFrame, group: list[str], bucket: Column, order: list[str], values: list[str], outs: list[str],
             levels: int) -> DataFrame:
    if levels == 0:
        return df.withColumns({o: _before(v, group, order) for v, o in zip(values, outs)})
    b = f"__b{levels}"
    total, base = ([f"__{x}{levels}_{i}" for i in range(len(values))] for x in "vo")
    rows = df.withColumn(b, bucket)
    sums = rows.groupBy(*group, b).agg(*[F.sum(v).alias(t) for v, t in zip(values, total)])
    sums = _running(sums, group, F.shiftright(b, RADIX_BITS), [b], total, base, levels - 1)
    sums = sums.select(*[F.col(c).alias(f"__k_{c}") for c in [*group, b]], *base)
    rows = rows.withColumns({o: _before(v, [*group, b], order) for v, o in zip(values, outs)})
    on = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in [*group, b]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = rows.join(sums, cond, "left")
    joined = joined.withColumns({o: F.col(o) + F.col(x) for o, x in zip(outs, base)})
    return joined.drop(b, *base, *[f"__k_{c}" for c in [*group, b]])


def _before(value: str, group: list[str], order: list[str]) -> Column:
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    w = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def successors(keys: DataFrame, col: str, levels: int = 2) -> DataFrame:
    """(key, next): the next greater value of each distinct ``col``, null for the
    greatest, by windows over 512 neighbouring values as in ``running_total``."""
    def step(rows: DataFrame, left: int) -> DataFrame:
        if left == 0:
            return rows.withColumn("next", F.lead("key").over(Window.partitionBy(F.lit(0)).orderBy("key")))
        rows = rows.withColumn("b", F.shiftright("key", RADIX_BITS))
        near = rows.withColumn("next", F.lead("key").over(Window.partitionBy("b").orderBy("key")))
        least = rows.groupBy("b").agg(F.min("key").alias("least"))
        after = step(least.select(F.col("b").alias("key")), left - 1).select(F.col("key").alias("b"), F.col("next").alias("nb"))
        after = after.join(least.select(F.col("b").alias("nb"), F.col("least").alias("after")), "nb").select("b", "after")
        return near.join(after, "b", "left").select("key", F.coalesce("next", "after").alias("next"))

    return step(keys.select(F.col(col).alias("key")).distinct(), levels)
