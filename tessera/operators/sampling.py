"""Sampling, shuffling and mixing (M1-M8) on the keyed-hash contract.

No operator uses ``rand()``: a row's fate is a function of (salt, key), so
results are identical under retries, executor loss and any partitioning.
Per-group ranks and running sums go through the distributed prefix scan
(``plans.prefix``) so a stratum holding a third of the rows is still spread
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import keyed_u32, keyed_unit
from tessera.plans.prefix import prefix_scan, row_numbers


def bernoulli(df: DataFrame, rate, key: str = "id", salt: str = "bernoulli") -> DataFrame:
    """M1: keep a row when its keyed unit value is below ``rate`` (Column or float)."""
    r = rate if isinstance(rate, Column) else F.lit(float(rate))
    return df.where(keyed_unit(salt, key) < r)


def with_shuffle_key(df: DataFrame, key: str = "id", salt: str = "shuffle") -> DataFrame:
    return df.withColumn("shuffle_key", keyed_u32(salt, key))


def uniform_sample(df: DataFrame, n: int, key: str = "id", salt: str = "sample") -> DataFrame:
    """M2: exactly ``min(n, count)`` rows, uniform without replacement.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: a per-task
    top-n and a merge of ``tasks x n`` rows — no global sort.
    """
    return with_shuffle_key(df, key, salt).orderBy("shuffle_key", key).limit(n)


def shuffle_positions(df: DataFrame, key: str = "id", salt: str = "shuffle") -> DataFrame:
    """M4: a full keyed shuffle as a 1-based position column ``shuffle_pos``."""
    return row_numbers(with_shuffle_key(df, key, salt), [], ["shuffle_key", key], "shuffle_pos")


def stratified_sample(df: DataFrame, stratum: str, n: int, key: str = "id", salt: str = "stratified",
                      n_strata: int | None = None) -> DataFrame:
    """M5: ``n div k`` rows per stratum (k = number of strata), keyed order."""
    if n_strata is None:
        n_strata = df.select(stratum).distinct().count()  # one small action: k strata
    per = n // max(n_strata, 1)
    ranked = row_numbers(with_shuffle_key(df, key, salt), [stratum], ["shuffle_key", key], "stratum_rank")
    return ranked.where(F.col("stratum_rank") <= per)


def mixture(df: DataFrame, group: str, shares: DataFrame, budget: float, weight: str,
            key: str = "id", salt: str = "mixture") -> DataFrame:
    """M6: per-group quota = share% x budget; keep rows (keyed order) while the
    running weight of the group stays within its quota.

    ``shares`` is a (group, share) table (percent); groups without a share
    get quota 0.  How the quota table (one row per group) is joined is left to
    the planner.
    """
    ranked = prefix_scan(with_shuffle_key(df, key, salt), [group], ["shuffle_key", key], weight,
                         "running_weight", integral=False)
    quota = shares.select(F.col(shares.columns[0]).alias(group),
                          (F.col(shares.columns[1]) / 100.0 * F.lit(float(budget))).alias("quota"))
    return (ranked.join(quota, group, "left")
            .withColumn("kept", F.col("running_weight") <= F.coalesce(F.col("quota"), F.lit(0.0))))


def curriculum(df: DataFrame, phases, key: str = "id", salt: str = "curriculum") -> DataFrame:
    """M7: phase by cumulative share of rows in keyed order.

    ``phases`` = [(max_length, percent), ...] in training order.
    """
    n = df.count()  # one scalar action
    pos = row_numbers(with_shuffle_key(df, key, salt), [], ["shuffle_key", key], "pos")
    expr = None
    acc = 0
    for max_len, pct in phases:
        acc += pct
        cond = F.col("pos") * 100 <= F.lit(acc * n)
        expr = F.when(cond, F.lit(max_len)) if expr is None else expr.when(cond, F.lit(max_len))
    return pos.withColumn("max_length", expr.otherwise(F.lit(phases[-1][0])))


def shuffle_for_write(df: DataFrame, n_files: int, key: str = "id", salt: str = "buffer") -> DataFrame:
    """M8: bounded-buffer shuffle replaced by a keyed repartition and a keyed
    sort inside each output file (deterministic, no driver buffer)."""
    k = keyed_u32(salt, key)
    return df.withColumn("_k", k).repartition(n_files, "_k").sortWithinPartitions("_k", key).drop("_k")
