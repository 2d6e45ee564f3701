"""Run-metric windows (W8-W11) over ``(run, step, value)`` tables.

Every per-run ordering goes through the distributed prefix scan, and the
"previous step" is an equi-join on ``(run, step - 1)`` — a run holding a
third of all rows is never sorted inside one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.prefix import prefix_scan, row_numbers


def number_steps(df: DataFrame, run: str, order_cols, step: str = "step") -> DataFrame:
    """1-based step per run in ``order_cols`` order."""
    return row_numbers(df, [run], order_cols, step)


def loss_spikes(df: DataFrame, run: str = "run_id", step: str = "step", loss: str = "loss",
                factor: float = 2.0) -> DataFrame:
    """Rows whose loss exceeds ``factor`` x the previous step's loss."""
    prev = df.select(run, (F.col(step) + 1).alias(step), F.col(loss).alias("prev_loss"))
    j = df.join(prev, [run, step], "left")
    return j.withColumn("is_spike", F.coalesce(F.col(loss) > F.lit(factor) * F.col("prev_loss"), F.lit(False)))


def running_cost(df: DataFrame, run: str, order_cols, cost: str, budget: float) -> DataFrame:
    """Running cost per run and the over-budget flag."""
    r = prefix_scan(df, [run], order_cols, cost, "running_cost", integral=False)
    return r.withColumn("over_budget", F.col("running_cost") > F.lit(float(budget)))


def first_breach(df: DataFrame, run: str, order_col: str) -> DataFrame:
    """First row (by ``order_col``) where a run is over budget."""
    return df.where("over_budget").groupBy(run).agg(F.min(order_col).alias("first_breach"))


def best_so_far(df: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """Running minimum of the loss per run and whether the step is a new best."""
    r = prefix_scan(df, [run], [step], loss, "best_so_far", integral=False, op="min")
    return r.withColumn("is_new_best", F.col(loss) <= F.col("best_so_far"))


def checkpoints_to_keep(df: DataFrame, run: str, step: str, loss: str, keep_last: int = 3) -> DataFrame:
    """W10 retention: the last ``keep_last`` checkpoints of each run plus the
    best one (lowest loss, earliest step on ties)."""
    desc = df.withColumn("_neg", -F.col(step))
    ranked = row_numbers(desc, [run], ["_neg"], "recency").drop("_neg")
    best = df.groupBy(run).agg(F.min_by(step, F.struct(loss, step)).alias("_best_step"))
    j = ranked.join(best, run)
    return (j.withColumn("is_best", F.col(step) == F.col("_best_step"))
            .where((F.col("recency") <= keep_last) | F.col("is_best")).drop("_best_step"))


def cadence(df: DataFrame, step: str, every: dict[str, int]) -> DataFrame:
    """Boolean columns ``<name>`` = step % k == 0 (log / eval / save)."""
    out = df
    for name, k in every.items():
        out = out.withColumn(name, F.pmod(F.col(step), F.lit(k)) == 0)
    return out
