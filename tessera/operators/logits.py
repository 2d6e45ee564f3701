"""Distribution scoring over stored logits (L1-L4): offline batch scoring of
persisted per-position logit vectors, no model run.

Each row is one position: ``student`` / ``teacher`` logit arrays and an
integer ``label`` (``-100`` = ignored).  Everything is array higher-order
functions on the row (no shuffle); averages are ordinary aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.text import col


def _staged_log_softmax(df: DataFrame, logits: str, out: str, temperature: float = 1.0) -> DataFrame:
    """Adds ``out`` = log-softmax(logits / T), one intermediate per projection
    (lambda bodies reference finished per-row columns, never re-evaluate the
    max or the normaliser per element)."""
    z, m, lse = f"_{out}_z", f"_{out}_m", f"_{out}_lse"
    return (df.withColumn(z, F.transform(F.col(logits), lambda v: v.cast("double") / F.lit(float(temperature))))
            .withColumn(m, F.array_max(z))
            .withColumn(lse, F.log(F.aggregate(z, F.lit(0.0), lambda a, v: a + F.exp(v - F.col(m)))) + F.col(m))
            .withColumn(out, F.transform(z, lambda v: v - F.col(lse)))
            .drop(z, m))


def log_softmax(logits, temperature: float = 1.0) -> Column:
    """L1 as a single expression (fine for short vectors; prefer the staged
    DataFrame form for vocabulary-sized ones)."""
    z = F.transform(col(logits), lambda v: v.cast("double") / F.lit(float(temperature)))
    m = F.array_max(z)
    lse = F.log(F.aggregate(z, F.lit(0.0), lambda a, v: a + F.exp(v - m))) + m
    return F.transform(z, lambda v: v - lse)


def with_log_softmax(df: DataFrame, logits: str, out: str = "log_probs", temperature: float = 1.0) -> DataFrame:
    """L1: adds ``out`` and ``_{out}_lse`` (the log-normaliser)."""
    return _staged_log_softmax(df, logits, out, temperature)


def logsumexp(logits) -> Column:
    z = F.transform(col(logits), lambda v: v.cast("double"))
    m = F.array_max(z)
    return F.log(F.aggregate(z, F.lit(0.0), lambda a, v: a + F.exp(v - m))) + m


def distillation_loss(df: DataFrame, student: str = "student", teacher: str = "teacher", label: str = "label",
                      temperature: float = K.TEMPERATURE, hard_weight: float = K.HARD_WEIGHT,
                      group_cols=()) -> DataFrame:
    """L2-L4: hard (masked CE at T=1), soft (KL(teacher||student) at T,
    x T^2, over unmasked positions) and ``hard_weight*hard +
    (1-hard_weight)*soft``; fully masked groups give nulls."""
    d = _staged_log_softmax(df, student, "_ls1")
    d = _staged_log_softmax(d, student, "_lsT", temperature)
    d = _staged_log_softmax(d, teacher, "_ltT", temperature)
    keep = F.col(label) != K.IGNORE_INDEX
    nll = F.when(keep, -F.element_at("_ls1", (F.col(label) + 1).cast("int")))
    kl = F.when(keep, F.aggregate(F.zip_with("_ltT", "_lsT", lambda t, s: F.exp(t) * (t - s)), F.lit(0.0), lambda a, x: a + x))
    g = d.groupBy(*group_cols).agg(F.avg(nll).alias("hard_loss"), F.avg(kl).alias("kl"), F.count(nll).alias("n_positions"))
    soft = F.col("kl") * (temperature ** 2)
    return g.select(*group_cols, F.round("hard_loss", 6).alias("hard_loss"), F.round(soft, 6).alias("soft_loss"),
                    F.round(F.lit(hard_weight) * F.col("hard_loss") + F.lit(1 - hard_weight) * soft, 6).alias("total_loss"),
                    "n_positions")


def cross_entropy(df: DataFrame, logits: str, label: str, group_cols=()) -> DataFrame:
    """L2: mean -log p[label] over unmasked positions."""
    d = _staged_log_softmax(df.where(F.col(label) != K.IGNORE_INDEX), logits, "_lp")
    nll = -F.element_at("_lp", (F.col(label) + 1).cast("int"))
    return d.groupBy(*group_cols).agg(F.round(F.avg(nll), 6).alias("hard_loss"), F.count("*").alias("n_positions"))
