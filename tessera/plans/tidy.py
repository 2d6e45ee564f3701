"""Pair tidying plan: two text trees joined on relative path (J1/J2),
parsed (P1/P2), label-validated (P4), counted (A3) and split (W1).

One scan per tree, one shuffle for the join; the split ranks rows with the
skew-safe global row number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import keyed_unit
from tessera.operators.prompts import normalize_answer, parse_prompt_file, validate_and_fix
from tessera.plans.prefix import row_numbers
from tessera.sources.files import text_tree


def tidy_pairs(spark: SparkSession, prompts_dir: str, answers_dir: str, key=None, packs: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(examples, missing): examples have category, language (fixed),
    prompt, response, was_fixed, rel_path; missing are prompts without an answer.
    ``key`` (a Column function) turns a file's path into what pairs share;
    ``packs`` names the files that hold others (see ``text_tree``)."""
    def tree(folder: str) -> DataFrame:
        t = text_tree(spark, folder, packs=packs)
        return t if key is None else t.withColumn("rel_path", key(F.col("rel_path")))

    p = tree(prompts_dir)
    parsed = p.select("rel_path", *[c.alias(n) for n, c in parse_prompt_file(F.col("content")).items()])
    a = tree(answers_dir).select("rel_path", normalize_answer(F.col("content")).alias("response"))
    matched = parsed.join(a, "rel_path")
    fix = validate_and_fix(F.col("category"), F.col("language"), F.col("prompt"))
    examples = matched.select("rel_path", "category", fix["language"].alias("language"), "prompt", "response",
                              fix["was_fixed"].alias("was_fixed"))
    missing = parsed.join(a.select("rel_path"), "rel_path", "left_anti")
    return examples, missing


def tidy_stats(prompts: DataFrame, examples: DataFrame) -> DataFrame:
    """A3: total, valid, missing_answer, language_mismatch, fixed (one pass each side)."""
    total = prompts.agg(F.count("*").alias("total"))
    ex = examples.agg(F.count("*").alias("valid"), F.count_if("was_fixed").alias("fixed"))
    j = total.withColumn("_k", F.lit(1)).join(ex.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return j.select("total", "valid", (F.col("total") - F.col("valid")).alias("missing_answer"),
                    F.col("fixed").alias("language_mismatch"), "fixed")


def head_split(df: DataFrame, order_cols=("rel_path",), min_dev: int = 10, dev_fraction_div: int = 10) -> DataFrame:
    """W1 (reference): dev = first max(min_dev, n div 10) rows in order."""
    n = df.count()  # scalar action
    dev = max(min_dev, n // dev_fraction_div)
    rn = row_numbers(df, [], list(order_cols), "_rn")
    return rn.withColumn("split", F.when(F.col("_rn") <= dev, F.lit("dev")).otherwise(F.lit("train"))).drop("_rn")


def hash_split(df: DataFrame, key: str, dev_rate: float = 0.1, salt: str = "split") -> DataFrame:
    """W1 (default): keyed hash split — stable under any re-run or partitioning."""
    return df.withColumn("split", F.when(keyed_unit(salt, key) < dev_rate, F.lit("dev")).otherwise(F.lit("train")))


def split_leakage(split_df: DataFrame, text: str) -> DataFrame:
    """U4: texts present in both dev and train."""
    h = split_df.select(F.sha2(F.col(text), 256).alias("h"), "split")
    return h.where("split = 'dev'").select("h").intersect(h.where("split = 'train'").select("h"))
