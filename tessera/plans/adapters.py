"""Driver tables -> operator inputs.

Each adapter is a projection/join over the given parquet tables, so every
registered query reads them and grows with them.  Column pruning and
filters reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.hashing import keyed_pick


# Tables whose rows carry long texts or vectors: per-row work (regex, hashing,
# UDFs, array math) dominates, so they must not sit in fewer tasks than cores.
TEXT_TABLES = {"documents", "pages", "conversations", "embeddings"}


def spread(df: DataFrame) -> DataFrame:
    """Round-robin into 2x default parallelism when the scan yields fewer
    splits than cores (e.g. one large row group).  A planning-time check:
    at scale the scan already has far more splits and nothing changes."""
    sc = df.sparkSession.sparkContext
    target = sc.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(2 * target)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def code_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> raw code record (id, content, language, repo, path, stars).

    ``stars`` is a keyed-hash value per source in [0, 200] so every star
    tier of F8 is populated.
    """
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("id"),
        F.coalesce(F.col("text"), F.lit("")).alias("content"),
        F.coalesce(F.col("lang"), F.lit("unknown")).alias("language"),
        F.coalesce(F.col("source"), F.lit("")).alias("repo"),
        F.col("doc_id").cast("string").alias("path"),
        keyed_pick("stars", 201, "source").cast("int").alias("stars"),
    )


SQL_CODE_RECORDS = f"""
SELECT doc_id AS id, coalesce(text, '') AS content, coalesce(lang, 'unknown') AS language,
       coalesce(source, '') AS repo, CAST(doc_id AS VARCHAR) AS path,
       CAST((CAST(('0x' || substr(md5(concat_ws(':', 'stars', source)), 1, 8)) AS BIGINT) % 201) AS INTEGER) AS stars
FROM documents"""


def prompt_response_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> (conv_id, turn, prompt, response, category, language).

    A user row is paired with the next turn when that turn is an assistant
    row: an equi-join on ``(conv_id, turn + 1)`` — no window over a
    conversation, so a huge conversation does not land in one task.
    ``category`` is a keyed-hash choice among the reference categories.
    """
    c = table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    cats = F.array(*[F.lit(x) for x in K.CATEGORIES])
    return (u.join(a, ["conv_id", "turn"])
            .withColumn("category", F.element_at(cats, (keyed_pick("category", len(K.CATEGORIES), "conv_id", "turn") + 1).cast("int")))
            .withColumn("language", F.lit("python")))


SQL_CATEGORY_ARRAY = "[" + ", ".join(f"'{c}'" for c in K.CATEGORIES) + "]"
SQL_PAIRS = f"""
SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response,
       {SQL_CATEGORY_ARRAY}[CAST(('0x' || substr(md5(concat_ws(':', 'category', CAST(u.conv_id AS VARCHAR), CAST(u.turn AS VARCHAR))), 1, 8)) AS BIGINT) % {len(K.CATEGORIES)} + 1] AS category,
       'python' AS language
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'"""


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (task_id, sample_id, passed): task = user, pass = not an error."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("task_id"), F.col("event_id").alias("sample_id"),
                    (F.col("event_type") != "error").alias("passed"), "event_type", "value")


SQL_VERDICTS = """
SELECT user_id AS task_id, event_id AS sample_id, event_type <> 'error' AS passed, event_type, value
FROM events"""


def test_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> per-test outcomes (task = order, passed = not returned)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("task_id"), F.col("l_linenumber").alias("test_id"),
                     F.col("l_suppkey").alias("library"), (F.col("l_returnflag") != "R").alias("passed"))
