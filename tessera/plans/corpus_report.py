"""Flagship plan: basic checks -> exact dedup -> per-language report.

One scan of the corpus; per-row checks are codegen'd column expressions;
the text is reduced to a sha256 before anything shuffles; the report is a
ROLLUP (per language + overall total) with partial aggregation.  Distinct
counting on ``(language, hash)`` is a two-phase aggregate, so a language
holding a third of the corpus is still split across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.quality import BasicChecks, basic_reject_reason

REASONS = ["too_short", "too_long", "too_few_lines", "minified", "low_alnum"]


def corpus_report(code: DataFrame, p: BasicChecks = BasicChecks()) -> DataFrame:
    flagged = code.select(
        "language",
        basic_reject_reason(F.col("content"), p).alias("reason"),
        F.sha2(F.col("content"), 256).alias("h"),
    )
    aggs = [F.count("*").alias("n_docs"), F.count_if(F.col("reason").isNull()).alias("n_pass")]
    aggs += [F.count_if(F.col("reason") == r).alias(f"rej_{r}") for r in REASONS]
    aggs.append(F.count_distinct(F.when(F.col("reason").isNull(), F.col("h"))).alias("n_unique"))
    rep = flagged.rollup("language").agg(*aggs)
    return (rep.withColumn("language", F.coalesce(F.col("language"), F.lit("*")))
            .withColumn("dedup_rate", F.round(F.try_divide(F.col("n_pass") - F.col("n_unique"), F.col("n_pass")), 6)))


def corpus_report_sql(code_sql: str) -> str:
    rej = ",\n  ".join(f"count(*) FILTER (WHERE reason = '{r}') AS rej_{r}" for r in REASONS)
    return f"""
WITH code AS ({code_sql}),
f AS (
  SELECT language, sha256(content) AS h,
    CASE WHEN length(content) < 100 THEN 'too_short'
         WHEN length(content) > 100000 THEN 'too_long'
         WHEN len(string_split(content, chr(10))) < 5 THEN 'too_few_lines'
         WHEN length(content) > 200 * len(string_split(content, chr(10))) THEN 'minified'
         WHEN length(regexp_replace(content, '[^\\p{{L}}\\p{{N}}\\t\\n\\x{{0B}}\\f\\r\\x{{1C}}-\\x{{1F}}\\x{{85}}\\p{{Z}}]', '', 'g')) < 0.5 * length(content) THEN 'low_alnum'
    END AS reason
  FROM code)
SELECT coalesce(language, '*') AS language, count(*) AS n_docs,
  count(*) FILTER (WHERE reason IS NULL) AS n_pass,
  {rej},
  count(DISTINCT h) FILTER (WHERE reason IS NULL) AS n_unique,
  round(CASE WHEN count(*) FILTER (WHERE reason IS NULL) = 0 THEN NULL
        ELSE (count(*) FILTER (WHERE reason IS NULL) - count(DISTINCT h) FILTER (WHERE reason IS NULL))::DOUBLE
             / count(*) FILTER (WHERE reason IS NULL) END, 6) AS dedup_rate
FROM f GROUP BY ROLLUP (language)"""
