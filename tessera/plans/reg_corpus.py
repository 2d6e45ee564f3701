"""Corpus curation queries: sources, quality filters, sampling, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.hashing import keyed_unit, sql_u32, sql_unit
from tessera.operators import quality as Q
from tessera.operators import sampling as M
from tessera.plans import tidy
from tessera.plans.adapters import SQL_CODE_RECORDS, SQL_PAIRS, code_records, prompt_response_pairs, table
from tessera.plans.corpus_report import corpus_report, corpus_report_sql
from tessera.plans.registry import register

PYS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
SQL_REASON_BASIC = f"""CASE WHEN length(content) < 100 THEN 'too_short'
         WHEN length(content) > 100000 THEN 'too_long'
         WHEN len(string_split(content, chr(10))) < 5 THEN 'too_few_lines'
         WHEN length(content) > 200 * len(string_split(content, chr(10))) THEN 'minified'
         WHEN length(regexp_replace(content, '[^\\p{{L}}\\p{{N}}{PYS}]', '', 'g')) < 0.5 * length(content) THEN 'low_alnum'
    END"""


@register("a16_corpus_report", corpus_report_sql(SQL_CODE_RECORDS))
def q_corpus_report(spark, sf):
    return corpus_report(code_records(spark, sf))


# --- F3 ---------------------------------------------------------------------

@register("f3_basic_checks", f"""
WITH code AS ({SQL_CODE_RECORDS})
SELECT id, {SQL_REASON_BASIC} AS reject_reason FROM code""")
def q_f3(spark, sf):
    return Q.basic_checks(code_records(spark, sf)).select("id", "reject_reason")


# --- F9 composite (F3 + F5 + F6 + F7 + F8) -----------------------------------

_F9_SQL = f"""
WITH code AS ({SQL_CODE_RECORDS})
SELECT id, CASE
  WHEN length(content) < 100 THEN 'too_short'
  WHEN length(content) > 100000 THEN 'too_long'
  WHEN len(string_split(content, chr(10))) < 5 THEN 'too_few_lines'
  WHEN length(content) > 200 * len(string_split(content, chr(10))) THEN 'minified'
  WHEN length(regexp_replace(content, '[^\\p{{L}}\\p{{N}}{PYS}]', '', 'g')) < 0.5 * length(content) THEN 'low_alnum'
  WHEN len(list_filter(string_split(content, chr(10)), lambda l: regexp_matches(l, '^[{PYS}]*(#|//)')))
       > 0.5 * len(string_split(content, chr(10))) THEN 'too_many_comments'
  WHEN contains(lower(content), 'auto-generated') OR contains(lower(content), 'do not edit')
       OR contains(lower(content), 'generated by') OR contains(lower(content), 'this file is generated') THEN 'auto_generated'
  WHEN (contains(content, 'import unittest') OR contains(content, 'import pytest') OR contains(content, 'describe(')
        OR contains(content, 'it(')) AND {sql_unit('quality:test', 'id')} > 0.2 THEN 'test_file_sampled_out'
  WHEN {sql_unit('quality:tier', 'id')} >= CASE WHEN stars > 100 THEN 1.0 WHEN stars > 10 THEN 0.8 ELSE 0.3 END
       THEN 'repo_tier_sampled_out'
END AS reject_reason, stars
FROM code"""


@register("f9_high_quality", _F9_SQL)
def q_f9(spark, sf):
    return Q.high_quality(code_records(spark, sf)).select("id", "reject_reason", "stars")


# --- F5: comment ratio alone, with a data-splitting prefix list ----------------
# The driver corpus is prose; its junk runs ("### ", "%%% ") start some lines,
# so the reference rule is exercised with prefixes ["#", "%"] and ratio 0.0.

@register("f5_comment_ratio", f"""
WITH code AS ({SQL_CODE_RECORDS})
SELECT id, len(list_filter(string_split(content, chr(10)), lambda l: regexp_matches(l, '^[{PYS}]*(#|%)'))) AS comment_lines,
       len(string_split(content, chr(10))) AS n_lines,
       len(list_filter(string_split(content, chr(10)), lambda l: regexp_matches(l, '^[{PYS}]*(#|%)')))
         > 0.0 * len(string_split(content, chr(10))) AS too_many_comments
FROM code""")
def q_f5(spark, sf):
    c = code_records(spark, sf)
    cl = Q.comment_lines(F.col("content"), ["#", "%"])
    from tessera.functions.text import line_count
    return c.select("id", cl.alias("comment_lines"), line_count("content").alias("n_lines"),
                    (cl > F.lit(0.0) * line_count("content")).alias("too_many_comments"))


# --- F6/F7 with markers that occur in the driver corpus ------------------------

@register("f6_f7_markers", f"""
WITH code AS ({SQL_CODE_RECORDS})
SELECT id,
  (contains(lower(content), 'licensed under') OR contains(lower(content), 'released under')) AS auto_generated,
  (contains(content, 'token = ') AND {sql_unit('quality:test', 'id')} > 0.2) AS test_file_sampled_out
FROM code""")
def q_f6_f7(spark, sf):
    p = Q.ContentQuality(autogen_markers=["Licensed under", "Released under"], test_markers=["token = "])
    cols = Q.content_check_columns(F.col("content"), F.col("id"), None, p)
    return code_records(spark, sf).select("id", cols["auto_generated"].alias("auto_generated"),
                                          cols["test_file_sampled_out"].alias("test_file_sampled_out"))


# --- F8 / M1: repo tier keep by keyed Bernoulli --------------------------------

@register("f8_repo_tier", f"""
WITH code AS ({SQL_CODE_RECORDS})
SELECT id, stars, CAST(CASE WHEN stars > 100 THEN 1.0 WHEN stars > 10 THEN 0.8 ELSE 0.3 END AS DOUBLE) AS keep_rate
FROM code WHERE {sql_unit('tier', 'id')} < CASE WHEN stars > 100 THEN 1.0 WHEN stars > 10 THEN 0.8 ELSE 0.3 END""")
def q_f8(spark, sf):
    c = code_records(spark, sf).withColumn("keep_rate", Q.star_keep_rate(F.col("stars")))
    return M.bernoulli(c, F.col("keep_rate"), "id", "tier").select("id", "stars", "keep_rate")


# --- F1 / F2 on conversation pairs ---------------------------------------------

_REFUSAL_SQL = " OR ".join(f"contains(response, '{p.replace(chr(39), chr(39) * 2)}')" for p in K.REFUSAL_PHRASES)


@register("f1_response_quality", f"""
WITH p AS ({SQL_PAIRS})
SELECT conv_id, turn, category, CASE
  WHEN length(response) < 50 THEN 'too_short'
  WHEN {_REFUSAL_SQL} THEN 'refusal'
  WHEN category <> 'explanation' AND NOT contains(response, '```') THEN 'no_code'
END AS reject_reason
FROM p""")
def q_f1(spark, sf):
    return Q.response_reject_reason(prompt_response_pairs(spark, sf)).select("conv_id", "turn", "category", "reject_reason")


# guide variant.  The driver conversations hold no refusal phrase and no
# fence, so the phrase list adds two words that occur ("Und", "Les").
_F2_PHRASES = K.GUIDE_REFUSAL_PHRASES + ["Und ", "Les "]
_F2_SQL_REF = " OR ".join(f"contains(response, '{p.replace(chr(39), chr(39) * 2)}')" for p in _F2_PHRASES)


@register("f2_guide_quality", f"""
WITH p AS ({SQL_PAIRS})
SELECT conv_id, turn, category, CASE
  WHEN length(response) < 20 THEN 'too_short'
  WHEN {_F2_SQL_REF} THEN 'refusal'
  WHEN category IN ('function_implementation') AND NOT contains(response, '```') THEN 'no_code'
END AS reject_reason
FROM p""")
def q_f2(spark, sf):
    p = Q.ResponseQuality(min_length=K.GUIDE_MIN_LENGTH, refusals=_F2_PHRASES,
                          fence_required_for=["function_implementation"])
    return Q.response_reject_reason(prompt_response_pairs(spark, sf), params=p).select(
        "conv_id", "turn", "category", "reject_reason")


# --- F4: python syntax audit (UDF; rows-only) ----------------------------------

@register("f4_syntax_audit")
def q_f4(spark, sf):
    c = code_records(spark, sf).withColumn("language", F.lit("python"))
    return Q.syntax_rate(Q.syntax_valid(c), ["repo"])


# --- F10 / F11 / F15 --------------------------------------------------------------

@register("f10_category_subset", f"""
WITH p AS ({SQL_PAIRS})
SELECT conv_id, turn, category FROM p
WHERE category IN ('function_implementation', 'algorithm')
ORDER BY conv_id, turn LIMIT 50""")
def q_f10(spark, sf):
    p = prompt_response_pairs(spark, sf)
    return Q.category_subset(p, ["function_implementation", "algorithm"], 50, ["conv_id", "turn"]).select(
        "conv_id", "turn", "category")


@register("f11_language_subset", f"""
WITH code AS ({SQL_CODE_RECORDS})
SELECT id, language FROM code WHERE language IN ('de', 'es')""")
def q_f11(spark, sf):
    return Q.language_subset(code_records(spark, sf), ["de", "es"]).select("id", "language")


@register("f15_license_policy", f"""
WITH code AS ({SQL_CODE_RECORDS}),
l AS (SELECT id, CASE
  WHEN regexp_matches(content, '(?i)\\bMIT License\\b') THEN 'mit'
  WHEN regexp_matches(content, '(?i)\\bApache License\\b') THEN 'apache-2.0'
  WHEN regexp_matches(content, '(?i)\\bBSD\\b.{{0,20}}\\bLicense\\b') THEN 'bsd'
  WHEN regexp_matches(content, '(?i)\\b(GNU )?(Lesser |Affero )?General Public License\\b') THEN 'gpl'
  ELSE 'none' END AS license FROM code)
SELECT id, license, license IN ('mit', 'apache-2.0', 'bsd', 'none') AS license_ok FROM l""")
def q_f15(spark, sf):
    return Q.license_policy(code_records(spark, sf)).select("id", "license", "license_ok")


# --- S6 / S7 ---------------------------------------------------------------------

@register("s6_filtered_source", """
SELECT doc_id AS id, n_chars FROM documents
WHERE NOT contains(text, chr(0)) AND n_chars < 2000 AND source LIKE '%1'
ORDER BY doc_id LIMIT 40""")
def q_s6(spark, sf):
    """S6 is the reference's source query: not binary, size below a bound,
    a path-suffix predicate and a LIMIT (the limit is the operator).  The
    driver corpus has no file paths, so the suffix applies to ``source``."""
    d = table(spark, sf, "documents")
    return (d.where(~F.col("text").contains("\x00") & (F.col("n_chars") < 2000) & F.col("source").like("%1"))
            .orderBy("doc_id").limit(40).select(F.col("doc_id").alias("id"), "n_chars"))


@register("s7_language_collection", f"""
WITH code AS ({SQL_CODE_RECORDS})
SELECT id, language, repo, path, stars, length(content) AS n_chars FROM code""")
def q_s7(spark, sf):
    return code_records(spark, sf).select("id", "language", "repo", "path", "stars",
                                          F.length("content").alias("n_chars"))


# --- A1 / A2 / A3 / A4 -------------------------------------------------------------

@register("a1_count_by_category", f"""
WITH p AS ({SQL_PAIRS})
SELECT category, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct
FROM p GROUP BY category""")
def q_a1(spark, sf):
    from pyspark.sql import Window
    g = prompt_response_pairs(spark, sf).groupBy("category").agg(F.count("*").alias("n"))
    # window over the grouped table: one row per category (bounded)
    return g.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6)).orderBy(
        F.desc("n"), "category")


@register("a2_count_by_type_sorted", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY event_type""")
def q_a2(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy("event_type")


@register("a3_stage_stats", """
SELECT count(*) AS total, count(l.doc_id) AS valid, count(*) - count(l.doc_id) AS missing_answer,
       count(*) FILTER (WHERE l.quality = 0) AS low_quality, count(*) FILTER (WHERE l.toxic = 1) AS flagged
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_a3(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.agg(F.count("*").alias("total"), F.count("quality").alias("valid"),
                 (F.count("*") - F.count("quality")).alias("missing_answer"),
                 F.count_if(F.col("quality") == 0).alias("low_quality"),
                 F.count_if(F.col("toxic") == 1).alias("flagged"))


@register("a4_keep_reject_rate", f"""
WITH p AS ({SQL_PAIRS}),
r AS (SELECT *, length(response) < 50 OR ({_REFUSAL_SQL}) OR (category <> 'explanation' AND NOT contains(response, '```')) AS rejected FROM p)
SELECT count(*) AS n_examples, count(*) FILTER (WHERE NOT rejected) AS n_kept,
       round(count(*) FILTER (WHERE NOT rejected) / count(*), 6) AS keep_rate,
       round(count(*) FILTER (WHERE rejected) / count(*), 6) AS reject_rate,
       CAST(sum(length(prompt) + length(response)) AS BIGINT) AS total_chars
FROM r""")
def q_a4(spark, sf):
    r = Q.response_reject_reason(prompt_response_pairs(spark, sf))
    return r.agg(F.count("*").alias("n_examples"), F.count_if(F.col("reject_reason").isNull()).alias("n_kept"),
                 F.round(F.try_divide(F.count_if(F.col("reject_reason").isNull()), F.count("*")), 6).alias("keep_rate"),
                 F.round(F.try_divide(F.count_if(F.col("reject_reason").isNotNull()), F.count("*")), 6).alias("reject_rate"),
                 F.sum(F.length("prompt") + F.length("response")).alias("total_chars"))


# --- W1 head split, W6 first per category, P29 preview ----------------------------

@register("w1_head_split", """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN rn <= greatest(10, n // 10) THEN 'dev' ELSE 'train' END AS split FROM r""")
def q_w1(spark, sf):
    return tidy.head_split(table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@register("w1_hash_split", f"""
SELECT doc_id, CASE WHEN {sql_unit('split', 'doc_id')} < 0.1 THEN 'dev' ELSE 'train' END AS split FROM documents""")
def q_w1_hash(spark, sf):
    return tidy.hash_split(table(spark, sf, "documents").select("doc_id"), "doc_id")


@register("u4_split_leakage", f"""
WITH s AS (SELECT sha256(text) AS h, {sql_unit('split', 'doc_id')} < 0.1 AS is_dev FROM documents)
SELECT h AS content_hash FROM s WHERE is_dev INTERSECT SELECT h FROM s WHERE NOT is_dev""")
def q_u4(spark, sf):
    split = tidy.hash_split(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return tidy.split_leakage(split, "text").withColumnRenamed("h", "content_hash")


@register("w6_first_per_category", f"""
WITH p AS ({SQL_PAIRS}),
f AS (SELECT category, conv_id, turn, row_number() OVER (PARTITION BY category ORDER BY conv_id, turn) AS rn FROM p)
SELECT category, conv_id, turn FROM f WHERE rn = 1 ORDER BY conv_id, turn LIMIT 5""")
def q_w6(spark, sf):
    p = prompt_response_pairs(spark, sf)
    # first position per category via min over a struct: partial aggregation, no window
    first = p.groupBy("category").agg(F.min(F.struct("conv_id", "turn")).alias("f"))
    return first.select("category", "f.conv_id", "f.turn").orderBy("conv_id", "turn").limit(5)


@register("p29_preview", f"""
WITH code AS ({SQL_CODE_RECORDS})
SELECT id, CASE WHEN length(content) > 200 THEN left(content, 200) || '...' ELSE content END AS preview FROM code""")
def q_p29(spark, sf):
    c = code_records(spark, sf)
    return c.select("id", F.when(F.length("content") > K.PREVIEW_CHARS,
                                 F.concat(F.left("content", F.lit(K.PREVIEW_CHARS)), F.lit("..."))).otherwise(F.col("content")).alias("preview"))


# --- Sampling M2, M4, M5, M6, M7 ---------------------------------------------------

@register("m2_uniform_sample", f"""
SELECT doc_id, lang FROM documents ORDER BY {sql_u32('sample', 'doc_id')}, doc_id LIMIT 50""")
def q_m2(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return M.uniform_sample(d, 50, "doc_id").select("doc_id", "lang")


@register("m4_shuffle_positions", f"""
SELECT doc_id, row_number() OVER (ORDER BY {sql_u32('shuffle', 'doc_id')}, doc_id) AS shuffle_pos FROM documents""")
def q_m4(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return M.shuffle_positions(d, "doc_id").select("doc_id", "shuffle_pos")


@register("m5_stratified_sample", f"""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {sql_u32('stratified', 'doc_id')}, doc_id) AS stratum_rank
           FROM documents)
SELECT doc_id, lang, stratum_rank FROM r WHERE stratum_rank <= 200 // (SELECT count(DISTINCT lang) FROM documents)""")
def q_m5(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return M.stratified_sample(d, "lang", 200, "doc_id").select("doc_id", "lang", "stratum_rank")


_MIX_SHARES = [("en", 40), ("de", 20), ("fr", 20), ("es", 20)]
_MIX_BUDGET = 200000.0


@register("m6_mixture", f"""
WITH w AS (SELECT doc_id, lang, len(list_filter(string_split_regex(text, '[{PYS}]+'), lambda x: x <> '')) AS n_words,
                  {sql_u32('mixture', 'doc_id')} AS k FROM documents),
r AS (SELECT *, sum(n_words) OVER (PARTITION BY lang ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_weight FROM w),
q AS (SELECT * FROM (VALUES {", ".join(f"('{g}', {s})" for g, s in _MIX_SHARES)}) t(lang, share))
SELECT doc_id, r.lang, CAST(running_weight AS DOUBLE) AS running_weight,
       running_weight <= coalesce(q.share / 100.0 * {_MIX_BUDGET}, 0.0) AS kept
FROM r LEFT JOIN q ON r.lang = q.lang""")
def q_m6(spark, sf):
    from tessera.functions.text import words
    d = table(spark, sf, "documents").select("doc_id", "lang", F.size(words("text")).alias("n_words"))
    shares = spark.createDataFrame(_MIX_SHARES, "lang string, share int")
    return M.mixture(d, "lang", shares, _MIX_BUDGET, "n_words", "doc_id").select(
        "doc_id", "lang", "running_weight", "kept")


@register("m7_curriculum", f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_u32('curriculum', 'doc_id')}, doc_id) AS pos, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN pos * 100 <= 50 * n THEN 2048 WHEN pos * 100 <= 80 * n THEN 4096 WHEN pos * 100 <= 100 * n THEN 8192 ELSE 8192 END AS max_length FROM r""")
def q_m7(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return M.curriculum(d, K.CURRICULUM_SHARES, "doc_id").select("doc_id", "max_length")


# --- J2 anti join, U1 union, J11 target mix -------------------------------------------

@register("j2_unlabeled_documents", """
SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_j2(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return d.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@register("u1_union_corpora", """
SELECT doc_id AS id, 'documents' AS origin, lang AS language, length(text) AS n_chars FROM documents
UNION ALL
SELECT page_id AS id, 'pages' AS origin, NULL AS language, length(html) AS n_chars FROM pages""")
def q_u1(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.lit("documents").alias("origin"),
                                             F.col("lang").alias("language"), F.length("text").alias("n_chars"))
    p = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.lit("pages").alias("origin"),
                                         F.length("html").alias("n_chars"))
    return d.unionByName(p, allowMissingColumns=True)


_TARGET_MIX = [("en", 50), ("de", 20), ("fr", 20), ("it", 10)]


@register("j11_target_mix", f"""
WITH a AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
act AS (SELECT lang, 100.0 * n / sum(n) OVER () AS actual_pct FROM a),
t AS (SELECT * FROM (VALUES {", ".join(f"('{g}', {s})" for g, s in _TARGET_MIX)}) v(lang, target_pct))
SELECT coalesce(act.lang, t.lang) AS lang, round(coalesce(actual_pct, 0.0), 6) AS actual_pct,
       CAST(coalesce(target_pct, 0) AS DOUBLE) AS target_pct,
       round(coalesce(actual_pct, 0.0) - coalesce(target_pct, 0), 6) AS delta_pct
FROM act FULL OUTER JOIN t ON act.lang = t.lang""")
def q_j11(spark, sf):
    from pyspark.sql import Window
    a = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    act = a.select("lang", (100.0 * F.col("n") / F.sum("n").over(Window.partitionBy())).alias("actual_pct"))
    t = spark.createDataFrame(_TARGET_MIX, "lang string, target_pct int")
    j = act.join(t, "lang", "full_outer")  # both sides: one row per language
    return j.select("lang", F.round(F.coalesce("actual_pct", F.lit(0.0)), 6).alias("actual_pct"),
                    F.coalesce("target_pct", F.lit(0)).cast("double").alias("target_pct"),
                    F.round(F.coalesce("actual_pct", F.lit(0.0)) - F.coalesce("target_pct", F.lit(0)), 6).alias("delta_pct"))


# --- A16: corpus metrics (samples, tokens, mean length, distribution, FIM rate) ---

@register("a16_corpus_metrics", f"""
WITH d AS (SELECT lang, length('<|lang_' || lang || '|>' || text || '<|endoftext|>') AS n_tok,
             {sql_unit('fim:coin', 'doc_id')} <= 0.5 AND len(string_split(text, chr(10))) >= 3 AS fim FROM documents),
g AS (SELECT coalesce(lang, '*') AS language, count(*) AS n_samples, CAST(sum(n_tok) AS BIGINT) AS n_tokens,
             round(avg(n_tok), 6) AS mean_sequence_length,
             round(avg(CASE WHEN fim THEN 1.0 ELSE 0.0 END), 6) AS fim_rate
      FROM d GROUP BY ROLLUP (lang))
SELECT *, round(n_samples / (SELECT count(*) FROM documents), 6) AS share FROM g""")
def q_a16_metrics(spark, sf):
    """One pass: per-language and total rows (ROLLUP); tokens are the
    code-point tokens of the language-tagged text (P14 + T8 on whole texts)."""
    from tessera.functions.text import line_count
    from tessera.operators.sequences import language_tagged
    d = table(spark, sf, "documents").select(
        "lang", F.length(language_tagged(F.col("text"), F.col("lang"))).alias("n_tok"),
        ((keyed_unit("fim:coin", "doc_id") <= 0.5) & (line_count("text") >= 3)).alias("fim"))
    g = d.rollup("lang").agg(F.count("*").alias("n_samples"), F.sum("n_tok").alias("n_tokens"),
                             F.round(F.avg("n_tok"), 6).alias("mean_sequence_length"),
                             F.round(F.avg(F.col("fim").cast("double")), 6).alias("fim_rate"))
    g = g.select(F.coalesce("lang", F.lit("*")).alias("language"), "n_samples", "n_tokens", "mean_sequence_length", "fim_rate")
    from pyspark.sql import Window
    # the rollup output has one row per language plus the total: a bounded window
    total = F.max(F.when(F.col("language") == "*", F.col("n_samples"))).over(Window.partitionBy())
    return g.withColumn("share", F.round(F.col("n_samples") / total, 6))
