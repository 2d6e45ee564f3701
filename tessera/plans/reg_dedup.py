"""Deduplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import dedup as D
from tessera.plans.adapters import table
from tessera.plans.registry import register

PYS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
P31 = D.MERSENNE_31


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "text")


@register("d1_exact_dedup", """
SELECT doc_id, lang, sha256(text) AS content_hash,
       doc_id = min(doc_id) OVER (PARTITION BY lang, sha256(text)) AS is_first
FROM documents""")
def q_d1(spark, sf):
    return D.exact_dedup_flags(_docs(spark, sf), "text", "doc_id", ["lang"]).select(
        "doc_id", "lang", "content_hash", "is_first")


@register("d5_dedup_rate", """
WITH f AS (SELECT lang, doc_id = min(doc_id) OVER (PARTITION BY lang, sha256(text)) AS is_first FROM documents)
SELECT lang AS language, count(*) AS n_total, count(*) FILTER (WHERE is_first) AS n_kept,
       round(1 - count(*) FILTER (WHERE is_first) / count(*), 6) AS dedup_rate
FROM f GROUP BY lang""")
def q_d5(spark, sf):
    f = D.exact_dedup_flags(_docs(spark, sf), "text", "doc_id", ["lang"]).withColumnRenamed("lang", "language")
    return D.dedup_rate(f, "is_first", ["language"])


@register("d6_normalized_dedup", f"""
WITH n AS (SELECT doc_id, regexp_replace(lower(regexp_replace(text, '^[{PYS} ]+|[{PYS} ]+$', '', 'g')), '[{PYS}]+', ' ', 'g') AS norm
           FROM documents)
SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY norm) AS is_first FROM n""")
def q_d6(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", D.normalized_prompt(F.col("text")).alias("norm"))
    return D.exact_dedup_flags(d, "norm", "doc_id").select("doc_id", "is_first")


_PERMS_SQL = f"""perms AS (
  SELECT i, CAST(('0x' || substr(md5('minhash:a:' || CAST(i AS VARCHAR)), 1, 8)) AS BIGINT) % {P31 - 1} + 1 AS a,
            CAST(('0x' || substr(md5('minhash:b:' || CAST(i AS VARCHAR)), 1, 8)) AS BIGINT) % {P31} AS b
  FROM range(128) t(i)),
toks AS (SELECT DISTINCT doc_id, lang, unnest(list_filter(string_split_regex(text, '[{PYS}]+'), lambda x: x <> '')) AS tok FROM documents),
h AS (SELECT DISTINCT doc_id, lang, CAST(('0x' || substr(md5(tok), 1, 8)) AS BIGINT) AS h FROM toks),
sig AS (SELECT doc_id, lang, i, min((a * h + b) % {P31}) AS v FROM h, perms GROUP BY doc_id, lang, i)"""


@register("d2_minhash_signature", f"""
WITH {_PERMS_SQL}
SELECT doc_id, min(v) AS sig_min, CAST(sum(v) AS BIGINT) AS sig_sum, count(*) AS n_perm FROM sig GROUP BY doc_id""")
def q_d2(spark, sf):
    s = D.signatures(_docs(spark, sf), "text", "doc_id").withColumnRenamed("signature", "sig")
    return s.select("doc_id", F.array_min("sig").alias("sig_min"),
                    F.aggregate("sig", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("sig_sum"),
                    F.size("sig").alias("n_perm"))


@register("d3_lsh_earlier_collisions", f"""
WITH {_PERMS_SQL},
s AS (SELECT doc_id, lang, list(v ORDER BY i) AS sig FROM sig GROUP BY doc_id, lang),
m AS (SELECT doc_id, lang, b AS band, s.sig[b * 16 + 1 : b * 16 + 16] AS part FROM s, range(8) t(b)),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY lang, band, part) AS first_id FROM m)
SELECT doc_id, count(*) FILTER (WHERE first_id < doc_id) AS bands_with_earlier FROM f GROUP BY doc_id""")
def q_d3_collisions(spark, sf):
    return D.earlier_collisions(_docs(spark, sf), "text", "doc_id", ["lang"])


def _edges_sql(threshold: float) -> str:
    """All pairs (a before b) of a language whose token sets have Jaccard >= threshold."""
    return f"""toks AS MATERIALIZED (SELECT DISTINCT doc_id, lang, unnest(list_filter(string_split_regex(text, '[{PYS}]+'), lambda x: x <> '')) AS tok FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM toks GROUP BY doc_id),
s AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM toks a JOIN toks b ON a.lang IS NOT DISTINCT FROM b.lang AND a.tok = b.tok AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS MATERIALIZED (SELECT a, b FROM s JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE s / CAST(x.n + y.n - s AS DOUBLE) >= {threshold})"""


def _first_wins_sql(threshold: float) -> str:
    """In the order of the ids, a document goes iff an earlier near copy has not gone."""
    return f"""WITH RECURSIVE {_edges_sql(threshold)},
c AS MATERIALIZED (SELECT b AS id, list(a) AS before, row_number() OVER (ORDER BY b) AS pos FROM e GROUP BY b),
k(i, gone) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
  SELECT i + 1, CASE WHEN len(list_filter(before, lambda x: NOT list_contains(gone, x))) > 0 THEN list_append(gone, id) ELSE gone END FROM k JOIN c ON pos = i + 1),
g AS (SELECT unnest(gone) AS doc_id FROM k WHERE i = (SELECT max(i) FROM k)),
r AS (SELECT doc_id, lang, doc_id NOT IN (SELECT doc_id FROM g) AS near_dup_kept FROM documents)
"""


def _near_dup(spark, sf, **p):
    from tessera.operators import neardup as N
    return N.near_dup(_docs(spark, sf), "text", "doc_id", ["lang"], N.Verified(**p)).select("doc_id", "lang", "near_dup_kept")


@register("d3_near_dup_first_wins", _first_wins_sql(0.85) + "SELECT * FROM r")
def q_d3_first_wins(spark, sf):
    """A document is dropped iff a kept earlier one of its language has Jaccard >= 0.85."""
    return _near_dup(spark, sf)


@register("d3_near_dup_components", f"""WITH RECURSIVE {_edges_sql(0.85)},
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
c AS (SELECT a AS id, a AS reach FROM u UNION SELECT c.id, u.b FROM c JOIN u ON u.a = c.reach),
m AS (SELECT id, min(reach) AS first FROM c GROUP BY id)
SELECT doc_id, lang, coalesce(m.first = doc_id, TRUE) AS near_dup_kept FROM documents LEFT JOIN m ON m.id = doc_id""")
def q_d3_components(spark, sf):
    """The first document of each connected component of near copies stays."""
    return _near_dup(spark, sf, mode="component")


@register("d4_near_dup_rate", _first_wins_sql(0.85) + """SELECT lang AS language, count(*) AS n_total, count(*) FILTER (WHERE near_dup_kept) AS n_kept,
       round(1 - count(*) FILTER (WHERE near_dup_kept) / count(*), 6) AS dedup_rate FROM r GROUP BY lang""")
def q_d4_rate(spark, sf):
    """Per-language near-dup rate (scope = language)."""
    return D.dedup_rate(_near_dup(spark, sf).withColumnRenamed("lang", "language"), "near_dup_kept", ["language"])


@register("d3_near_dup_threshold_07", _first_wins_sql(0.7) + "SELECT * FROM r")
def q_d3_t07(spark, sf):
    """Second threshold (0.7): bands x rows derived from the threshold."""
    return _near_dup(spark, sf, threshold=0.7)
