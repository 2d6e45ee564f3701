"""Registered queries of the numbered operators and their oracle SQL.

Each callable takes (spark, sf_dir), applies its operator with production
parameters to the whole tables and derives the contract's columns from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _fold(mod: int):
    return F.crc32(F.col("doc_id").cast("string")) % mod


@register("op3_quality_gam")
def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels with crc32(doc_id) mod 5 = 0 are
    never learned from.  A null doc_id has no fold and counts as not held out."""
    from tessera.llm import quality_gam
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_gam.fit_quality(docs, labels.where(_fold(5) != 0))
    scored = quality_gam.with_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op1_toxicity_neighbours")
def op1_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels with crc32(doc_id) mod 4 = 2 are
    never learned from.  A null doc_id has no fold and counts as not held out."""
    from tessera.llm import toxicity
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.build_index(docs, labels.where(_fold(4) != 2))
    judged = toxicity.with_toxicity(docs.select("doc_id", "text"), index)
    score = F.col("toxicity.score")
    return judged.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), score.alias("score"),
                         (score >= 0.3).cast("int").alias("predicted"), F.col("toxicity.neighbours").alias("neighbours"),
                         F.col("toxicity.evidence").alias("evidence"))


@register("op4_secret_battery")
def op4_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule spans and randomness-battery spans of every document."""
    from tessera.llm import secret_scan as S
    found = S.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")

    def of(kind: str):
        return F.filter("spans", lambda r: r["rank"] == S.KINDS[kind])

    base = F.filter("spans", lambda r: r["rank"] != S.KINDS["random"])
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(S.span_text(base), 256).alias("base_sha256"), S.span_text(F.col("spans")).alias("spans"),
        F.size(of("random")).cast("long").alias("n_random"))


@register("op5_source_mix")
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    from tessera.llm import mixing
    return mixing.mix(table(spark, sf_dir, "documents"))


@register("op7_ngram_jaccard")
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy classes of all documents: word 4-grams, Jaccard >= 0.85."""
    from tessera.llm import ngram_join
    return ngram_join.near_copy_classes(table(spark, sf_dir, "documents"), words=4, threshold=(85, 100))


def _op2_sql(k: int = 128) -> str:
    """The sketches, edits and likenesses of op2 in DuckDB SQL."""
    ws = r"[\x20\x09-\x0D]+"

    def sketch(text: str) -> str:
        words = f"list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ws}'), lambda w: w <> '')"
        return (f"(SELECT list_sort(list_distinct(list_transform(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) "
                f"WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END, lambda s: md5(s)[1:15])))[1:{k}] FROM (SELECT {words} AS w))")

    def near(a: str, b: str) -> str:
        u = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{k}]"
        return f"CASE WHEN len({u}) = 0 THEN 1.0 ELSE len(list_filter({u}, lambda h: list_contains({a}, h) AND list_contains({b}, h))) / CAST(len({u}) AS DOUBLE) END"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
x AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS nx FROM d),
e AS (SELECT *, substr(text, 1, n - n // 4) || substr(nx, 1, n // 4) AS edited FROM x),
s AS (SELECT *, {sketch('text')} AS a, {sketch('edited')} AS b, {sketch('nx')} AS c FROM e)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
       array_to_string(b, '') AS edited_fingerprint, {near('a', 'b')} AS near_edited, {near('a', 'c')} AS near_next
FROM s"""


@register("op2_bottomk_fingerprints", _op2_sql())
def op2_bottomk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    from tessera.llm import fingerprints as P
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = P.with_next(docs, "doc_id", "text", {"own": P.sketch(F.col("text"))})
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"))
    rows = rows.withColumn("changed", P.sketch(F.col("edited")))
    return rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"), P.fingerprint(F.col("own")).alias("fingerprint"),
                       P.fingerprint(F.col("changed")).alias("edited_fingerprint"),
                       P.resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
                       P.resemblance(F.col("own"), F.col("next_own")).alias("near_next"))


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@register("op10_piece_lattice")
def op10_piece_lattice(spark: SparkSession, sf_dir: str, model: str = PIECE_MODEL) -> DataFrame:
    """Piece ids of every document and whether decoding them gives its text back."""
    from tessera.llm import pieces
    vocabulary = pieces.read_pieces(model)
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    back = pieces.decode(coded, vocabulary)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"), "ids")


@register("op8_epsilon_grid", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (WITH RECURSIVE r(id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.c) SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT r.id AS vec_id, (SELECT count(*) FROM l WHERE l.a = r.id) AS n_links, r.c AS component_id, r.id = r.c AS kept FROM r""")
def op8_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine >= 0.9."""
    from tessera.llm import embed_dedup
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register("op9_snapshot_chats", """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
             count(*) OVER (PARTITION BY conv_id) AS n FROM t),
p AS (SELECT *, string_agg(md5(role || chr(1) || text), ',') OVER (PARTITION BY conv_id ORDER BY pos) AS pre FROM o),
k AS (SELECT min(conv_id) AS conv_id FROM p WHERE pos = n - 1 AND pre NOT IN (SELECT pre FROM p WHERE pos < n - 1) GROUP BY pre)
SELECT p.conv_id, CAST(pos // 512 AS INTEGER) AS part, n AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY pos) AS text,
       length(string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY pos)) AS n_chars
FROM p JOIN k ON p.conv_id = k.conv_id GROUP BY p.conv_id, pos // 512, n""")
def op9_snapshot_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    from tessera.llm import chat
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@register("op6_template_text")
def op6_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from tessera.llm import html_extract
    found = html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op13_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT o.lang, o.source, o.term, CAST(count(*) AS HUGEINT) AS c FROM o JOIN k ON o.lang = k.lang AND o.term = k.term GROUP BY o.lang, o.source, o.term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(total) AS n FROM k GROUP BY lang),
s AS (SELECT g.lang, g.source, coalesce((SELECT sum(c.c) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0) + v.v AS size FROM g JOIN v ON g.lang = v.lang),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c, CAST(1 + (1000000000 * (coalesce(c.c, 0) + 1)) // s.size AS HUGEINT) AS p,
             CAST(1 + (1000000000 * (k.total + 1)) // (v.n + v.v) AS HUGEINT) AS q
      FROM s JOIN k ON s.lang = k.lang JOIN v ON v.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM u)
WHERE part = 'pair' OR rank <= 200""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source of every language and its distinguishing terms."""
    from tessera.llm import divergence
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


@register("op11_phrase_collocations", r"""
WITH p AS (SELECT r, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM (
             SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
             FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, unnest(list_concat(
        list_transform(range(1, len(w) + 1), lambda i: w[i:i]), list_transform(range(1, len(w)), lambda i: w[i:i+1]),
        list_transform(range(1, len(w) - 1), lambda i: w[i:i+2]), list_transform(range(1, len(w) - 2), lambda i: w[i:i+3]))) AS g FROM w),
f AS (SELECT lang, g, array_to_string(g, ' ') AS phrase, count(*) AS a FROM g GROUP BY lang, g HAVING count(*) >= 30),
c AS (SELECT lang, g, phrase, a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1),
s AS (SELECT c.lang, c.g, c.phrase, c.a, c.k, h.a AS l, t.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (h.a + t.a) AS BIGINT) AS score
      FROM c JOIN f h ON h.lang = c.lang AND h.g = c.g[1:c.k] JOIN f t ON t.lang = c.lang AND t.g = c.g[c.k+1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, a, unnest(list_concat([g[1:2], g[2:3]], CASE WHEN len(g) = 4 THEN [g[3:4], g[1:3], g[2:4]] ELSE [] END)) AS g FROM f WHERE len(g) > 2),
m AS (SELECT lang, g, max(a) AS longer FROM i GROUP BY lang, g),
o AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, encode(b.phrase)) AS rank
      FROM b LEFT JOIN m ON m.lang = b.lang AND m.g = b.g WHERE m.longer IS NULL OR CAST(100 AS HUGEINT) * m.longer < CAST(80 AS HUGEINT) * b.a)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000""")
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of every language."""
    from tessera.llm import collocations
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op12_repeated_passages", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i+19], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS rn FROM g) WHERE rn > 1),
c AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM r) GROUP BY doc_id),
s AS (SELECT d.doc_id, d.w, coalesce(c.gone, []) AS gone FROM d LEFT JOIN c ON c.doc_id = d.doc_id),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM s) t
      WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id AS id, unnest(gone) AS j FROM s) x WHERE x.id = t.doc_id AND x.j = t.i) GROUP BY doc_id)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM s LEFT JOIN k ON k.doc_id = s.doc_id""")
def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What removing repeated passages of 20 words leaves of every document."""
    from tessera.llm import substrings
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept_sha256"))
