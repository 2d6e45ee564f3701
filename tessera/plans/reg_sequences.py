"""Sequence-path queries: tags, FIM, tokenisers, chunking, packing, shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.hashing import keyed_u32, sql_u32, sql_unit
from tessera.operators import bpe as B
from tessera.operators import sequences as S
from tessera.plans.adapters import SQL_PAIRS, prompt_response_pairs, table
from tessera.plans.registry import register

PYS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "text")


# --- P14 ----------------------------------------------------------------------------

@register("p14_language_tag", """
SELECT doc_id, md5('<|lang_' || lang || '|>' || text || '<|endoftext|>') AS tagged_md5,
       length('<|lang_' || lang || '|>' || text || '<|endoftext|>') AS n_chars
FROM documents""")
def q_p14(spark, sf):
    t = S.language_tagged(F.col("text"), F.col("lang"))
    return _docs(spark, sf).select("doc_id", F.md5(t).alias("tagged_md5"), F.length(t).alias("n_chars"))


# --- P15 ------------------------------------------------------------------------------

_FIM_SQL = f"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls, len(string_split(text, chr(10))) AS n FROM documents),
s AS (SELECT *, {sql_unit('fim:coin', 'doc_id')} <= 0.5 AND n >= 3 AS fim_applied,
             1 + {sql_u32('fim:s1', 'doc_id')} % greatest(n - 2, 1) AS s1 FROM l),
t AS (SELECT *, s1 + 1 + {sql_u32('fim:s2', 'doc_id')} % greatest(n - 1 - s1, 1) AS s2 FROM s)
SELECT doc_id, fim_applied,
  CASE WHEN fim_applied THEN s1 ELSE 0 END AS split1, CASE WHEN fim_applied THEN s2 ELSE 0 END AS split2,
  md5(CASE WHEN fim_applied THEN '<|fim_prefix|>' || array_to_string(ls[1:s1], chr(10))
        || '<|fim_suffix|>' || array_to_string(ls[s2 + 1:n], chr(10))
        || '<|fim_middle|>' || array_to_string(ls[s1 + 1:s2], chr(10)) ELSE text END) AS fim_md5
FROM t"""


@register("p15_fim_lines", _FIM_SQL)
def q_p15(spark, sf):
    cols = S.fim_lines(F.col("text"), F.col("doc_id"))
    return _docs(spark, sf).select("doc_id", cols["fim_applied"].alias("fim_applied"), cols["split1"].alias("split1"),
                                   cols["split2"].alias("split2"), F.md5(cols["fim_text"]).alias("fim_md5"))


# --- P16 ------------------------------------------------------------------------------

@register("p16_fim_prompt_at_line", f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls, len(string_split(text, chr(10))) AS n FROM documents),
c AS (SELECT *, {sql_u32('fim_line', 'doc_id')} % n AS line FROM l),
p AS (SELECT doc_id, line, array_to_string(ls[1:line], chr(10)) AS prefix, array_to_string(ls[line + 1:n], chr(10)) AS suffix FROM c)
SELECT doc_id, line, CASE WHEN length(suffix) > 0 THEN md5('<|fim_prefix|>' || prefix || '<|fim_suffix|>' || suffix || '<|fim_middle|>') END AS prompt_md5
FROM p""")
def q_p16(spark, sf):
    from tessera.functions.text import line_count
    d = _docs(spark, sf).withColumn("line", F.pmod(keyed_u32("fim_line", "doc_id"), line_count("text")))
    return d.select("doc_id", "line", F.md5(S.fim_prompt_at_line(F.col("text"), F.col("line"))).alias("prompt_md5"))


# --- P17 ------------------------------------------------------------------------------

@register("p17_fim_char_span", f"""
WITH l AS (SELECT doc_id, text, length(text) AS n, {sql_u32('fim_span:a', 'doc_id')} % (length(text) + 1) AS a FROM documents),
s AS (SELECT *, a + {sql_u32('fim_span:b', 'doc_id')} % (n - a + 1) AS b FROM l)
SELECT doc_id, a AS span_start, b AS span_end,
  md5('<|fim_prefix|>' || substring(text, 1, a) || '<|fim_suffix|>' || substring(text, b + 1, n - b)
      || '<|fim_middle|>' || substring(text, a + 1, b - a)) AS fim_md5
FROM s""")
def q_p17(spark, sf):
    c = S.fim_char_span(F.col("text"), F.col("doc_id"))
    return _docs(spark, sf).select("doc_id", c["span_start"].cast("bigint").alias("span_start"),
                                   c["span_end"].cast("bigint").alias("span_end"), F.md5(c["fim_text"]).alias("fim_md5"))


def _multi_span_sql(spans: int = 3) -> str:
    blocks = []
    for i in range(spans):
        length = "n - (%d * sz + 1) + 1" % i if i == spans - 1 else "sz"
        blocks.append(f"""SELECT doc_id, n, {i} AS i, ls[{i} * sz + 1 : {i} * sz + 1 + ({length}) - 1] AS block,
  {sql_u32(f'fim_multi:{i}', 'doc_id')} AS h FROM s""")
    return f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls, len(string_split(text, chr(10))) AS n FROM documents),
s AS (SELECT *, greatest(1, CAST(floor(n / {spans}) AS INTEGER)) AS sz FROM l),
b AS ({" UNION ALL ".join(blocks)}),
c AS (SELECT *, h % greatest(len(block), 1) AS cut FROM b),
p AS (SELECT doc_id, n, i, '<|fim_prefix|>' || array_to_string(block[1:cut], chr(10)) || '<|fim_suffix|>'
        || array_to_string(block[cut + 2:len(block)], chr(10)) || '<|fim_middle|>' || coalesce(block[cut + 1], '') AS part FROM c)
SELECT doc_id, CASE WHEN n >= {spans} THEN md5(string_agg(part, '' ORDER BY i)) END AS fim_md5 FROM p GROUP BY doc_id, n"""


@register("p17_fim_multi_span", _multi_span_sql(3))
def q_p17_multi(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(S.fim_multi_span(F.col("text"), F.col("doc_id"), 3)).alias("fim_md5"))


# --- T8 -------------------------------------------------------------------------------

@register("t8_toy_tokenizer", """
WITH t AS (SELECT doc_id, CASE WHEN length(text) = 0 THEN []::INTEGER[]
            ELSE list_transform(string_split(substring(text, 1, 100), ''), lambda c: unicode(c) % 1000) END AS ids FROM documents)
SELECT doc_id, len(ids) AS n_tokens, CAST(coalesce(list_sum(ids), 0) AS BIGINT) AS id_sum, array_to_string(ids, ' ') AS ids FROM t""")
def q_t8(spark, sf):
    """T8 is the reference's stand-in tokeniser, defined on the first 100
    characters; the chunking/packing path (W3, W4, S14) tokenises whole texts."""
    ids = S.codepoint_ids(F.col("text"))
    d = S.ids_digest(ids)
    return _docs(spark, sf).select("doc_id", d["n_tokens"].alias("n_tokens"), d["id_sum"].alias("id_sum"),
                                   F.array_join(ids, " ").alias("ids"))


# --- W3 / W4 / S14 --------------------------------------------------------------------

def _chunks(spark, sf, max_length=K.CHUNK_LENGTH):
    d = _docs(spark, sf).select("doc_id", "lang",
                                S.codepoint_ids(S.language_tagged(F.col("text"), F.col("lang")), None).alias("input_ids"))
    return S.chunk(d, "input_ids", max_length, K.MIN_CHUNK_LENGTH)


_CHUNK_SQL = """
tagged AS (SELECT doc_id, lang, '<|lang_' || lang || '|>' || text || '<|endoftext|>' AS t FROM documents),
ids AS (SELECT doc_id, lang, list_transform(string_split(t, ''), lambda c: unicode(c) % 1000) AS ids FROM tagged),
st AS (SELECT doc_id, lang, ids, unnest(generate_series(0, len(ids) - 1, 4096)) AS st FROM ids),
ch AS (SELECT doc_id, lang, st // 4096 AS chunk_idx, ids[st + 1 : st + 4096] AS c FROM st WHERE len(ids[st + 1 : st + 4096]) >= 100)"""


@register("w3_chunks", f"""
WITH {_CHUNK_SQL}
SELECT doc_id, chunk_idx, len(c) AS n_tokens, CAST(list_sum(c) AS BIGINT) AS id_sum FROM ch""")
def q_w3(spark, sf):
    c = _chunks(spark, sf)
    d = S.ids_digest(F.col("input_ids"))
    return c.select("doc_id", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), d["n_tokens"].alias("n_tokens"),
                    d["id_sum"].alias("id_sum"))


_PACK_IDS = 256
_PACK_SQL = f"""
WITH RECURSIVE {_CHUNK_SQL},
o0 AS (SELECT doc_id, chunk_idx, len(c) AS n, concat_ws('|', lang, CAST(doc_id // {_PACK_IDS} AS VARCHAR)) AS pack_group FROM ch),
o AS MATERIALIZED (SELECT pack_group, n, row_number() OVER (PARTITION BY pack_group ORDER BY doc_id, chunk_idx) AS rn FROM o0),
r AS (SELECT pack_group, rn, n, 0 AS block, n AS fill FROM o WHERE rn = 1
      UNION ALL
      SELECT x.pack_group, x.rn, x.n,
             CASE WHEN r.fill + x.n <= 4096 THEN r.block ELSE r.block + 1 END,
             CASE WHEN r.fill + x.n <= 4096 THEN r.fill + x.n ELSE x.n END
      FROM r JOIN o x ON x.pack_group = r.pack_group AND x.rn = r.rn + 1)"""


def _packed(spark, sf):
    return S.pack(_chunks(spark, sf), "input_ids", ["doc_id", "chunk_idx"], ["lang"], ids_per_group=_PACK_IDS)


@register("w4_pack_blocks", _PACK_SQL + """
SELECT pack_group, CAST(block AS BIGINT) AS block, CAST(sum(n) AS BIGINT) AS length, count(*) AS n_seqs FROM r GROUP BY pack_group, block""")
def q_w4(spark, sf):
    return _packed(spark, sf).select("pack_group", "block", "length", "n_seqs")


@register("s14_shard_assignment", _PACK_SQL + """,
b AS (SELECT DISTINCT pack_group, block FROM r)
SELECT pack_group, CAST(block AS BIGINT) AS block, (row_number() OVER (ORDER BY pack_group, block) - 1) // 20 AS shard_id,
       printf('shard_%05d', (row_number() OVER (ORDER BY pack_group, block) - 1) // 20) AS shard_name
FROM b""")
def q_s14(spark, sf):
    blocks = _packed(spark, sf).select("pack_group", "block")
    return S.shard_ids(blocks, ["pack_group", "block"], per_shard=20).select("pack_group", "block", "shard_id", "shard_name")


# --- T5 / T6 / T9 -------------------------------------------------------------------

@register("t5_truncate_pad", """
WITH t AS (SELECT doc_id, list_transform(string_split(substring(text, 1, 100), ''), lambda c: unicode(c) % 1000) AS ids FROM documents WHERE length(text) > 0),
p AS (SELECT doc_id, ids[1:64] AS a FROM t)
SELECT doc_id, len(a) AS n_real, 64 AS padded_length, CAST(list_sum(a) AS BIGINT) AS id_sum FROM p""")
def q_t5(spark, sf):
    d = _docs(spark, sf).where(F.length("text") > 0)
    tp = S.truncate_pad(S.codepoint_ids(F.col("text")), 64)
    return d.select("doc_id", F.aggregate(tp["attention_mask"], F.lit(0), lambda a, x: a + x).alias("n_real"),
                    F.size(tp["input_ids"]).alias("padded_length"),
                    F.aggregate(tp["input_ids"], F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"))


@register("t5_truncate_pad_whole", """
WITH t AS (SELECT doc_id, CASE WHEN length(text) > 0 THEN list_transform(string_split(text, ''), lambda c: unicode(c) % 1000) ELSE [] END AS ids FROM documents),
p AS (SELECT doc_id, ids[1:512] AS a FROM t)
SELECT doc_id, len(a) AS n_real, 512 AS padded_length, CAST(coalesce(list_sum(a), 0) AS BIGINT) AS id_sum FROM p""")
def q_t5_whole(spark, sf):
    """As ``t5_truncate_pad`` from whole texts to 512 ids; an empty text is all padding."""
    tp = S.truncate_pad(S.codepoint_ids(F.coalesce("text", F.lit("")), None), 512)
    return _docs(spark, sf).select("doc_id", F.aggregate(tp["attention_mask"], F.lit(0), lambda a, x: a + x).alias("n_real"),
                                   F.size(tp["input_ids"]).alias("padded_length"),
                                   F.aggregate(tp["input_ids"], F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"))


@register("t6_label_mask", f"""
WITH p AS ({SQL_PAIRS}),
t AS (SELECT conv_id, turn, length(prompt) AS plen,
             list_transform(string_split(prompt || chr(10) || chr(10) || response, ''), lambda c: unicode(c) % 1000)[1:512] AS ids FROM p),
l AS (SELECT conv_id, turn, list_transform(ids, lambda x, i: CASE WHEN i - 1 < plen + 2 THEN -100 ELSE x END) AS labels FROM t)
SELECT conv_id, turn, len(list_filter(labels, lambda x: x <> -100)) AS n_label_tokens,
       CAST(coalesce(list_sum(list_filter(labels, lambda x: x <> -100)), 0) AS BIGINT) AS label_sum,
       512 - len(labels) AS n_pad
FROM l""")
def q_t6(spark, sf):
    p = prompt_response_pairs(spark, sf)
    ids = S.codepoint_ids(F.concat("prompt", F.lit("\n\n"), "response"), None)
    tp = S.truncate_pad(ids, 512)
    labels = S.masked_labels(tp["input_ids"], tp["attention_mask"], F.length("prompt"))
    kept = F.filter(labels, lambda x: x != K.IGNORE_INDEX)
    return p.select("conv_id", "turn", F.size(kept).alias("n_label_tokens"),
                    F.aggregate(kept, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("label_sum"),
                    (F.lit(512) - F.aggregate(tp["attention_mask"], F.lit(0), lambda a, x: a + x)).alias("n_pad"))


@register("t9_token_budget", """
SELECT lang AS language, CAST(sum(length(text)) AS BIGINT) AS n_tokens, round(sum(length(text)) / 20.0, 6) AS optimal_params
FROM documents GROUP BY lang""")
def q_t9(spark, sf):
    g = _docs(spark, sf).groupBy(F.col("lang").alias("language")).agg(F.sum(F.length("text")).alias("n_tokens"))
    return g.withColumn("optimal_params", F.round(F.col("n_tokens") / 20.0, 6))


# --- T1 / A21 / T2 / T3 ------------------------------------------------------------

_PRE = B.PRETOKEN_PATTERN.replace("'", "''")


@register("t1_piece_frequencies", f"""
SELECT piece, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{_PRE}')) AS piece FROM documents) GROUP BY piece""")
def q_t1(spark, sf):
    return B.piece_frequencies(_docs(spark, sf))


@register("a21_vocabulary", f"""
WITH f AS (SELECT piece, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{_PRE}')) AS piece FROM documents) GROUP BY piece)
SELECT piece, n FROM f WHERE n >= 2 ORDER BY n DESC, piece LIMIT 500""")
def q_a21(spark, sf):
    return B.top_vocabulary(B.piece_frequencies(_docs(spark, sf)), 500, 2)


@register("t2_bpe_merges")
def q_t2(spark, sf):
    _, merges = B.learn_merges(B.piece_frequencies(_docs(spark, sf)), num_merges=8)
    return merges


VOCAB_SIZE = 32_000  # as the reference trains its tokenizer


@register("t3_bpe_encode")
def q_t3(spark, sf):
    """Merges up to a vocabulary of ``VOCAB_SIZE`` entries, or until no pair occurs twice."""
    model, _ = B.learn_merges(B.piece_frequencies(_docs(spark, sf)), vocab_size=VOCAB_SIZE)
    enc = B.encode(_docs(spark, sf).withColumnRenamed("doc_id", "id"), model)
    return enc.select("id", F.size("input_ids").alias("n_tokens"))
