"""Byte-level BPE queries (T1-T4, byte profile)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import bytebpe as B
from tessera.plans.adapters import table
from tessera.plans.registry import register

VOCAB_SIZE = 2000
_WS = r"\t-\r\x{85}\p{Z}"
_PREFIXED = f"CASE WHEN text = '' OR regexp_matches(text, '^[{_WS}]') THEN text ELSE ' ' || text END"
# RE2 has no look-ahead: a mark is put before the last of several spaces that stand before other text
_BYTE_PIECES = f"""
SELECT unnest(regexp_extract_all(part, '''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_WS}\\p{{L}}\\p{{N}}]+|[{_WS}]+')) AS piece
FROM (SELECT unnest(string_split(regexp_replace({_PREFIXED}, '([{_WS}]+)([{_WS}][^{_WS}])', '\\1' || chr(63743) || '\\2', 'g'), chr(63743))) AS part
      FROM documents)"""


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _model(spark, sf, stats=None):
    return B.learn(B.piece_frequencies(_docs(spark, sf)), VOCAB_SIZE, stats=stats)


@register("t1_byte_piece_frequencies", f"""
SELECT hex(encode(piece)) AS piece_hex, octet_length(encode(piece)) AS n_bytes, count(*) AS n FROM ({_BYTE_PIECES}) GROUP BY piece""")
def q_t1_bytes(spark, sf):
    raw = F.encode("piece", "utf-8")
    return B.piece_frequencies(_docs(spark, sf)).select(F.hex(raw).alias("piece_hex"), F.octet_length("piece").cast("long").alias("n_bytes"), "n")


@register("t2_byte_bpe_vocabulary")
def q_t2_bytes(spark, sf):
    """(id, token_hex, count) of the learned vocabulary; specials and bytes have no count."""
    model = _model(spark, sf)
    names, first = model.vocabulary(), model.base
    rows = [(i, b.hex(), model.counts[i - first] if i >= first else None) for i, b in enumerate(names)]
    return spark.createDataFrame(rows, "id int, token_hex string, count long")


@register("t3_byte_bpe_roundtrip", f"""
SELECT doc_id, sha256({_PREFIXED}) AS decoded_sha256, CAST(octet_length(encode({_PREFIXED})) AS BIGINT) AS n_bytes, TRUE AS shorter FROM documents""")
def q_t3_bytes(spark, sf):
    """Every whole document, encoded and decoded again."""
    model = _model(spark, sf)
    out = B.decode(B.encode(_docs(spark, sf), model), model)
    n = F.octet_length("decoded").cast("long")
    return out.select("doc_id", F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"), n.alias("n_bytes"), (F.size("input_ids") <= n).alias("shorter"))
