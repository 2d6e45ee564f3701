"""Sequence operators: tags, fill-in-the-middle, toy tokeniser, chunking,
packing, padding/masking and shard assignment (P14-P17, T5-T9, W3, W4, S14).

All per-row work is array / string column expressions (codegen'd).  The
only Python is greedy next-fit packing (W4), which is order-dependent and
not a window expression; it runs through ``applyInPandas`` on *lengths
only* over bounded pack groups.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.hashing import keyed_u32, keyed_unit
from tessera.functions.text import col, lines
from tessera.plans.prefix import row_numbers


# --- P14 -----------------------------------------------------------------------

def language_tagged(content, language) -> Column:
    """``<|lang_X|>`` + content + ``<|endoftext|>``."""
    return F.concat(F.lit("<|lang_"), col(language), F.lit("|>"), col(content), F.lit(K.END_OF_TEXT))


# --- P15 / P16 / P17: fill-in-the-middle ---------------------------------------

def fim_lines(content, key, rate: float = K.FIM_RATE, salt: str = "fim") -> dict[str, Column]:
    """Line-level FIM (reference layout, no newline re-added at the cuts).

    Applied when the keyed coin <= rate and the text has >= 3 lines;
    split1 in [1, n-2], split2 in [split1+1, n-1] from independent salts.
    Returns columns ``fim_applied``, ``split1``, ``split2``, ``fim_text``.
    """
    ls = lines(content)
    n = F.size(ls)
    applied = (keyed_unit(salt + ":coin", key) <= F.lit(rate)) & (n >= 3)
    # greatest(.., 1) only guards pmod for texts that are not transformed
    s1 = F.lit(1) + F.pmod(keyed_u32(salt + ":s1", key), F.greatest(n - 2, F.lit(1)))
    s2 = s1 + 1 + F.pmod(keyed_u32(salt + ":s2", key), F.greatest(n - 1 - s1, F.lit(1)))
    prefix = F.array_join(F.slice(ls, 1, s1), "\n")
    middle = F.array_join(F.slice(ls, s1 + 1, s2 - s1), "\n")
    suffix = F.array_join(F.slice(ls, s2 + 1, n - s2), "\n")
    text = F.concat(F.lit(K.FIM_PREFIX), prefix, F.lit(K.FIM_SUFFIX), suffix, F.lit(K.FIM_MIDDLE), middle)
    return {
        "fim_applied": applied,
        "split1": F.when(applied, s1).otherwise(F.lit(0)),
        "split2": F.when(applied, s2).otherwise(F.lit(0)),
        "fim_text": F.when(applied, text).otherwise(col(content)),
    }


def fim_transform(df: DataFrame, content: str = "content", key: str = "id", rate: float = K.FIM_RATE,
                  salt: str = "fim") -> DataFrame:
    cols = fim_lines(F.col(content), F.col(key), rate, salt)
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


def fim_prompt_at_line(content, line) -> Column:
    """``<P>`` lines[:L] ``<S>`` lines[L:] ``<M>``; null when the suffix is empty."""
    ls = lines(content)
    n = F.size(ls)
    L = col(line)
    prefix = F.array_join(F.slice(ls, 1, L), "\n")
    suffix = F.array_join(F.slice(ls, L + 1, n - L), "\n")
    return F.when((L >= 0) & (F.length(suffix) > 0),
                  F.concat(F.lit(K.FIM_PREFIX), prefix, F.lit(K.FIM_SUFFIX), suffix, F.lit(K.FIM_MIDDLE)))


def fim_char_span(content, key, salt: str = "fim_span") -> dict[str, Column]:
    """P17 random-span variant on characters: cut points a <= b in [0, len]."""
    t = col(content)
    n = F.length(t)
    a = F.pmod(keyed_u32(salt + ":a", key), n + 1)
    b = a + F.pmod(keyed_u32(salt + ":b", key), n - a + 1)
    prefix = F.substring(t, 1, a)
    middle = F.substring(t, a + 1, b - a)
    suffix = F.substring(t, b + 1, n - b)
    return {"span_start": a, "span_end": b,
            "fim_text": F.concat(F.lit(K.FIM_PREFIX), prefix, F.lit(K.FIM_SUFFIX), suffix, F.lit(K.FIM_MIDDLE), middle)}


def fim_multi_span(content, key, spans: int = 2, salt: str = "fim_multi") -> Column:
    """P17 multi-span: ``spans`` line gaps, each rendered as its own
    prefix/suffix/middle triple over consecutive line blocks."""
    ls = lines(content)
    n = F.size(ls)
    size = F.greatest(F.lit(1), F.floor(n / spans).cast("int"))
    parts = []
    for i in range(spans):
        start = F.lit(i) * size + 1
        length = F.when(F.lit(i) == spans - 1, n - start + 1).otherwise(size)
        block = F.slice(ls, start, F.greatest(length, F.lit(0)))
        m = F.size(block)
        cut = F.pmod(keyed_u32(f"{salt}:{i}", key), F.greatest(m, F.lit(1))).cast("int")
        parts += [F.lit(K.FIM_PREFIX), F.array_join(F.slice(block, 1, cut), "\n"),
                  F.lit(K.FIM_SUFFIX), F.array_join(F.slice(block, cut + 2, m), "\n"),
                  F.lit(K.FIM_MIDDLE), F.coalesce(F.element_at(block, (cut + 1).cast("int")), F.lit(""))]
    return F.when(n >= spans, F.concat(*parts))


# --- T8: toy code-point tokeniser --------------------------------------------

def codepoint_ids(text, max_chars: int | None = 100, modulo: int = 1000) -> Column:
    """``[ord(c) % modulo for c in text[:max_chars]]`` (None = whole text)."""
    t = col(text)
    if max_chars is not None:
        t = F.substring(t, 1, max_chars)
    ids = F.transform(F.split(t, "", -1), lambda c: F.ascii(c) % modulo)
    return F.when(F.length(t) > 0, ids).otherwise(F.array().cast("array<int>"))


def ids_digest(ids) -> dict[str, Column]:
    a = col(ids)
    return {"n_tokens": F.size(a), "id_sum": F.aggregate(a, F.lit(0).cast("bigint"), lambda acc, x: acc + x)}


# --- W3: chunking -------------------------------------------------------------

def chunk(df: DataFrame, ids: str = "input_ids", max_length: int = K.CHUNK_LENGTH,
          min_length: int = K.MIN_CHUNK_LENGTH) -> DataFrame:
    """Windows of ``max_length``; chunks shorter than ``min_length`` dropped."""
    starts = F.sequence(F.lit(0), F.size(F.col(ids)) - 1, F.lit(max_length))
    out = df.select("*", F.posexplode(F.when(F.size(F.col(ids)) > 0, starts)).alias("chunk_idx", "chunk_start"))
    out = out.withColumn(ids, F.slice(F.col(ids), F.col("chunk_start") + 1, max_length))
    return out.where(F.size(F.col(ids)) >= min_length).drop("chunk_start")


# --- W4: greedy next-fit packing ---------------------------------------------

def _next_fit(order_cols: list[str], max_length: int):
    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order_cols, kind="stable")
        lengths = pdf["length"].to_numpy()
        blocks = np.empty(len(lengths), dtype=np.int64)
        b, fill = 0, 0
        for i, n in enumerate(lengths):
            if fill + n <= max_length:
                fill += n
            else:
                if fill > 0:
                    b += 1
                fill = n
            blocks[i] = b
        return pdf[["pack_group", *order_cols]].assign(block=blocks)
    return assign


def pack_assign(df: DataFrame, order_cols: list[str], length_col: str, group_cols=(),
                max_length: int = K.BLOCK_LENGTH, ids_per_group: int = 4096) -> DataFrame:
    """Block number per sequence under next-fit in ``order_cols`` order.

    Pack group = (group_cols..., first order column div ``ids_per_group``): a
    fixed function of the row, so unrelated rows never change a block, and one
    pandas call sees the rows of that many ids.  Only ``(group, order,
    length)`` crosses into Python.  Returns the input plus ``pack_group``
    and ``block``.
    """
    parts = [F.col(c).cast("string") for c in group_cols] + [
        F.floor(F.col(order_cols[0]) / F.lit(ids_per_group)).cast("string")]
    keyed = df.withColumn("pack_group", F.concat_ws("|", *parts))
    narrow = keyed.select("pack_group", *order_cols, F.col(length_col).alias("length"))
    kinds = ", ".join(f"{c} {narrow.schema[c].dataType.simpleString()}" for c in order_cols)
    assigned = narrow.groupBy("pack_group").applyInPandas(_next_fit(order_cols, max_length), f"pack_group string, {kinds}, block long")
    return keyed.join(assigned, ["pack_group", *order_cols])


def pack(df: DataFrame, ids: str, order_col, group_cols=(), max_length: int = K.BLOCK_LENGTH,
         ids_per_group: int = 4096) -> DataFrame:
    """Packed blocks ``(pack_group, block, input_ids, length, n_seqs)``.

    ``order_col`` is a column or a list of columns that order the sequences.
    Blocks are assembled by grouping on (pack_group, block): each group is
    bounded by ``max_length`` tokens (a single over-long sequence forms its
    own block, as in the reference).
    """
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    a = pack_assign(df.withColumn("_len", F.size(F.col(ids))), order, "_len", group_cols, max_length, ids_per_group)
    key = F.struct(*[F.col(c) for c in order]).alias("o")
    blocks = (a.groupBy("pack_group", "block")
              .agg(F.array_sort(F.collect_list(F.struct(key, F.col(ids).alias("ids")))).alias("parts"),
                   F.count("*").alias("n_seqs"), F.sum("_len").alias("length")))
    return blocks.select("pack_group", "block", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("input_ids"),
                         "length", "n_seqs")


# --- S14: shards ----------------------------------------------------------------

def shard_ids(df: DataFrame, order_cols, per_shard: int = K.BLOCKS_PER_SHARD, materialize: bool = True) -> DataFrame:
    """Global row number (skew-safe prefix scan) -> ``shard_id``, ``shard_name``.
    Blocks come out of packing (expensive): materialised before ranking."""
    rn = row_numbers(df, [], order_cols, "block_rank", materialize=materialize)
    sid = F.floor((F.col("block_rank") - 1) / per_shard).cast("bigint")
    return rn.withColumn("shard_id", sid).withColumn("shard_name", F.format_string("shard_%05d", sid))


# --- T5 / T6 / T7 ---------------------------------------------------------------

def truncate_pad(ids, max_length: int, pad_id: int = 0) -> dict[str, Column]:
    """T5: slice to ``max_length``, right-pad, attention mask."""
    a = F.slice(col(ids), 1, max_length)
    pad = F.greatest(F.lit(max_length) - F.size(a), F.lit(0))
    return {"input_ids": F.concat(a, F.array_repeat(F.lit(pad_id), pad)),
            "attention_mask": F.concat(F.array_repeat(F.lit(1), F.size(a)), F.array_repeat(F.lit(0), pad))}


def masked_labels(input_ids, attention_mask, prompt_len, mask_extra: int = 2,
                  ignore: int = K.IGNORE_INDEX) -> Column:
    """labels = ids, with ``ignore`` on padding and the first
    ``prompt_len + mask_extra`` positions."""
    width = col(prompt_len) + mask_extra
    return F.transform(F.arrays_zip(col(input_ids).alias("x"), col(attention_mask).alias("m")),
                       lambda z, i: F.when((z["m"] == 0) | (i < width), F.lit(ignore)).otherwise(z["x"]))


def shifted_pairs(logits_or_ids, labels) -> Column:
    """Element i of input with element i+1 of labels."""
    a, b = col(logits_or_ids), col(labels)
    return F.arrays_zip(F.slice(a, 1, F.size(a) - 1).alias("x"), F.slice(b, 2, F.size(b) - 1).alias("y"))
