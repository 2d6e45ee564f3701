"""Phrase collocations from one count of the longest windows.

Every word opens one window: the word and the up to ``longest - 1`` words after
it in its piece, padded.  In a task these are columns: the word codes, and the
same codes read one, two, three places ahead.  Only distinct windows of full
width are counted; a phrase of fewer words starts wherever a window that it
begins starts, so Spark's ROLLUP over the window's columns, summing over ever
shorter prefixes, gives the counts of all shorter phrases and of all words.

Windows travel packed: a task sends one row a bucket, with the words of that
bucket once and its windows as columns of word numbers.  A window's bucket follows from its
first two words, so a bucket's task knows the exact count of each prefix
of two words or more.  Where a prefix has fewer than ``min_count``, no phrase that
begins with it counts, and the windows are padded from there: what enters the
ROLLUP is about as large as its result.  Pairs of words are counted beforehand in
``SLOTS`` hash slots; windows of a slot that alone would overfill a bucket are
spread by their third word too, and keep their first two.  The number of
buckets follows from the number of words.

Edge cases: null and empty texts have no words; a null lang is ``und`` (and counted
with rows that say ``und``); repeated rows count as often as they occur; ties are broken as stated in
``collocations``; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged

SLOTS = 1 << 16         # hash slots in which word pairs are counted
BUCKET = 2_000_000      # word occurrences that a bucket is meant for
FLUSH = 1_000_000       # word occurrences that a task holds at once
# A-Z become a-z, tab a space, the characters that end a piece a line feed
_BYTES = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_TOKEN = re.compile(rb"[^ \n]+|\n+")
_END = b"\n"


class _Words(dict):
    """Numbers the words of one language; every end of a piece is number 0."""

    def __init__(self):
        super().__init__({_END: 0})
        self.numbers = count(1)

    def __missing__(self, word):
        n = 0 if word[0] == 10 else next(self.numbers)
        self[word] = n
        return n


def _texts(batches, flush: int):
    """(lang, codes by number, flat codes) of up to ``flush`` words at a time."""
    held = {}
    size = 0
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            tokens = _TOKEN.findall(text.encode().translate(_BYTES))
            if not tokens:
                continue
            words, parts = held.setdefault(lang, (_Words(), [np.zeros(1, np.int32)]))
            parts += [np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)), np.zeros(1, np.int32)]
            size += len(tokens)
            if size >= flush:
                yield from _flat(held)
                held, size = {}, 0
    yield from _flat(held)


def _flat(held):
    for lang, (words, parts) in held.items():
        names = [b""] * (max(words.values()) + 1)
        for w, n in words.items():
            if n:
                names[n] = w
        yield lang, names, np.concatenate(parts)


def _hashes(lang: str, names: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in names), np.uint64, len(names))


def _mix(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    h = (first ^ (first >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + second
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


def _windows(flat: np.ndarray, longest: int) -> list[np.ndarray]:
    """Columns of the windows that open at each word; 0 pads."""
    start = np.flatnonzero(flat > 0)
    padded = np.concatenate([flat, np.zeros(longest, flat.dtype)])
    columns = [flat[start].astype(np.int64)]
    for ahead in range(1, longest):
        columns.append(np.where(columns[-1] > 0, padded[start + ahead], 0).astype(np.int64))
    return columns


def _count_slots(longest: int):
    """Task: (slot, n), the windows whose first two words fall in each slot."""

    def run(batches):
        slots = np.zeros(SLOTS, np.int64)
        for lang, names, flat in _texts(batches, FLUSH):
            hashed = _hashes(lang, names)
            one, two = _windows(flat, 2)
            slots += np.bincount((_mix(hashed[one], hashed[two]) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        some = np.flatnonzero(slots)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(slots[some])], names=["slot", "n"])

    return run


def _numbered(columns: list[np.ndarray]) -> np.ndarray:
    """A number for each row, the same for equal rows: column by column, so that
    two numbers always make one 64-bit key."""
    key = columns[0]
    for c in columns[1:]:
        key = pd.factorize(key << 32 | c)[0].astype(np.int64)
    return key


def _squeezed(columns: list[np.ndarray]) -> bytes:
    """Columns of 32-bit numbers, byte by byte so that high bytes pack away."""
    return zlib.compress(b"".join(c.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns), 1)


def _columns(packed: bytes, rows: int) -> list[np.ndarray]:
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(-1, 4, rows)
    return [np.ascontiguousarray(c.T).view("<i4").ravel().astype(np.int64) for c in raw]


def _pack_windows(full: np.ndarray, buckets: int, longest: int):
    """Task: one row a bucket (and language, and FLUSH): its words, and windows as
    numbers of them (0 pads), counts, and whether they are spread.  ``full`` marks
    the slots that are spread by the third word."""

    def run(batches):
        for lang, names, flat in _texts(batches, FLUSH):
            hashed = _hashes(lang, names)
            columns = _windows(flat, longest)
            if not len(columns[0]):
                continue
            number = pd.factorize(_numbered(columns))[0]
            n = np.bincount(number)
            first = np.empty(len(n), np.int64)
            first[number[::-1]] = np.arange(len(number))[::-1]
            columns = [c[first] for c in columns]
            pair = _mix(hashed[columns[0]], hashed[columns[1]])
            wide = full[(pair % np.uint64(SLOTS)).astype(np.int64)]
            spot = np.where(wide, _mix(pair, hashed[columns[2]] if longest > 2 else pair), _mix(pair % np.uint64(SLOTS), np.uint64(1)))
            bucket = ((spot >> np.uint64(7)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((columns[1], columns[0], bucket))
            columns, n, bucket, wide = [c[order] for c in columns], n[order], bucket[order], wide[order]
            ids, begin = np.unique(bucket, return_index=True)
            out = []
            for b, lo, hi in zip(ids.tolist(), begin.tolist(), [*begin[1:].tolist(), len(bucket)]):
                here = [c[lo:hi] for c in columns]
                used = np.zeros(len(names), bool)
                for c in here:
                    used[c] = True
                used[0] = False
                place = np.cumsum(used)  # number of a word in the bucket, from 1
                own = [np.where(c > 0, place[c], 0) for c in here]
                own[0] = np.diff(own[0], prepend=0)  # in order: steps are small
                words = b"\n".join([names[i] for i in np.flatnonzero(used)])
                out.append((b, lang, hi - lo, zlib.compress(words, 1), _squeezed([*own, n[lo:hi], wide[lo:hi]])))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["bucket", "lang", "m", "words", "windows"])

    return run


def _prune_bucket(longest: int, least: int):
    """Task of one bucket: its windows, padded after their longest prefix that counts."""
    w = [f"w{i + 1}" for i in range(longest)]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, rows in pdf.groupby("lang", sort=False):
            lists = [zlib.decompress(x).split(b"\n") for x in rows["words"]]
            number, words = pd.factorize(np.array([x for part in lists for x in part], object))
            parts, at = [], 0
            for part, m, packed in zip(lists, rows["m"].tolist(), rows["windows"]):
                *own, n, wide = _columns(packed, m)
                own[0] = np.cumsum(own[0])
                known = np.append(0, number[at:at + len(part)] + 1)
                parts.append((*[known[c] for c in own], n, wide))
                at += len(part)
            *columns, n, wide = [np.concatenate(x) for x in zip(*parts)]
            keep, prefixes = np.ones(len(n), np.int64), [columns[0]]  # words that stay; a number for each prefix
            for k, c in enumerate(columns[1:], 2):
                prefixes.append(pd.factorize(prefixes[-1] << 32 | c)[0].astype(np.int64))
                often = np.bincount(prefixes[-1], weights=n)[prefixes[-1]] >= least
                keep = np.where((c > 0) & (keep == k - 1) & (often | (wide > 0) if k == 2 else often), k, keep)
            for k in range(1, longest + 1):
                at = np.flatnonzero(keep == k)
                if not len(at):
                    continue
                _, first, group = np.unique(prefixes[k - 1][at], return_index=True, return_inverse=True)
                made = {c: [words[j - 1].decode() for j in col[at[first]]] if i < k else "" for i, (c, col) in enumerate(zip(w, columns))}
                out.append(pd.DataFrame({"lang": lang, **made, "c": np.bincount(group, weights=n[at]).astype(np.int64)}))
        return pd.concat(out)

    return run


def phrase_counts(docs: DataFrame, longest: int = 4, min_count: int = 30, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(lang, words, a) of every phrase of 1 to ``longest`` words (two at least) with at
    least ``min_count`` occurrences, and (lang, n): all word occurrences."""
    own = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    slots = np.zeros(SLOTS, np.int64)  # the driver holds this one table of fixed size
    for r in own.mapInArrow(_count_slots(longest), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        slots[r["slot"]] = r["n"]
    full, buckets = slots > bucket, max(1, -(-int(slots.sum()) // bucket))
    w = [f"w{i + 1}" for i in range(longest)]
    packed = own.mapInArrow(_pack_windows(full, buckets, longest), "bucket long, lang string, m long, words binary, windows binary")
    kept = packed.groupBy("bucket").applyInPandas(_prune_bucket(longest, min_count), f"lang string, {', '.join(f'{x} string' for x in w)}, c long")
    summed = staged(kept.rollup("lang", *w).agg(F.sum("c").alias("a"), F.grouping_id().alias("g")).where((F.col("a") >= min_count) | F.col("w1").isNull()), "collocation-sums")
    # a roll-up of k words has the other columns' bits set; one that ends in padding is a part of the shorter phrase's
    level = F.lit(None)
    for k in range(1, longest + 1):
        level = F.when((F.col("g") == (1 << (longest - k)) - 1) & (F.col(w[k - 1]) != ""), F.array(*w[:k])).otherwise(level)
    phrases = summed.where(F.col("a") >= min_count).select("lang", level.cast("array<string>").alias("words"), "a").where("words IS NOT NULL")
    return phrases, summed.where((F.col("g") == (1 << longest) - 1) & F.col("lang").isNotNull()).select("lang", F.col("a").alias("n"))


def collocations(docs: DataFrame, longest: int = 4, min_count: int = 30, top: int = 2000, nested: tuple[int, int] = (80, 100),
                 bucket: int = BUCKET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases.

    Cutting a phrase of ``a`` occurrences after k words gives parts of l and r
    occurrences; its score is the least floor(2000000 a / (l + r)), ties to the
    smallest k.  A phrase that lies inside a longer one with at least ``nested``
    of its occurrences is dropped.  Order: score and a descending, phrase by its
    UTF-8 bytes."""
    phrases, sizes = phrase_counts(docs, longest, min_count, bucket)
    text = F.array_join("words", " ")
    named = phrases.select("lang", text.alias("phrase"), "words", "a")
    many = named.where(F.size("words") > 1)

    def part(name: str, value: str) -> DataFrame:
        return named.select("lang", F.col("phrase").alias(name), F.col("a").alias(value))

    cuts = many.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("rest"))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"])
    # decimals: 2000000 a may pass 64 bits
    wide = "cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
    least = F.min(F.struct(F.expr(wide).cast("long").alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(least)

    spans = [(i, m) for m in range(2, longest) for i in range(1, longest - m + 2)]
    inner = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in spans])
    inside = many.select("a", "lang", "words", F.explode(inner).alias("s")).where("s.m < size(words) AND s.i + s.m - 1 <= size(words)")
    inside = inside.select("lang", F.array_join(F.expr("slice(words, s.i, s.m)"), " ").alias("phrase"), "a")
    holder = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    num, den = nested
    held = F.expr(f"cast({den} as decimal(10,0)) * cast(longer as decimal(19,0)) >= cast({num} as decimal(10,0)) * cast(a as decimal(19,0))")
    kept = scored.join(holder, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~held)
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
