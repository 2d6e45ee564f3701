"""Document fingerprints: bottom-k sketches of word-shingle hashes, in SQL functions.

A sketch is the sorted array of the k least distinct shingle hashes (60 bits of
MD5).  Sketches of parts merge into the sketch of the whole; two sketches
estimate resemblance and containment of their shingle sets, and one estimates
its number of distinct shingles.  With fewer than k shingles a sketch is the
whole set and the estimates are exact.

Edge cases: null text counts as empty; a text of fewer words than a shingle has
its word sequence as its one shingle; a text without words has an empty sketch,
like only to another empty one.  A-Z count as a-z.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import RADIX_BITS, SPACE, staged, successors

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGITS = 15  # hex digits of MD5 that make a hash: below 2^60


def sketch(text: Column, k: int = 128, words: int = 5) -> Column:
    """Bottom-k sketch of a text: array of at most ``k`` longs, ascending."""
    parts = F.filter(F.split(F.translate(text, UPPER, LOWER), f"[{SPACE}]+"), lambda w: w != "")

    def of(parts: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(parts) - (words - 1)), lambda i: F.array_join(F.slice(parts, i, words), " "))
        one = F.array(F.array_join(parts, " "))
        shingles = F.when(F.size(parts) >= words, many).when(F.size(parts) > 0, one).otherwise(F.array().cast("array<string>"))
        hashes = F.transform(shingles, lambda s: F.substring(F.md5(F.encode(s, "utf-8")), 1, DIGITS))
        return F.transform(F.slice(F.array_sort(F.array_distinct(hashes)), 1, k), lambda h: F.conv(h, 16, 10).cast("long"))

    # a transform over one element names the words, which are used several times
    return F.element_at(F.transform(F.array(parts), of), 1)


def merge(a: Column, b: Column, k: int = 128) -> Column:
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, key: str, col: str, k: int = 128, salts: int = 64) -> DataFrame:
    """(``key``, ``col``) rows of part sketches -> one sketch per key.  Hashes are
    ranked in ``salts`` slices of a key first, so a hot key is spread out.  Null
    and empty sketches add nothing; a key that has only such gets an empty one."""
    one = parts.select(key, F.explode(col).alias("h")).distinct().withColumn("s", F.pmod(F.xxhash64("h"), F.lit(salts)))
    for group in ([key, "s"], [key]):
        one = one.withColumn("r", F.row_number().over(Window.partitionBy(*group).orderBy("h"))).where(F.col("r") <= k)
    sketches = one.groupBy(F.col(key).alias("__k")).agg(F.array_sort(F.collect_list("h")).alias(col))
    return (parts.select(key).distinct().join(sketches, F.col(key).eqNullSafe(F.col("__k")), "left")
            .select(key, F.coalesce(col, F.array().cast("array<bigint>")).alias(col)))


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated Jaccard similarity; 1 for two empty sketches."""
    def of(u: Column) -> Column:
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.element_at(F.transform(F.array(merge(a, b, k)), of), 1)


def distinct_shingles(a: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(float(16 ** DIGITS)) / F.element_at(a, k))


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 if ``a`` is empty."""
    union = distinct_shingles(merge(a, b, k), k)
    share = resemblance(a, b, k) * union / F.greatest(distinct_shingles(a, k), F.lit(1.0))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def fingerprint(a: Column) -> Column:
    """The sketch as text: its hashes in hex, ``DIGITS`` each."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), DIGITS, "0"))), "")


def with_next(docs: DataFrame, order: str, text: str, derived: dict[str, Column]) -> DataFrame:
    """Rows (``order``, ``text``, the ``derived`` columns of the text) with the same
    columns of the next row as ``next_<name>``; the last row's next is the first.

    Rows of 512 neighbouring ids share a window, and each such bucket also gets
    the first row of the bucket after it.  Null ids come first, in a bucket of
    their own; rows of one id are ordered by their texts' hash, then text."""
    place = F.coalesce(F.col(order).cast("long"), F.lit(-(2 ** 63)).cast("long"))
    rows = docs.select(order, text, place.alias("__at"), F.shiftright(place, RADIX_BITS).alias("__b"),
                       F.xxhash64(text).alias("__h"), F.lit(0).alias("__extra"))
    heads = rows.groupBy("__b").agg(F.min(F.struct("__at", "__h", text)).alias("r"))
    follow = staged(successors(rows, "__b"), "fingerprint-buckets")
    first = follow.agg(F.min("key")).first()[0]
    follow = follow.select(F.col("key").alias("__to"), F.coalesce("next", F.lit(first)).alias("__b"))
    extra = heads.join(follow, "__b").select(F.lit(None).cast(rows.schema[order].dataType).alias(order), F.col(f"r.{text}").alias(text),
                                             "r.__at", F.col("__to").alias("__b"), "r.__h", F.lit(1).alias("__extra"))
    both = rows.unionByName(extra).withColumns(derived)
    w = Window.partitionBy("__b").orderBy("__extra", "__at", "__h", text)
    carried = [text, *derived]
    both = both.withColumns({f"next_{c}": F.lead(c).over(w) for c in carried})
    return both.where("__extra = 0").select(order, *carried, *[f"next_{c}" for c in carried])
