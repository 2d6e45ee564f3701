"""Mixing sources to target weights.

The words of each source are packed, in document order, into blocks of a fixed
length.  Output slots, one block each, are grouped into shards; every shard
draws its source counts from a multinomial over the sources' quotas, and draws
beyond a source's quota pass in order to sources that are short of theirs, so
totals meet the quotas.  A source's n-th slot takes the block that a
pseudorandom permutation of its block indices names; each pass over the source
has a permutation of its own.  Slots and blocks meet in a join on (source,
block index), and a document's taken words are the sum over its blocks.

Everything is a join, a grouping or a window over a bounded key range: running
sums use ``common.running_total``, so a hot source is spread over many tasks.
Draws hash the slot's number with a seed; reruns agree.

Edge cases: null text has no words; null source is a source of its own, last
in order; a document without words takes nothing; repeated rows are packed one
after the other; columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import running_total, staged, unused

WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1024


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), passes: int = 3) -> DataFrame:
    """(source, source_size) -> also sid, weight and target: shares by weight of
    the sum of sizes, no source above ``passes`` times its size.  The windows
    hold one row per source.

    A source's share of the rest, once all sources with a smaller cap per weight
    are held at their caps, shows whether it is capped itself."""
    whole = Window.partitionBy(F.lit(0))
    named = sizes.withColumn("sid", F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = named.withColumn("weight", F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int")))
    cap = (F.col("source_size") * passes).cast("double")
    w = whole.orderBy(cap / F.col("weight"), "sid")
    rest = F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum(cap).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = rest / F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing))
    named = named.withColumn("__cap", cap).withColumn("__level", level)
    named = named.withColumn("__free", F.when(F.col("__level") * F.col("weight") <= F.col("__cap"), F.col("__level")))
    # below the first uncapped source the level stays what it is there, so it is the greatest of its kind
    fill = F.coalesce(F.max("__free").over(whole), F.lit(0.0))
    return named.withColumn("target", F.least(F.col("__cap"), fill * F.col("weight"))).drop("__cap", "__level", "__free")


def permuted(index: Column, size: Column, *keys: Column, rounds: int = 24) -> Column:
    """Pseudorandom permutation of [0, size): the swap-or-not shuffle, which
    pairs an index with (k - index) mod size in every round and swaps the two or
    not by a hash of the greater."""
    def swap(x: Column, r: Column) -> Column:
        pair = F.pmod(F.pmod(F.xxhash64(F.lit("pair"), r, *keys), size) - x, size)
        bit = F.pmod(F.xxhash64(F.lit("swap"), r, F.greatest(x, pair), *keys), F.lit(2))
        return F.when(bit == 1, pair).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, swap)


def _owner(points: DataFrame, at: str, intervals: DataFrame) -> DataFrame:
    """Join each point to the interval (lo, hi, ...) that holds it.  Intervals
    are cut at multiples of ``CHUNK`` and met on the chunk's number."""
    cut = intervals.where(F.col("hi") > F.col("lo")).withColumn(
        "__chunk", F.explode(F.sequence(F.floor(F.col("lo") / CHUNK), F.floor((F.col("hi") - 1) / CHUNK))))
    rows = points.withColumn("__chunk", F.floor(F.col(at) / CHUNK))
    return rows.join(cut, "__chunk").where((F.col(at) >= F.col("lo")) & (F.col(at) < F.col("hi"))).drop("__chunk")


def _intervals(quota: DataFrame, amount: Column) -> DataFrame:
    before = Window.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    rows = quota.withColumn("__amount", amount)
    lo = F.coalesce(F.sum("__amount").over(before), F.lit(0)).cast("long")
    return rows.withColumn("lo", lo).withColumn("hi", F.col("lo") + F.col("__amount"))


def plan_slots(quota: DataFrame, shard_slots: int = 4096, seed: int = 7) -> DataFrame:
    """(sid, quota) -> one row per slot: shard, sid, rank (0 to quota - 1 within a source)."""
    spark = quota.sparkSession
    total = quota.agg(F.sum("quota")).first()[0] or 0
    slots = spark.range(total).select(F.col("id").alias("slot"), F.floor(F.col("id") / shard_slots).alias("shard"),
                                      F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(total, 1))).alias("draw"))
    drawn = _owner(slots, "draw", _intervals(quota.select("sid", "quota"), F.col("quota"))).select("slot", "shard", "sid", "quota")
    counts = staged(drawn.groupBy("sid", "shard").agg(F.count("*").alias("n")), "mix-counts")  # the multinomial counts
    offsets = running_total(counts, ["sid"], "shard", "n", "offset", levels=2)
    within = F.row_number().over(Window.partitionBy("sid", "shard").orderBy("slot")) - 1
    ranked = drawn.withColumn("rank", within).join(offsets.select("sid", "shard", "offset"), ["sid", "shard"]) \
                  .withColumn("rank", F.col("rank") + F.col("offset")).drop("offset")
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    balance = quota.select("sid", "quota").join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    over = _intervals(balance, F.greatest(F.col("got") - F.col("quota"), F.lit(0))).select("sid", F.col("lo").alias("over_lo"))
    short = _intervals(balance, F.greatest(F.col("quota") - F.col("got"), F.lit(0))) \
        .select(F.col("sid").alias("to_sid"), "got", "lo", "hi")
    spare = (ranked.where(F.col("rank") >= F.col("quota")).join(over, "sid")
             .withColumn("spare", F.col("over_lo") + F.col("rank") - F.col("quota")))
    moved = _owner(spare.select("shard", "spare"), "spare", short).select(
        "shard", F.col("to_sid").alias("sid"), (F.col("got") + F.col("spare") - F.col("lo")).alias("rank"))
    return ranked.where(F.col("rank") < F.col("quota")).select("shard", "sid", "rank").unionByName(moved)


def mix(docs: DataFrame, block_words: int = 64, shard_slots: int = 4096, weights: tuple[int, ...] = (1, 2, 3),
        passes: int = 3, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    rows = docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("__h"))
    rows = staged(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = staged(targets(sizes, weights, passes), "mix-sources")
    key = sources.select(F.col("source").alias("__source"), "sid", "source_size", "target")
    named = rows.join(key, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "source")
    placed = running_total(named.where("size > 0"), ["sid"], "doc_id", "size", "start", ["size", "__h"], levels=3)
    # a share of a source is the same share of its blocks, each pass over them taking every block once
    blocks = F.ceil(F.col("source_size") / block_words)
    quota = sources.where("source_size > 0").select("sid", blocks.alias("blocks"),
                                                    F.round(F.col("target") / F.col("source_size") * blocks).cast("long").alias("quota"))
    slots = plan_slots(quota, shard_slots, seed).join(quota.select("sid", "blocks"), "sid")
    epoch, place = F.floor(F.col("rank") / F.col("blocks")), F.col("rank") % F.col("blocks")
    drawn = slots.select("sid", permuted(place, F.col("blocks"), F.col("sid"), epoch, F.lit(seed)).alias("block"))
    drawn = drawn.groupBy("sid", "block").agg(F.count("*").alias("times"))
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), last)))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest(F.col("start"), F.col("block") * block_words)
    keys = ["doc_id", "sid", "start", "size", "source_size", "target"]
    taken = (pieces.select(*keys, "block", words.alias("words")).join(drawn, ["sid", "block"], "left")
             .groupBy(*keys).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).cast("long").alias("taken")))
    out = ["doc_id", "size", "source_size", "target", "taken"]
    return taken.select(*out).unionByName(named.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*out))


def mixed_documents(docs: DataFrame, seed: int = 7, **kw) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes its words:
    taken / size times, a fraction rounded up or down by a hash of the id.
    Rows whose id repeats share the id's words.  Rows of no words and rows with
    no id are not part of any block that can be named, and leave."""
    key, share, n, copy = unused(docs, "__id", "__share", "__n", "__copy")
    times = mix(docs, seed=seed, **kw).where("size > 0").groupBy(F.col("doc_id").alias(key)).agg((F.sum("taken") / F.sum("size")).alias(share))
    chance = F.pmod(F.xxhash64(F.lit(seed), F.lit("copies"), key), F.lit(1 << 20)) / float(1 << 20)
    whole = F.floor(share)
    times = times.select(key, (whole + (chance < F.col(share) - whole).cast("long")).cast("int").alias(n)).where(F.col(n) > 0)
    joined = docs.join(times, F.col("doc_id") == F.col(key))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).drop(key, n, copy)
