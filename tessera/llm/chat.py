"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, each time one exchange longer.
Every turn gets the hash of all turns up to it: running sums of two hashes of
(position, role, text).  A conversation whose last hash is the hash of an inner
turn of some conversation is a prefix of it, so an anti-join on (length, hash)
keeps the maximal conversations; of equal ones the least conv_id stays.  Then
these are rendered with role marks.

Running sums go through buckets of 512 turns (``common.running_total``), and a
conversation is rendered in parts of 512 turns, so no task gathers a whole
conversation however long it is; up to 512 turns there is one part.

Edge cases: rows equal in conv_id, turn, role and text are one turn; turns are
ordered by number (null first), then role, then text; null role and text count
as empty; rows with a null conv_id are one conversation, preferred to none of
its equals; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import RADIX_BITS, running_total, staged

TURN = "<|{role}|>\n{text}<|end|>\n"


def render_turn(role: Column, text: Column) -> Column:
    before, _, rest = TURN.partition("{role}")
    between, _, after = rest.partition("{text}")
    return F.concat(F.lit(before), role, F.lit(between), text, F.lit(after))


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, pos, last, p, q: (p, q) hash the turns up to
    this one, ``last`` marks a conversation's final turn."""
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = running_total(rows.withColumn("__one", F.lit(1)), ["conv_id"], "turn", "__one", "pos", ["role", "text"], levels=1)
    hashed = rows.withColumns({f"__{c}": F.xxhash64(F.lit(seed), "pos", "role", "text").cast("decimal(28,0)") for seed, c in enumerate("pq")})
    rows = running_total(hashed, ["conv_id"], "pos", ["__p", "__q"], ["p", "q"], levels=1)
    rows = rows.withColumns({c: (F.col(c) + F.col(f"__{c}")).cast("decimal(38,0)") for c in "pq"}).drop("__p", "__q", "__one")
    ends = rows.groupBy("conv_id").agg(F.max("pos").alias("__end")).withColumnRenamed("conv_id", "__conv")
    return (rows.join(ends, F.col("conv_id").eqNullSafe(F.col("__conv")))
            .withColumn("last", F.col("pos") == F.col("__end")).drop("__conv", "__end"))


def maximal(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that no other one continues."""
    key = ["pos", "p", "q"]
    inner = prefixes.where(~F.col("last")).select(*key).distinct()
    whole = prefixes.where("last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    return whole.join(inner, key, "left_anti").select("conv_id", (F.col("pos") + 1).alias("n_turns"))


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns (of the conversation), text (of the part), n_chars."""
    rows = staged(turn_prefixes(turns), "chat-turns")
    kept = maximal(rows).withColumnRenamed("conv_id", "__conv")
    spoken = rows.join(kept, F.col("conv_id").eqNullSafe(F.col("__conv")))
    part = F.shiftright("pos", RADIX_BITS).cast("int")
    said = F.struct("pos", render_turn(F.col("role"), F.col("text")).alias("said"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(said)), lambda s: s["said"]), "")
    return (spoken.groupBy("conv_id", part.alias("part"), "n_turns").agg(text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
