"""Exact and near-duplicate removal.

Scale notes
-----------
* D1 never uses a window over the hash group (a hot group of copies would
  land in one task).  Winners come from a partial+final ``min`` aggregate
  and are re-attached with a join on ``(scope, hash, id)``, a key that is
  unique on the winner side, so copies of one text spread over all tasks.
* D2 signatures: tokens and base hashes are column expressions; the
  128-way minimum is one vectorised pandas UDF per Arrow batch.  No shuffle.
* D3 never emits document pairs.  Documents and LSH buckets form a
  membership table ``(doc, bucket)``; each round aggregates per bucket
  (``min`` of live / kept ids — partial aggregation makes a hot bucket
  cheap) and per document.  The reference's streaming semantics — a document
  is dropped iff it shares a band bucket with a *kept* earlier document —
  are reproduced exactly; ``component`` mode gives connected components.
  Round state is cut with a reliable checkpoint in the shared folder.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.functions.hashing import token_u32
from tessera.functions.text import col, py_strip, words
from tessera.session import cut_lineage

MERSENNE_31 = 2147483647
MINIMA_HASHES = 32768  # hashes worked on at a time


# --- D1 ----------------------------------------------------------------------

def text_hash(text) -> Column:
    return F.sha2(col(text), 256)


def exact_dedup_flags(df: DataFrame, text: str, id_col: str, scope=()) -> DataFrame:
    """Adds ``content_hash`` and ``is_first`` (first occurrence = min id).

    Null scopes are a scope of their own.  A row with null text has no content
    to compare and is always first."""
    keys = [*scope, "content_hash", id_col]
    hashed = df.withColumn("content_hash", text_hash(text))
    winners = (hashed.where(F.col("content_hash").isNotNull()).groupBy(*scope, "content_hash").agg(F.min(id_col).alias(id_col))
               .select(*[F.col(c).alias(f"_first_{c}") for c in keys], F.lit(True).alias("is_first")))
    same = functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_first_{c}")) for c in keys])
    return (hashed.join(winners, same, "left").drop(*[f"_first_{c}" for c in keys])
            .withColumn("is_first", F.coalesce(F.col("is_first"), F.col("content_hash").isNull())))


def exact_dedup(df: DataFrame, text: str, id_col: str, scope=()) -> DataFrame:
    """Keep the first occurrence of each text (per scope) and rows without text."""
    return exact_dedup_flags(df, text, id_col, scope).where("is_first").drop("is_first")


def normalized_prompt(text) -> Column:
    """D6 normalisation: strip, lower-case, collapse whitespace runs."""
    from tessera.functions.text import WS_RUN
    return F.regexp_replace(F.lower(py_strip(text)), WS_RUN, " ")


# --- D2 ----------------------------------------------------------------------

def permutations(num_perm: int = K.NUM_PERM, seed: str = "minhash") -> list[tuple[int, int]]:
    """(a, b) pairs from a keyed md5 rule; a in [1, p-1], b in [0, p-1]."""
    out = []
    for i in range(num_perm):
        a = int(hashlib.md5(f"{seed}:a:{i}".encode()).hexdigest()[:8], 16) % (MERSENNE_31 - 1) + 1
        b = int(hashlib.md5(f"{seed}:b:{i}".encode()).hexdigest()[:8], 16) % MERSENNE_31
        out.append((a, b))
    return out


def token_hashes(text) -> Column:
    """Distinct whitespace tokens -> 32-bit md5 base hashes (set semantics)."""
    return F.transform(F.array_distinct(words(text)), token_u32)


@functools.lru_cache(maxsize=8)
def _permutation_arrays(num_perm: int, seed: str) -> tuple[np.ndarray, np.ndarray]:
    perms = np.array(permutations(num_perm, seed), dtype=np.uint64)
    return perms[:, 0], perms[:, 1]


def minima(hashes: np.ndarray, starts: np.ndarray, num_perm: int = K.NUM_PERM, seed: str = "minhash") -> np.ndarray:
    """(sets, num_perm) minima of ``(a*h+b) mod p`` over sets of 32-bit hashes that lie
    one behind the other; ``starts``: each set's first place (none is empty).

    Sets are taken in stretches that stay in the processor's cache; mod 2^31 - 1 is
    two folds and one conditional subtraction."""
    a, b = _permutation_arrays(num_perm, seed)
    p, bits = np.uint64(MERSENNE_31), np.uint64(31)
    out = np.empty((len(starts), num_perm), dtype=np.int64)
    ends, at = np.append(starts[1:], len(hashes)), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + MINIMA_HASHES, "right")))
        h = hashes[starts[at]:ends[to - 1]].astype(np.uint64)
        first, x, y = starts[at:to] - starts[at], np.empty_like(h), np.empty_like(h)
        for i in range(num_perm):
            np.multiply(h, a[i], out=x)
            x += b[i]
            for _ in range(2):
                np.right_shift(x, bits, out=y)
                x &= p
                x += y
            np.subtract(x, p, out=y)  # wraps to a large number where x < p
            np.minimum(x, y, out=x)
            out[at:to, i] = np.minimum.reduceat(x, first)
        at = to
    return out


def _signature_udf(num_perm: int, seed: str):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def signature(hashes: pd.Series) -> pd.Series:
        arrays = [np.asarray(x, dtype=np.int64) if x is not None else np.empty(0, np.int64) for x in hashes]
        out: list = [None] * len(arrays)
        filled = [i for i, x in enumerate(arrays) if len(x)]
        if filled:
            sizes = np.array([len(arrays[i]) for i in filled])
            flat = np.concatenate([arrays[i] for i in filled])
            for i, row in zip(filled, minima(flat, np.cumsum(sizes) - sizes, num_perm, seed)):
                out[i] = row
        return pd.Series(out, dtype=object)
    return signature


def minhash_signature(text, num_perm: int = K.NUM_PERM, seed: str = "minhash") -> Column:
    """``array<bigint>`` of ``num_perm`` minima of ``(a*h+b) mod p``.

    Tokenising and the md5 base hashes stay JVM-side; the 128-way minimum
    runs in one Arrow-batched pandas UDF (numpy ``minimum.reduceat`` over all
    tokens of a batch — nested lambda ``transform`` is interpreted and ~50x
    slower).  Null for texts without tokens (those are left to exact dedup).
    """
    return _signature_udf(num_perm, seed)(token_hashes(text))


def signatures(df: DataFrame, text: str, id_col: str, scope=(), num_perm: int = K.NUM_PERM) -> DataFrame:
    """``(id, scope..., signature)`` for rows that have tokens.

    The emptiness test is a built-in predicate applied *before* the UDF:
    filtering on the UDF's output would let Catalyst push that filter below
    an exchange and evaluate the UDF twice."""
    return (df.where(F.size(words(F.col(text))) > 0)
            .select(id_col, *scope, F.sha2(F.col(text), 256).alias("content_hash"),
                    minhash_signature(F.col(text), num_perm).alias("signature")))


def band_buckets(df: DataFrame, id_col: str, sig: str = "signature", bands: int = 8, rows: int = 16,
                 scope=(), carry=()) -> DataFrame:
    """Explode a (non-null) signature into ``(id, band, bucket, carry...)`` membership rows."""
    scope, carry = list(scope), [c for c in carry]
    b = F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")
    exploded = df.select(id_col, *dict.fromkeys(scope + carry), sig, b)
    part = F.slice(F.col(sig), F.col("band") * rows + 1, rows)
    return exploded.select(id_col, "band", *carry,
                           F.xxhash64(*[F.col(s) for s in scope], F.col("band"), part).alias("bucket"))


@functools.lru_cache(maxsize=64)
def lsh_params(threshold: float, num_perm: int, fp_weight: float = 0.5, fn_weight: float = 0.5) -> tuple[int, int]:
    """(bands, rows) with bands*rows <= num_perm minimising the weighted
    false-positive area below ``threshold`` plus the false-negative area above
    it under the LSH S-curve P(s) = 1 - (1 - s^rows)^bands.  (0.85, 128) -> (8, 16)."""
    best = None
    s_lo = np.linspace(0.0, threshold, 1001)
    s_hi = np.linspace(threshold, 1.0, 1001)
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            fp = np.trapezoid(1 - (1 - s_lo ** r) ** b, s_lo)
            fn = np.trapezoid((1 - s_hi ** r) ** b, s_hi)
            err = fp_weight * fp + fn_weight * fn
            if best is None or err < best[0]:
                best = (err, b, r)
    return best[1], best[2]


@dataclass(frozen=True)
class NearDup:
    threshold: float = K.NEAR_DUP_THRESHOLD
    num_perm: int = K.NUM_PERM
    bands: int | None = None  # None: derived from threshold (lsh_params)
    rows: int | None = None
    mode: str = "first_wins"  # or "component"

    def band_rows(self) -> tuple[int, int]:
        if self.bands is not None and self.rows is not None:
            return self.bands, self.rows
        return lsh_params(self.threshold, self.num_perm)


def _multi_member(members: DataFrame, id_col: str) -> DataFrame:
    """Keep only buckets with at least two members (others decide nothing)."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    return members.join(sizes.where("n > 1").select("bucket"), "bucket", "left_semi")


def first_wins(members: DataFrame, id_col: str, stats: dict | None = None) -> DataFrame:
    """Reference LSH semantics without pairs: ``(id, kept)`` for candidate ids.

    Per round, per bucket: ``min_live`` (smallest id not yet dropped) and
    ``min_kept``.  An undecided id is dropped when a bucket has a kept id
    below it, kept when it is the smallest live id of all its buckets.  The
    smallest undecided id is always decided, so the loop terminates.

    Decided ids never change, so after each round the membership table is
    pruned to buckets that still hold an undecided id: later rounds touch
    only the remaining candidate chains, not the corpus.
    """
    m = cut_lineage(members.select(id_col, "bucket").distinct())
    status = m.select(id_col).distinct().withColumn("state", F.lit("U"))
    decided = None
    rnd = 0
    while True:
        joined = m.join(status, id_col)
        per_bucket = joined.groupBy("bucket").agg(
            F.min(F.when(F.col("state") != "X", F.col(id_col))).alias("min_live"),
            F.min(F.when(F.col("state") == "K", F.col(id_col))).alias("min_kept"))
        undecided = joined.where(F.col("state") == "U").select(id_col, "bucket")
        votes = (undecided.join(per_bucket, "bucket")
                 .groupBy(id_col).agg(
                     F.max((F.col("min_kept") < F.col(id_col)).cast("int")).alias("hit_kept"),
                     F.min((F.col("min_live") == F.col(id_col)).cast("int")).alias("all_first")))
        new_state = (status.join(votes, id_col, "left")
                     .select(id_col, F.when(F.col("state") != "U", F.col("state"))
                             .when(F.col("hit_kept") == 1, F.lit("X"))
                             .when(F.col("all_first") == 1, F.lit("K"))
                             .otherwise(F.lit("U")).alias("state")))
        new_state = cut_lineage(new_state)
        still = new_state.where(F.col("state") == "U").select(id_col)
        if stats is not None:
            stats["rounds"] = rnd + 1
        rnd += 1
        if still.limit(1).count() == 0:
            status = new_state
            break
        # prune: keep buckets with an undecided member, and the states of their members
        active = m.join(still, id_col, "left_semi").select("bucket").distinct()
        m = cut_lineage(m.join(active, "bucket", "left_semi"))
        final_now = new_state.join(m.select(id_col).distinct(), id_col, "left_anti")
        decided = final_now if decided is None else decided.unionByName(final_now)
        status = new_state.join(m.select(id_col).distinct(), id_col, "left_semi")
    result = status if decided is None else decided.unionByName(status)
    return result.select(id_col, (F.col("state") == "K").alias("kept"))


def star_step(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction step on (hi, lo) edges: every node's larger (or smaller)
    neighbours are re-attached to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))) if larger else edges
    least = both.groupBy("hi").agg(F.min("lo").alias("m")).withColumn("m", F.least("m", "hi"))
    near = both.join(least, "hi")
    if larger:
        out = near.where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    else:
        out = near.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(least.select("hi", F.col("m").alias("lo")))
    return out.where("hi > lo")


def components(members: DataFrame, id_col: str) -> DataFrame:
    """Connected components over bucket hyperedges, one star edge per member.

    Large-star and small-star steps alternate until the edges stop changing:
    rounds grow with the logarithm of the longest chain, without a limit."""
    m = members.select(id_col, "bucket").distinct()
    first = m.groupBy("bucket").agg(F.min(id_col).alias("lo"))
    edges = cut_lineage(m.join(first, "bucket").select(F.col(id_col).alias("hi"), "lo").where("hi > lo").distinct())

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()

    before = mark(edges)
    while True:
        edges = cut_lineage(star_step(star_step(edges, True), False).distinct())
        if (now := mark(edges)) == before:
            break
        before = now
    label = m.select(id_col).distinct().join(edges.select(F.col("hi").alias(id_col), F.col("lo").alias("label")), id_col, "left")
    label = label.withColumn("label", F.coalesce("label", id_col))
    return label.select(id_col, "label", (F.col("label") == F.col(id_col)).alias("kept"))


def near_dup(df: DataFrame, text: str, id_col: str, scope=(), p: NearDup = NearDup(),
             stats: dict | None = None) -> DataFrame:
    """Adds ``near_dup_kept`` to every row of ``df``.

    Exact copies are resolved on the narrow band table: a later copy shares
    every band bucket with its first occurrence, so under first-wins it is
    always dropped and in component mode it joins that component.  Taking
    copies out before the bucket rounds changes no verdict but keeps a group
    of copies (possibly a third of the corpus) out of every bucket; only
    ``(id, scope, hash)`` moves, never the text.  Rows without tokens, and
    rows sharing no bucket with anyone, are kept.
    """
    scope = list(scope)
    sigs = signatures(df, text, id_col, scope, p.num_perm)
    bands, rows = p.band_rows()
    # persist the compact (id, band, bucket, hash) table once: the signature
    # UDF runs a single time, and the rounds read a few dozen bytes per band
    all_members = cut_lineage(band_buckets(sigs, id_col, "signature", bands, rows, scope, carry=[*scope, "content_hash"]))
    winners = all_members.groupBy(*scope, "content_hash").agg(F.min(id_col).alias(id_col))
    first_members = all_members.join(winners.select(id_col), id_col, "left_semi").select(id_col, "band", "bucket")
    copies = (all_members.select(id_col).distinct().join(winners.select(id_col), id_col, "left_anti")
              .withColumn("kept", F.lit(False)))
    members = cut_lineage(_multi_member(first_members, id_col))
    if stats is not None:  # scalars for benchmark notes (two small actions)
        stats["candidate_memberships"] = members.count()
        stats["candidate_docs"] = members.select(id_col).distinct().count()
        stats["bands"], stats["rows"] = bands, rows
    if p.mode == "component":
        decided = components(members, id_col).select(id_col, "kept")
    else:
        decided = first_wins(members, id_col, stats)
    result = decided.unionByName(copies)
    return (df.join(result.select(id_col, F.col("kept").alias("near_dup_kept")), id_col, "left")
            .withColumn("near_dup_kept", F.coalesce(F.col("near_dup_kept"), F.lit(True))))


def earlier_collisions(df: DataFrame, text: str, id_col: str, scope=(), bands: int = 8, rows: int = 16,
                       num_perm: int = K.NUM_PERM) -> DataFrame:
    """Candidate statistics without pairs: per id, bands where an earlier id shares the bucket."""
    scope = list(scope)
    sigs = signatures(df, text, id_col, scope, num_perm)
    members = cut_lineage(band_buckets(sigs, id_col, "signature", bands, rows, scope))
    first = members.groupBy("bucket").agg(F.min(id_col).alias("first_id"))
    return (members.join(first, "bucket")
            .groupBy(id_col).agg(F.count_if(F.col("first_id") < F.col(id_col)).alias("bands_with_earlier")))


def dedup_rate(df: DataFrame, kept_col: str, group_cols=("language",)) -> DataFrame:
    """1 - kept/total per group."""
    return (df.groupBy(*group_cols)
            .agg(F.count("*").alias("n_total"), F.count_if(F.col(kept_col)).alias("n_kept"))
            .withColumn("dedup_rate", F.round(1 - F.col("n_kept") / F.col("n_total"), 6)))
