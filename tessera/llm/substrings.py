"""Removal of repeated word passages by matching statistics over suffix automata.

A window is ``window`` consecutive words of one document.  A word goes if some
window over it also starts earlier: in a document that comes before, or earlier
in the same one.  Windows are judged on the input.

1. Every window has a seed, the hash of its least word k-gram (leftmost of equal
   ones), so equal windows have equal seeds.  Consecutive windows
   whose seed is the same k-gram form a run; its text is the run's passage.
   Only runs whose seed occurs twice can hold a repeated window.
2. Equal passages are one reference passage, placed where it first occurs.
   References are cut into shards by their seeds' hash, about ``SHARD`` passages
   each; a seed with more of them is cut into blocks, and every two blocks meet
   in one task.  So each shard is broadcast to the tasks that have passages
   of its seeds, and to no others: a Spark broadcast of every shard to every
   document would grow with the square of the corpus.
3. A task adds its passages, in the order of their places, to a suffix
   automaton.  Each passage is first streamed through the automaton of the
   earlier ones; where the matching statistic reaches ``window`` words, the
   window that ends there occurs earlier.
4. What is found for a passage holds for all its occurrences; at any but the
   first, all windows occur earlier.  A document's removed spans are put
   together from its runs.

Edge cases: documents are ordered by doc_id, null last, and under one id by the
text's hash; rows with equal id and text are one document and are treated alike;
null text has no words; a document of fewer words than a window stays whole; an
empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged, unused

SHARD = 2000  # passages of one suffix automaton, about 27 words each
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29), np.uint64(32))
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 2 ** 64)


def seed_words(window: int) -> int:
    """Words of a seed: at most 60 windows share one."""
    return max(1, window * 2 // 5, window - 60)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def runs(words: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """(start, windows, seed, passage hash) of each run of a document's windows."""
    n = len(words) - window + 1
    if n < 1:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    k = seed_words(window)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    a, b, near, far = _MIX
    grams = h[:len(h) - k + 1].copy()
    for i in range(1, k):
        grams = (grams ^ (grams >> near)) * a + h[i:i + len(grams)]
    grams = (grams ^ (grams >> far)) * b
    grams ^= grams >> near
    lead = np.lib.stride_tricks.sliding_window_view(grams, window - k + 1).argmin(1) + np.arange(n)
    start = np.flatnonzero(np.concatenate([[True], lead[1:] != lead[:-1]]))
    count = np.diff(np.append(start, n))
    # hash of the passage: its k-grams as a polynomial, from running sums
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams * _powers(_BASE, len(grams)), dtype=np.uint64)])
    passage = (total[start + count + window - k] - total[start]) * _powers(_BACK, len(grams))[start]
    return start, count, grams[lead[start]].view(np.int64), passage.view(np.int64)


class SuffixAutomaton:
    """Suffix automaton of several word sequences, built word by word."""

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]

    def matches(self, words: list[int]) -> list[int]:
        """Matching statistics: for each word, the length of the longest run of
        words ending there that occurs in a sequence added before."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        out = []
        for w in words:
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = nxt[state].get(w)
            if to is not None:
                state, size = to, size + 1
            out.append(size)
        return out

    def _new(self, size: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(size)
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state for the run of words of ``p`` and ``w`` alone, out of ``q``."""
        nxt = self.next
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._new(self.length[p] + 1, dict(nxt[q]), self.link[q])
        self.link[q] = own
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = own
            p = self.link[p]
        return own

    def add(self, words: list[int]) -> None:
        nxt, link = self.next, self.link
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None:
                last = self._split(last, w, q)
                continue
            cur = self._new(self.length[last] + 1, {}, 0)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            link[cur] = 0 if p < 0 else self._split(p, w, nxt[p][w])
            last = cur


def _stream(window: int):
    """Task of one shard: for each passage a bit for each of its windows that an
    earlier passage holds."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["unnamed", "doc_id", "version", "start"], ignore_index=True, na_position="last")
        automaton, names = SuffixAutomaton(), {}
        seen, masks = set(), []
        for seed, passage, text in zip(pdf["seed"], pdf["passage"], pdf["words"]):
            if (seed, passage) in seen:  # the same place, read from a repeated row
                masks.append(None)
                continue
            seen.add((seed, passage))
            words = [names.setdefault(w, len(names)) for w in text.split(" ")]
            mask = 0
            found = automaton.matches(words)
            for i, size in enumerate(found[window - 1:]):
                if size >= window:
                    mask |= 1 << i
            masks.append(mask)
            if found[-1] < len(words):
                automaton.add(words)
        out = pdf[["seed", "passage", "unnamed", "doc_id", "version", "start"]].assign(mask=pd.array(masks, "Int64"))
        return out[out["mask"].notna()]

    return run


def _cut(text: str | None, found, window: int):
    """(words, removed words, maximal removed spans, kept text)."""
    words = (text or "").encode().split()
    if found is None or not len(found):
        return len(words), 0, [], b" ".join(words).decode()
    hits = np.zeros(len(words) + 1, np.int64)
    for run in found:
        first, mask = int(run["start"]), int(run["mask"])
        at = [first + i for i in range(mask.bit_length()) if mask >> i & 1]
        hits[at] = 1
    at = np.flatnonzero(hits)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[at] += 1
    cover[at + window] -= 1
    gone = np.cumsum(cover)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    spans = [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])]
    return len(words), int(gone.sum()), spans, b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode()


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """``docs`` with the struct column ``repeats``: n_words, n_removed, spans (word
    numbers, end exclusive) and kept (the other words, joined by one space)."""
    (own,) = unused(docs, "__version")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"),
                        F.coalesce("text", F.lit("")).alias("text"))
    long_enough = every.where(F.length("text") >= 2 * window - 1)

    def seeds(batches):
        for batch in batches:
            got = [runs(t.encode().split(), window)[2] for t in batch.column("text").to_pylist()]
            seed, n = np.unique(np.concatenate(got), return_counts=True) if got else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(seed), pa.array(n.astype(np.int64))], names=["seed", "n"])

    def profile(batches):
        for batch in batches:
            got = [runs(t.encode().split(), window) for t in batch.column("text").to_pylist()]
            if not got:
                continue
            at = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
            parts = [pa.array(np.concatenate(x)) for x in zip(*got)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), batch.column("version").take(pa.array(at)), *parts],
                                             names=["doc_id", "version", "start", "n", "seed", "passage"])

    twice = long_enough.select("text").mapInArrow(seeds, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")
    twice = staged(twice, "repeats-seeds")  # a table of its own: a seed that a third of the runs have is split by the join
    found = long_enough.mapInArrow(profile, "doc_id long, version long, start long, n long, seed long, passage long")
    found = staged(found.join(twice, "seed").withColumn("unnamed", F.col("doc_id").isNull()), "repeats-runs")

    place = F.struct("unnamed", "doc_id", "version", "start")
    first = staged(found.groupBy("seed", "passage").agg(F.min(place).alias("at"), F.first("n").alias("n")).select("seed", "passage", "n", "at.*"), "repeats-passages")

    def fetch(batches):
        for pdf in batches:
            out = []
            for text, wanted in zip(pdf["text"], pdf["wanted"]):
                words = text.encode().split()
                out += [(*[r[c] for c in ("seed", "passage", "start")], b" ".join(words[r["start"]:r["start"] + r["n"] + window - 1]).decode()) for r in wanted]
            made = pd.DataFrame(out, columns=["seed", "passage", "start", "words"])
            at = np.repeat(np.arange(len(pdf)), [len(w) for w in pdf["wanted"]])
            made["doc_id"], made["version"] = pdf["doc_id"].astype("Int64").to_numpy()[at], pdf["version"].to_numpy()[at]
            yield made

    wanted = staged(first.groupBy("doc_id", "version").agg(F.collect_list(F.struct("seed", "passage", "start", "n")).alias("wanted")), "repeats-wanted")
    wanted = wanted.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__version"))
    texts = every.join(wanted, same).select("doc_id", "version", "text", "wanted").mapInPandas(
        fetch, "seed long, passage long, start long, words string, doc_id long, version long")
    shards = max(1, -(-first.count() // SHARD))
    shard = F.pmod(F.xxhash64("seed"), F.lit(shards)).alias("shard")
    blocks = first.groupBy(shard).agg(F.ceil(F.count("*") / (2 * SHARD)).cast("int").alias("nb"))
    work = texts.withColumn("shard", shard).join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("passage"), F.col("nb")).cast("int"))
    work = work.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).withColumn("unnamed", F.col("doc_id").isNull())
    work = work.withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}).drop("block", "other", "nb")
    judged = work.groupBy("shard", "bi", "bj").applyInPandas(
        _stream(window), "seed long, passage long, unnamed boolean, doc_id long, version long, start long, mask long")
    judged = judged.groupBy("seed", "passage").agg(F.bit_or("mask").alias("mask"), F.min(place).alias("at"))

    all_windows = F.expr("shiftleft(1L, cast(n as int)) - 1")
    gone = found.join(staged(judged, "repeats-judged"), ["seed", "passage"])
    gone = gone.withColumn("mask", F.when(place.eqNullSafe(F.col("at")), F.col("mask")).otherwise(all_windows)).where("mask <> 0")
    spots = staged(gone.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "mask")).alias("found")), "repeats-found")
    spots = spots.select(F.col("doc_id").alias("__doc"), F.col("version").alias("__of"), F.col("found").alias("__found"))

    @F.pandas_udf("n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string")
    def cut(text: pd.Series, found: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cut(t, f, window) for t, f in zip(text, found)], columns=["n_words", "n_removed", "spans", "kept"])

    rows = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = rows.join(spots, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.col(own) == F.col("__of")), "left")
    return rows.select(*[F.col(c) for c in docs.columns if c != "repeats"], cut(F.col("text"), F.col("__found")).alias("repeats"))
