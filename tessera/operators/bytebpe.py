"""Byte-level BPE to a vocabulary size (T1-T3, byte profile).

* Pieces: one regular expression over the text with a space put before it (the
  prefix space); a piece's symbols are its UTF-8 bytes.  The corpus is read once,
  for the piece frequencies.
* Merges: ids are the protected specials, the 256 bytes, then the merges.  The
  next merge is the pair of highest count, of equal ones the pair of least ids.
* Batches: a pair made by merges occurs only where the two symbols at its seam
  were neighbours before, so it never counts more than they did.  The pairs
  of at least a floor are therefore all that a merge of that floor can come
  from.  One Spark job cuts the words at all other seams and counts the
  distinct stretches that are left; on these the driver follows the sequential rule,
  exactly, down to the floor.  The floor is raised until at most ``sample``
  stretches reach the driver (a stated bound); in the last resort a batch is the next
  merges that have no symbol in common, which need no stretches.
* Encoding runs where the document is, with a bounded cache of pieces, and
  needs no shuffle: the pieces new to a task are encoded together; specials in a text stay single ids.

Edge cases: null and empty texts have no pieces and no ids; texts that hold a
special keep it whole; ids outside the vocabulary are dropped by ``decode``;
bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.functions.text import col
from tessera.session import stage

CACHED_PIECES = 200_000
SAMPLE = 200_000
BATCH = 256
HELD_STRETCHES = 500_000
# white space as Unicode's property has it
SPACE = r"\t-\r\x{85}\p{Z}"
# contractions, letters, numbers and other symbols, each led by one space at most, and white space but for the space that leads a piece
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_order() -> list[int]:
    """Bytes in the order of their ids: the printable ones first, then the others."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return shown + [b for b in range(256) if b not in shown]


def with_prefix_space(text) -> Column:
    t = col(text)
    return F.when(t.rlike(rf"^[{SPACE}]"), t).when(t != "", F.concat(F.lit(" "), t)).otherwise(t)


def byte_pieces(text) -> Column:
    """Pieces of a text with its prefix space."""
    return F.regexp_extract_all(with_prefix_space(text), F.lit(PIECE), 0)


def piece_frequencies(df: DataFrame, text: str = "text") -> DataFrame:
    """(piece, n)."""
    return df.select(F.explode(byte_pieces(text)).alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))


@dataclass
class ByteBpe:
    specials: list[str] = field(default_factory=lambda: list(K.SPECIAL_TOKENS_TRAINER))
    merges: list[tuple[int, int]] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)

    @property
    def base(self) -> int:
        return len(self.specials) + 256

    def symbols(self, piece: bytes) -> list[int]:
        at = {b: len(self.specials) + i for i, b in enumerate(byte_order())}
        return [at[b] for b in piece]

    def vocabulary(self) -> list[bytes]:
        """Bytes of each id."""
        out = [s.encode() for s in self.specials] + [bytes([b]) for b in byte_order()]
        for a, b in self.merges:
            out.append(out[a] + out[b])
        return out


def _merge(word: list[int], a: int, b: int, new: int) -> list[int]:
    out, i, n = [], 0, len(word)
    while i < n:
        if i + 1 < n and word[i] == a and word[i + 1] == b:
            out.append(new)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return out


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: int) -> np.ndarray:
    """Value of each wanted key (``keys`` ascend), or the default."""
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def _pairs(sym: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of each symbol with the next one; -1 where a word ends."""
    return np.where(word[:-1] == word[1:], sym[:-1] << 32 | sym[1:], -1)


def _ranked(merges) -> tuple[np.ndarray, np.ndarray]:
    """Pair keys ascending, and the ranks of their merges."""
    keys = np.array([a << 32 | b for a, b in merges], dtype="int64")
    rank = np.argsort(keys)
    return keys[rank], rank


def _apply(sym: np.ndarray, word: np.ndarray, ranked: tuple[np.ndarray, np.ndarray], base: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (symbols, ascending number of each one's word) after the merges, in
    their order: in each turn every word takes its next merge.  ``base``: the id
    that the first merge makes, or those of all merges, which may then repeat."""
    none, done = len(ranked[0]), []
    made = base + np.arange(none) if np.ndim(base) == 0 else base
    last = np.full(len(sym), -1)  # the last merge of each one's word; merges don't come again
    while len(sym) > 1:
        rank = _lookup(*ranked, _pairs(sym, word), none)
        rank = np.append(np.where(rank > last[:-1], rank, none), none)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
        open_ = best < none
        done.append((sym[~open_], word[~open_]))
        sym, word, rank, best = sym[open_], word[open_], rank[open_], best[open_]
        last = best
        hit = np.flatnonzero(rank == best)
        if len(hit):
            # of hits that overlap (one symbol repeated) every second one counts
            head = np.append(True, np.diff(hit) > 1)
            hit = hit[(hit - hit[head][np.cumsum(head) - 1]) % 2 == 0]
            sym[hit] = made[best[hit]]
            rest = np.ones(len(sym), dtype=bool)
            rest[hit + 1] = False
            sym, word, last = sym[rest], word[rest], last[rest]
    done.append((sym, word))
    sym, word = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


class _Sequential:
    """Sequential merges on stretches of words, which hold all occurrences of the
    pairs in ``counts``."""

    def __init__(self, words: list[tuple[list[int], int]], counts: dict[tuple[int, int], int], place=lambda p: p):
        self.place = place  # the order of pairs of one count
        self.words, self.n = [w for w, _ in words], [n for _, n in words]
        self.counts = dict(counts)
        self.where = defaultdict(set)
        for i, w in enumerate(self.words):
            for p in zip(w, w[1:]):
                self.where[p].add(i)
        self.heap = [(-c, place(p), p) for p, c in self.counts.items()]
        heapq.heapify(self.heap)

    def next(self, new, least: int) -> tuple[tuple[int, int], int] | None:
        """The next merge and its count, if that is ``least`` or more; ``new``: the id it makes, or a function of the pair."""
        while self.heap:
            c, _, p = heapq.heappop(self.heap)
            if self.counts.get(p, 0) != -c:  # out of date; the newer count has an entry of its own
                continue
            if -c < least:
                return None
            self.take(p, new(p) if callable(new) else new)
            return p, -c
        return None

    def take(self, p: tuple[int, int], new: int) -> None:
        self.counts.pop(p, None)
        for i in self.where.pop(p, ()):
            before = Counter(zip(self.words[i], self.words[i][1:]))
            if p not in before:
                continue
            self.words[i] = _merge(self.words[i], *p, new)
            after = Counter(zip(self.words[i], self.words[i][1:]))
            for q in before.keys() | after.keys():
                if q != p and (d := (after[q] - before[q]) * self.n[i]):
                    self.counts[q] = self.counts.get(q, 0) + d
                    heapq.heappush(self.heap, (-self.counts[q], self.place(q), q))
                    self.where[q].add(i)


def learn(freq: DataFrame, vocab_size: int, min_frequency: int = 2, specials=None, sample: int = SAMPLE, batch: int = BATCH,
          stats: dict | None = None) -> ByteBpe:
    """Merges until the vocabulary (specials, bytes, merges) has ``vocab_size``
    entries or no pair occurs ``min_frequency`` times.  ``freq``: (piece, n)."""
    model = ByteBpe() if specials is None else ByteBpe(list(specials))
    base, first = model.base, np.array(model.symbols(bytes(range(256))), dtype="int64")
    pieces = freq.select(F.encode("piece", "utf-8").alias("piece"), "n").where(F.length("piece") > 1)
    words = stage(pieces.mapInArrow(_byte_words(first), "n long, word array<int>"), "bpe-words")
    done, jobs, top = 0, 0, 16 * batch  # merges that ``words`` already has; pairs that a batch looks at
    single, pause = 0, 1  # merges to be taken one by one before stretches are tried again
    while (room := min(batch, vocab_size - base - len(model.merges))) > 0:
        if len(model.merges) - done >= batch:
            words = stage(words.mapInArrow(_rewriter(model.merges[done:], base, done), "n long, word array<int>"), "bpe-words")
            done = len(model.merges)
        ahead = model.merges[done:]
        counted = words.mapInArrow(_pair_counter(ahead, base, done), "a int, b int, c long").groupBy("a", "b").agg(F.sum("c").alias("c"))
        most = counted.where(F.col("c") >= min_frequency).orderBy(F.desc("c"), "a", "b").limit(max(top, 16)).collect()
        if not most:
            break
        words_left, floor, seams = None, min_frequency, most
        while not single:
            if len(seams) < len(most) or len(most) >= max(top, 16):  # pairs as frequent as the last one may be missing
                floor = seams[-1].c + 1
                seams = [r for r in seams if r.c >= floor]
            if len(seams) < 2:
                single, pause = pause, min(2 * pause, 64)
                break
            cut = words.mapInArrow(_stretcher([(r.a, r.b) for r in seams], ahead, base, done), "stretch binary, n long")
            found = cut.groupBy("stretch").agg(F.sum("n").alias("n")).limit(sample + 1).collect()
            jobs += 1
            if len(found) <= sample:
                words_left, pause = [(np.frombuffer(r.stretch, dtype="int32").tolist(), r.n) for r in found], 1
                break
            top = max(1, min(top, len(seams)) // 4)
            seams = seams[:top]
        if words_left is None:  # the next merges that can't touch one another need no stretches
            for r in most[:_apart(most)][:room]:
                model.merges.append((r.a, r.b))
                model.counts.append(r.c)
            jobs, single, top = jobs + 1, max(single - 1, 0), max(top, 8)
            continue
        state = _Sequential(words_left, {(r.a, r.b): r.c for r in seams})
        taken = 0
        while taken < room and (step := state.next(base + len(model.merges), floor)) is not None:
            model.merges.append(step[0])
            model.counts.append(step[1])
            taken += 1
        if taken < room:
            top = min(2 * top, 16 * batch)
    if stats is not None:
        stats["jobs"], stats["merges"] = jobs, len(model.merges)
    return model


def _apart(most: list) -> int:
    """How many of the most frequent pairs are the next merges for certain: none of
    them ends with what one of them begins with, so merges change none of their
    counts, and pairs that merges make come from rarer ones."""
    begins, ends, k = set(), set(), 0
    for i, r in enumerate(most):
        begins.add(r.a)
        ends.add(r.b)
        if begins & ends:
            break
        if i + 1 < len(most) and most[i + 1].c < r.c:
            k = i + 1
    return max(k, 1)


def _byte_words(first: np.ndarray):
    """Task: the symbols of each piece's bytes."""
    def run(batches):
        for b in batches:
            raw = b.column("piece").to_pylist()
            sym = first[np.frombuffer(b"".join(raw), dtype="uint8")]
            yield _word_batch(b.column("n"), sym, np.fromiter(map(len, raw), "int64", len(raw)))
    return run


def _word_batch(n: pa.Array, sym: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Rows (n, word); words of one symbol can't change any more and go."""
    at = np.append(0, np.cumsum(size)).astype("int32")
    rows = pa.RecordBatch.from_arrays([n, pa.ListArray.from_arrays(pa.array(at), pa.array(sym.astype("int32")))], ["n", "word"])
    return rows.filter(pa.array(size > 1))


def _now(batch: pa.RecordBatch, ranked: tuple[np.ndarray, np.ndarray], base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, word of each, n of each word) of a batch after merges that its words lack."""
    size = pc.list_value_length(batch.column("word")).to_numpy(zero_copy_only=False)
    sym = batch.column("word").flatten().to_numpy(zero_copy_only=False).astype("int64")
    return *_apply(sym, np.repeat(np.arange(len(size)), size), ranked, base), batch.column("n").to_numpy(zero_copy_only=False)


def _rewriter(ahead: list[tuple[int, int]], base: int, done: int):
    """Task: words after the merges of ``ahead``, the first of which is number ``done``."""
    def run(batches):
        ranked = _ranked(ahead)
        for b in batches:
            sym, word, n = _now(b, ranked, base + done)
            yield _word_batch(b.column("n"), sym, np.bincount(word, minlength=len(n)))
    return run


def _pair_counter(ahead: list[tuple[int, int]], base: int, done: int):
    """Task: summed counts of the pairs in words after the merges of ``ahead``."""
    def run(batches):
        ranked, keys, sums = _ranked(ahead), np.empty(0, "int64"), np.empty(0, "int64")
        for b in batches:
            sym, word, n = _now(b, ranked, base + done)
            pair = _pairs(sym, word)
            here = pair >= 0
            keys, sums = np.append(keys, pair[here]), np.append(sums, n[word[:-1][here]])
            order = np.argsort(keys)
            keys, sums = keys[order], sums[order]
            head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
            keys, sums = keys[head], np.add.reduceat(sums, head) if len(head) else sums
        yield pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype("int32")), pa.array((keys & 0xFFFFFFFF).astype("int32")), pa.array(sums)], ["a", "b", "c"])
    return run


def _stretcher(seams: list[tuple[int, int]], ahead: list[tuple[int, int]], base: int, done: int):
    """Task: summed stretches of two or more symbols that only pairs of ``seams`` join."""
    def flushed(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.binary()), pa.array(list(total.values()), pa.int64())], ["stretch", "n"])

    def run(batches):
        ranked, keep, total = _ranked(ahead), _ranked(seams), Counter()
        for b in batches:
            sym, word, n = _now(b, ranked, base + done)
            joined = _lookup(*keep, _pairs(sym, word), -1) >= 0
            edge = np.flatnonzero(np.diff(np.concatenate(([False], joined, [False])).astype("int8")))  # runs of joined pairs
            raw = sym.astype("int32").tobytes()
            for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
                total[raw[4 * start:4 * end + 4]] += int(n[word[start]])
            if len(total) > HELD_STRETCHES:
                yield flushed(total)
                total.clear()
        yield flushed(total)
    return run


def encode_pieces(pieces: list[bytes], first: np.ndarray, ranked: tuple[np.ndarray, np.ndarray], base: int) -> list[np.ndarray]:
    """Ids of each piece."""
    size = np.fromiter(map(len, pieces), "int64", len(pieces))
    sym, word = _apply(first[np.frombuffer(b"".join(pieces), dtype="uint8")], np.repeat(np.arange(len(pieces)), size), ranked, base)
    return np.split(sym.astype("int32"), np.cumsum(np.bincount(word, minlength=len(pieces)))[:-1])


def encode(df: DataFrame, model: ByteBpe, text: str = "text") -> DataFrame:
    """``df`` with ``input_ids``; specials in the text are single ids, and each
    stretch between them is cut into pieces with a prefix space of its own."""
    names = "|".join(re.escape(s) for s in sorted(model.specials, key=len, reverse=True)) or "(?!)"
    first = np.array(model.symbols(bytes(range(256))), dtype="int64")
    special = {s: i for i, s in enumerate(model.specials)}
    shared = df.sparkSession.sparkContext.broadcast((_ranked(model.merges), first, special, model.base))  # bounded by the vocabulary

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ranked, first, special, base = shared.value
        known: dict[str, np.ndarray] = {}
        for docs in batches:
            if len(known) >= CACHED_PIECES:
                known.clear()
            new = list({p for parts in docs for part in parts for p in part["pieces"] if p not in known})
            known.update(zip(new, encode_pieces([p.encode() for p in new], first, ranked, base)))
            rows = []
            for parts in docs:
                row = [np.empty(0, "int32")]
                for part in parts:
                    if part["special"] is not None:
                        row.append(np.array([special[part["special"]]], "int32"))
                    row += [known[p] for p in part["pieces"]]
                rows.append(np.concatenate(row))
            yield pd.Series(rows)

    t = F.coalesce(F.col(text), F.lit(""))
    marks = F.regexp_extract_all(t, F.lit(f"({names})"), 1)
    between = F.split(t, f"(?:{names})", -1)
    # the i-th stretch follows the (i-1)-th special
    parts = F.transform(between, lambda x, i: F.struct(F.get(marks, i - 1).alias("special"), byte_pieces(x).alias("pieces")))
    return df.withColumn("input_ids", ids(parts))


def decode(df: DataFrame, model: ByteBpe, ids: str = "input_ids") -> DataFrame:
    """``df`` with ``decoded``: the text of the ids, prefix spaces included."""
    shared = df.sparkSession.sparkContext.broadcast(model.vocabulary())  # bounded by the vocabulary

    @F.pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        names = shared.value
        return pd.Series([b"".join(names[i] for i in r if 0 <= i < len(names)).decode("utf-8", "replace") for r in rows])

    return df.withColumn("decoded", text(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
