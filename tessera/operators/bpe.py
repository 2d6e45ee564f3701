"""Tokeniser training and encoding.

* T1 pre-tokenises with one regex (JVM side) and counts pieces with a
  partial+final aggregate — the only pass over the corpus.
* T2 learns merges on the *frequency table*, never the corpus: the pair of
  highest count, weighted by piece frequency (of equal ones the least, so it
  is deterministic), is merged from left to right, again and again.  A Spark
  job serves many merges (see ``bytebpe``); what reaches the driver is bounded.
* T3 encodes a document's pieces where the document is (Arrow pandas UDF
  with a bounded cache of piece encodings): no shuffle.

Symbols are characters (code points); ids: special tokens first, then the
base alphabet in code-point order, then merges in learned order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.functions.constants import PY_SPACE
from tessera.operators import bytebpe as V
from tessera.session import stage

CACHED_PIECES = 200_000
HELD_SYMBOLS = 2_000_000  # symbols of words that the driver learns the last merges from

# Pre-tokeniser: contractions, letter runs, digit runs, other-symbol runs and
# whitespace runs, each optionally led by one space.
PRETOKEN_PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{PY_SPACE}\p{{L}}\p{{N}}]+|[{PY_SPACE}]+")


def pieces(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(t, F.lit(PRETOKEN_PATTERN), 0)


def piece_frequencies(df: DataFrame, text: str = "text", min_frequency: int = 1) -> DataFrame:
    """``(piece, n)``."""
    out = df.select(F.explode(pieces(text)).alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))
    return out.where(F.col("n") >= min_frequency)


def top_vocabulary(freq: DataFrame, size: int, min_frequency: int = 2) -> DataFrame:
    """Pieces with n >= min_frequency, top ``size`` by (n desc, piece)."""
    return (freq.where(F.col("n") >= min_frequency).orderBy(F.desc("n"), "piece").limit(size))


@dataclass
class BpeModel:
    specials: list[str] = field(default_factory=lambda: list(K.SPECIAL_TOKENS_TRAINER))
    alphabet: list[str] = field(default_factory=list)
    merges: list[tuple[str, str]] = field(default_factory=list)

    def vocab(self) -> dict[str, int]:
        toks = list(self.specials) + list(self.alphabet) + [a + b for a, b in self.merges]
        out: dict[str, int] = {}
        for t in toks:
            out.setdefault(t, len(out))
        return out


def _symbol_words(alphabet: np.ndarray):
    """Task: the places in ``alphabet`` (ascending code points) of each piece's characters."""
    def run(batches):
        for b in batches:
            raw = b.column("piece").to_pylist()
            sym = np.searchsorted(alphabet, np.frombuffer("".join(raw).encode("utf-32-le"), "uint32"))
            yield V._word_batch(b.column("n"), sym, np.fromiter(map(len, raw), "int64", len(raw)))
    return run


class _Symbols:
    """Symbols are their strings: pairs that make one string make one symbol."""

    def __init__(self, alphabet: list[str]):
        self.names, self.ids = list(alphabet), {s: i for i, s in enumerate(alphabet)}
        self.merges: list[tuple[int, int]] = []
        self.made: list[int] = []
        self.counts: list[int] = []
        self.again = False  # whether the last merge made a symbol that was there before

    def of(self, p: tuple[int, int]) -> int:
        """The symbol that a pair makes."""
        name = self.names[p[0]] + self.names[p[1]]
        self.again = name in self.ids
        if not self.again:
            self.ids[name] = len(self.names)
            self.names.append(name)
        return self.ids[name]

    def place(self, p: tuple[int, int]) -> tuple[str, str]:
        return self.names[p[0]], self.names[p[1]]

    def add(self, p: tuple[int, int], count: int) -> None:
        self.made.append(self.ids[self.names[p[0]] + self.names[p[1]]])
        self.merges.append(p)
        self.counts.append(int(count))


def _finish(words: DataFrame, sym: _Symbols, num_merges: int, min_frequency: int) -> None:
    """All merges that are left, on the driver: ``words`` are few."""
    held = [(r.word, r.n) for r in words.collect()]
    counts: Counter = Counter()
    for word, n in held:
        for p in zip(word, word[1:]):
            counts[p] += n
    state = V._Sequential(held, counts, sym.place)
    while len(sym.merges) < num_merges and (step := state.next(sym.of, min_frequency)) is not None:
        sym.add(*step)


def learn_merges(freq: DataFrame, num_merges: int | None = None, min_frequency: int = 2, specials=None, vocab_size: int | None = None,
                 held: int = HELD_SYMBOLS, sample: int = V.SAMPLE, batch: int = 1024) -> tuple[BpeModel, DataFrame]:
    """Returns the model and a ``(rank, left, right, count)`` DataFrame: ``num_merges``
    merges, or as many as fill a vocabulary (specials, alphabet, merges) of
    ``vocab_size`` entries, unless no pair occurs ``min_frequency`` times before.

    The next merge is the pair of highest count, of equal ones the one of least
    strings.  Many merges are learned a job, as in ``bytebpe.learn``; once the
    words hold at most ``held`` symbols, the driver learns the rest from them.  A
    merge that makes a symbol anew ends its batch: pairs of that symbol may then
    count more than those they come from."""
    spark, freq = freq.sparkSession, stage(freq.select("piece", "n"), "bpe-frequencies")
    # every character that occurs is in the alphabet (bounded by Unicode), also those of rare pieces only
    alphabet = [r.s for r in freq.select(F.explode(F.split(F.col("piece"), "", -1)).alias("s")).distinct().where("s <> ''").orderBy("s").collect()]
    sym, schema = _Symbols(alphabet), "n long, word array<int>"
    specials = list(specials if specials is not None else K.SPECIAL_TOKENS_TRAINER)
    if num_merges is None:
        num_merges = max(0, vocab_size - len(specials) - len(alphabet))
    points = np.array([ord(c) for c in alphabet], dtype="uint32")
    words = stage(freq.where(F.col("n") >= min_frequency).select("piece", "n").mapInArrow(_symbol_words(points), schema), "bpe-words")
    done, top, fresh = 0, 16 * batch, True  # merges that ``words`` already has; pairs that a batch looks at
    while (room := min(batch, num_merges - len(sym.merges))) > 0:
        if len(sym.merges) - done >= batch or sym.again:
            words = stage(words.mapInArrow(V._rewriter(sym.merges[done:], np.array(sym.made[done:]), 0), schema), "bpe-words")
            done, fresh, sym.again = len(sym.merges), True, False
        if fresh and (words.agg(F.sum(F.size("word"))).first()[0] or 0) <= held:
            _finish(words, sym, num_merges, min_frequency)
            break
        fresh, ahead = False, (sym.merges[done:], np.array(sym.made[done:], dtype="int64"), 0)
        counted = words.mapInArrow(V._pair_counter(*ahead), "a int, b int, c long").groupBy("a", "b").agg(F.sum("c").alias("c"))
        limit = max(top, 16)
        most = counted.where(F.col("c") >= min_frequency).orderBy(F.desc("c")).limit(limit).collect()
        if not most:
            break
        full = len(most) == limit
        if full and most[0].c == most[-1].c:  # more of one count than are looked at: those of least strings
            name = spark.createDataFrame(list(enumerate(sym.names)), "id int, name string")
            tied = counted.where(F.col("c") == most[0].c)
            for end in ("a", "b"):
                tied = tied.join(F.broadcast(name.select(F.col("id").alias(end), F.col("name").alias(f"{end}_name"))), end)
            most = tied.orderBy("a_name", "b_name").limit(limit).collect()
        most = sorted(most, key=lambda r: (-r.c, sym.place((r.a, r.b))))
        seams, floor, found = most, min_frequency, None
        if full:  # pairs as frequent as the last one may be missing
            floor = most[-1].c + 1
            seams = [r for r in most if r.c >= floor]
        while len(seams) > 1:
            cut = words.mapInArrow(V._stretcher([(r.a, r.b) for r in seams], *ahead), "stretch binary, n long")
            found = cut.groupBy("stretch").agg(F.sum("n").alias("n")).limit(sample + 1).collect()
            if len(found) <= sample:
                break
            found, top = None, max(1, min(top, len(seams)) // 4)
            floor = seams[top].c + 1
            seams = [r for r in seams if r.c >= floor]
        if found is None:  # the next merges that can't touch one another need no stretches
            for r in most[:V._apart(most)][:room]:
                sym.of((r.a, r.b))
                sym.add((r.a, r.b), r.c)
                if sym.again:
                    break
            top = max(top, 8)
            continue
        state = V._Sequential([(np.frombuffer(r.stretch, dtype="int32").tolist(), r.n) for r in found], {(r.a, r.b): r.c for r in seams}, sym.place)
        taken = 0
        while taken < room and not sym.again and (step := state.next(sym.of, floor)) is not None:
            sym.add(*step)
            taken += 1
        if taken < room:
            top = min(2 * top, 16 * batch)
    names = [sym.place(p) for p in sym.merges]
    model = BpeModel(specials=specials, alphabet=alphabet, merges=names)
    table = spark.createDataFrame([(i + 1, a, b, c) for i, ((a, b), c) in enumerate(zip(names, sym.counts))],
                                  "rank int, left string, right string, count long")
    return model, table


def _encode_piece(piece: str, ranks: dict[tuple[str, str], int], vocab: dict[str, int], unk: int) -> list[int]:
    sym = list(piece)
    while len(sym) > 1:
        best, best_rank = None, None
        for i in range(len(sym) - 1):
            rk = ranks.get((sym[i], sym[i + 1]))
            if rk is not None and (best_rank is None or rk < best_rank):
                best, best_rank = i, rk
        if best is None:
            break
        a, b = sym[best], sym[best + 1]
        out, i = [], 0
        while i < len(sym):
            if i < len(sym) - 1 and sym[i] == a and sym[i + 1] == b:
                out.append(a + b)
                i += 2
            else:
                out.append(sym[i])
                i += 1
        sym = out
    return [vocab.get(s, unk) for s in sym]


def _ids_of_documents(docs: pa.Array, at: np.ndarray, ids: list[np.ndarray]) -> pa.Array:
    """Lists of ids for lists of pieces; ``at``: each piece's place in ``ids``."""
    size = np.fromiter(map(len, ids), "int64", len(ids))
    start = np.append(0, np.cumsum(size))
    n = size[at]
    ends = np.append(0, np.cumsum(n))  # of pieces, in ids
    flat = np.concatenate([np.empty(0, "int32"), *ids])
    taken = flat[np.arange(ends[-1]) + np.repeat(start[at] - ends[:-1], n)]
    docs_end = np.append(0, np.cumsum(pc.list_value_length(docs).to_numpy(zero_copy_only=False)))
    return pa.ListArray.from_arrays(pa.array(ends[docs_end].astype("int32")), pa.array(taken))


def encode(df: DataFrame, model: BpeModel, text: str = "text", id_col: str = "id") -> DataFrame:
    """``(id, input_ids)``, without a shuffle: a document's pieces are encoded
    where it is, with a cache of piece encodings that is emptied when full.
    Null and empty texts keep their row, with no ids."""
    spark: SparkSession = df.sparkSession
    ranks = {(a, b): i for i, (a, b) in enumerate(model.merges)}
    vocab = model.vocab()
    unk = len(vocab)
    bc = spark.sparkContext.broadcast((ranks, vocab, unk))  # size bounded by the vocabulary

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def enc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        r, v, u = bc.value
        known: dict[str, np.ndarray] = {}
        for docs in batches:
            if len(known) >= CACHED_PIECES:
                known.clear()
            # a batch stays in Arrow columns: only its distinct pieces become Python objects
            coded = docs.flatten().dictionary_encode()
            ids = [known[p] if p in known else known.setdefault(p, np.array(_encode_piece(p, r, v, u), "int32")) for p in coded.dictionary.to_pylist()]
            yield _ids_of_documents(docs, coded.indices.to_numpy(), ids)

    own = F.coalesce(pieces(text), F.array().cast("array<string>"))
    return df.select(id_col, enc(own).alias("input_ids"))


def special_token_table(spark: SparkSession, profile: str = "trainer") -> DataFrame:
    """T4: ``(token, id)`` for a named profile (broadcast-size by construction)."""
    toks = K.SPECIAL_TOKENS_TRAINER if profile == "trainer" else K.SPECIAL_TOKENS_GUIDE
    return spark.createDataFrame([(t, i) for i, t in enumerate(toks)], "token string, id int")
