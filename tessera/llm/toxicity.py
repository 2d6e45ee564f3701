"""Toxicity by nearest labelled examples under cosine of label-weighted TF-IDF.

A bounded, documented sample of labelled documents becomes an index of
examples.  Every term of the sample is indexed.  A term weighs its inverse
document frequency, which counts every document, times the strength with which
its presence goes with the label in the sample (phi; copies of one text count
once).  The weight is never zero: what goes with no label weighs as much as
chance gives.  So one rare word that only toxic examples hold outweighs the
text around it, and a text of other words is still compared by those words.

Neighbours are exact.  All cosines are first taken in single precision: terms
that many examples hold are one dense matrix, the others are postings.  The
examples that these, with their rounding error, don't rule out are compared in
doubles.  Neighbours vote with a weight that grows
as the cosine distance shrinks; leave-one-out votes of the examples themselves
calibrate the vote into a probability.

Null text counts as empty.  A text that shares no term with the sample has no
neighbour and scores as such examples did in the sample.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.quality_gam import training_rows

TEXTS = 2048  # texts whose terms are looked up at a time
_TERM = re.compile(r"\w+")
# bytes of UTF-8: A-Z lower-cased, what is no part of a term a blank, non-ASCII as it is
_ASCII = bytes(ord(chr(c).lower()) if c < 128 and _TERM.match(chr(c)) else c if c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[str]:
    """``\\w+`` of the lower-cased text; only parts with non-ASCII letters need the pattern."""
    text = text or ""
    if "\u03a3" in text:  # how this letter is lower-cased depends on what stands around it
        return _TERM.findall(text.lower())
    parts = text.encode("utf-8", "surrogatepass").translate(_ASCII).decode("utf-8", "surrogatepass").split()
    if text.isascii():
        return parts
    out = []
    for p in parts:
        if p.isascii() or (p := p.lower()).isalnum():
            out.append(p)
        else:
            out += _TERM.findall(p)
    return out


class Vocabulary(Mapping):
    """Term -> number in order; held and sent as one string, and numbered where a
    term is first looked up, which the driver need not do."""

    def __init__(self, names: str, size: int):
        self.names, self.size, self.made, self.kept = names, size, None, None

    def __reduce__(self):
        return Vocabulary, (self.names, self.size)

    @property
    def numbers(self) -> dict[str, int]:
        if self.made is None:
            self.made = {t: i for i, t in enumerate(self)}
        return self.made

    @property
    def order(self) -> list[str]:
        if self.kept is None:
            self.kept = list(self.numbers)  # its strings, no copies of them
        return self.kept

    def numbers_of(self, terms: Collection[str]) -> np.ndarray:
        """The numbers of some terms, -1 of those it doesn't have."""
        return np.fromiter(map(self.numbers.get, terms, repeat(-1)), np.int32, len(terms))

    def __getitem__(self, term: str) -> int:
        return self.numbers[term]

    def __iter__(self):
        return iter(self.names.split("\n") if self.size else ())

    def __len__(self) -> int:
        return self.size


@dataclass
class ExampleIndex:
    """Bounded by the terms of ``sample_rows`` examples."""

    terms: Vocabulary
    weight: np.ndarray    # of a term: idf times association
    ids: np.ndarray       # example ids in the order of places
    labels: np.ndarray
    first: np.ndarray     # place -> its first entry, and the end
    held: np.ndarray      # terms of the examples by place
    times: np.ndarray     # how often the example has the term
    block_size: int
    k: int
    base: float
    steps: tuple[np.ndarray, np.ndarray]  # calibration: vote -> probability
    blank: float
    lists: tuple[np.ndarray, ...] | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"lists": None}

    def example(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.first[place], self.first[place + 1])
        return self.unit(self.held[at], self.times[at])

    def unit(self, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = (1.0 + np.log(n, dtype=float)) * self.weight[t]
        return t, raw / max(float(np.sqrt(raw @ raw)), 1e-300)

    def postings(self) -> tuple[np.ndarray, ...]:
        """Of the terms that few examples hold: term -> first posting; places and
        weights by term, then place.  Of the others: term -> row of the dense
        matrix or -1; that matrix.  Then the examples' norms, the weights of 0, 1,
        2, ... times, and a zero per term.  Made where it is first used."""
        if self.lists is None:
            n, size = len(self.ids), np.diff(self.first)
            lots = 1.0 + np.log(np.maximum(np.arange(int(self.times.max(initial=0)) + 1), 1.0))
            often = np.flatnonzero(np.bincount(self.held, minlength=len(self.terms)) > n // 16)
            row = np.full(len(self.terms), -1, np.int32)
            row[often] = np.arange(len(often))
            matrix, norm = np.zeros((len(often), n), np.float32), np.empty(n)
            rest = [(np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.float32))]
            for lo in range(0, n, 1000):  # a few examples at a time bounds the doubles held
                hi = min(lo + 1000, n)
                at = slice(self.first[lo], self.first[hi])
                t, place = self.held[at], np.repeat(np.arange(lo, hi, dtype=np.int32), size[lo:hi])
                w = lots.take(self.times[at]) * self.weight.take(t)
                norm[lo:hi] = np.sqrt(np.add.reduceat(w * w, self.first[lo:hi] - self.first[lo]))
                w = (w / norm.take(place)).astype(np.float32)
                r = row.take(t)
                matrix[r[r >= 0], place[r >= 0]] = w[r >= 0]
                rest.append((t[r < 0], place[r < 0], w[r < 0]))
            t, place, w = (np.concatenate(x) for x in zip(*rest))
            starts = np.append(0, np.cumsum(np.bincount(t, minlength=len(self.terms))))
            order = np.argsort(t, kind="stable")
            self.lists = starts, place[order], w[order], row, matrix, norm, lots, np.zeros(len(self.terms))
        return self.lists

    @property
    def blocks(self) -> list[dict[int, tuple[np.ndarray, np.ndarray]]]:
        """Per block of ``block_size`` examples: term -> places in the block, weights."""
        made: list[dict] = [{} for _ in range(-(-len(self.ids) // self.block_size))]
        order = np.argsort(self.held, kind="stable")
        places = np.repeat(np.arange(len(self.ids)), np.diff(self.first))[order]
        weights = np.concatenate([np.empty(0), *[self.example(i)[1] for i in range(len(self.ids))]])[order]
        starts = np.searchsorted(self.held[order], np.arange(len(self.terms) + 1))
        for t in range(len(self.terms)):
            at = slice(starts[t], starts[t + 1])
            block = places[at] // self.block_size
            for b in np.unique(block):
                made[b][t] = (places[at][block == b] % self.block_size, weights[at][block == b])
        return made

    def counts(self, texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each text its terms in order, and how often it has them.  A term is
        looked up once for some texts."""
        for at in range(0, len(texts), TEXTS):
            own: dict[str, int] = {}
            held = [[own.setdefault(t, len(own)) for t in terms_of(text)] for text in texts[at:at + TEXTS]]
            number = self.terms.numbers_of(own)
            for line in held:
                t = number[np.array(line, np.int64)]
                yield np.unique(t[t >= 0], return_counts=True)

    def vectors(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        return [self.unit(*x) for x in self.counts(texts)]

    def vector(self, text: str | None) -> dict[int, float]:
        t, w = self.vectors([text])[0]
        return dict(zip(t.tolist(), w.tolist()))

    def rough(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Cosines of some vectors with all examples, within ``slack / 2``."""
        starts, places, weights, row, matrix, *_ = self.postings()
        query, rest = np.zeros((len(vectors), len(matrix)), np.float32), []
        for q, (t, w) in zip(query, vectors):
            r = row[t]
            q[r[r >= 0]] = w[r >= 0]
            rest.append((t[r < 0], w[r < 0]))
        score = query @ matrix
        for line, (t, w) in zip(score, rest):
            size = starts[t + 1] - starts[t]
            at = _ranges(starts[t], size)
            if len(at):
                line += np.bincount(places.take(at), weights.take(at) * np.repeat(w, size), len(line))
        return score

    @property
    def slack(self) -> float:
        """Twice the error of a rough cosine: sums of at most so many rounded
        products, none negative, that make up 1 at most."""
        return (len(self.postings()[4]) + 8) * float(np.finfo(np.float32).eps)

    def exact(self, vector: tuple[np.ndarray, np.ndarray], some: np.ndarray) -> np.ndarray:
        """Cosines of a vector with some examples."""
        *_, norm, lots, full = self.postings()
        full[vector[0]] = vector[1] * self.weight[vector[0]]
        out = np.empty(len(some))
        for at in range(0, len(some), 1024):  # bounds the entries held
            first, size = self.first[some[at:at + 1024]], np.diff(self.first)[some[at:at + 1024]]
            entry = _ranges(first, size)
            out[at:at + 1024] = np.add.reduceat(lots.take(self.times.take(entry)) * full.take(self.held.take(entry)), np.cumsum(size) - size)
        full[vector[0]] = 0.0
        out /= norm[some]
        return np.round(out, 12, out=out)  # sums in another order differ less: copies tie

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], leave_out: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """Per vector the k greatest positive cosines as (cosine, place), ties by place."""
        out = []
        for at in range(0, len(vectors), 256):  # some vectors at a time bounds the cosines held
            for i, line in enumerate(self.rough(vectors[at:at + 256])):
                if leave_out is not None:
                    line[leave_out[at + i]] = 0.0
                least = float(np.partition(line, -self.k)[-self.k]) - self.slack if len(line) > self.k else 0.0
                some = np.flatnonzero(line >= least if least > 0 else line > 0)
                cosine = self.exact(vectors[at + i], some)
                best = np.argsort(-cosine, kind="stable")[:self.k]
                best = best[cosine[best] > 0]
                out.append(list(zip(cosine[best].tolist(), some[best].tolist())))
        return out

    def neighbours(self, vector: dict[int, float], leave_out: int | None = None) -> list[tuple[float, int]]:
        arrays = np.array(list(vector), np.int32), np.array(list(vector.values()), float)
        return self.nearest([arrays], None if leave_out is None else [leave_out])[0]

    def vote(self, near: list[tuple[float, int]]) -> float:
        weight = [s / (1.1 - min(1.0, s)) for s, _ in near]
        yes = sum(w for w, (_, i) in zip(weight, near) if self.labels[i])
        return (yes + self.base) / (sum(weight) + 1.0)

    def probability(self, near: list[tuple[float, int]]) -> float:
        if not near:
            return self.blank
        v = self.vote(near)
        votes, prob = self.steps
        p = float(np.interp(v, votes, prob)) if len(votes) else v
        return min(1.0, max(0.0, 0.98 * p + 0.02 * v))  # the small part keeps the order within a step


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each size, one after the other."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(first - end + size, size)


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; each pool's rate is smoothed by one half of a row a class."""
    pools: list[list[float]] = []
    for v, rows in pd.Series(y).groupby(x):
        pools.append([float(v) * len(rows), float(rows.sum()), float(len(rows))])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    at = np.array([p[0] / p[2] for p in pools])
    return at, np.array([(p[1] + 0.5) / (p[2] + 1.0) for p in pools])


def _associations(sample: DataFrame, min_chi2: float, min_phi2: float, min_texts: int) -> tuple[Vocabulary, np.ndarray]:
    """The terms of the sample and their association with the label: phi, and
    at least what chance gives.  Counts are of distinct least hashes of word
    triples, which copies and near copies of a text share, so a copied text
    counts about once.  Without examples of both labels every term counts alike."""

    def distinct(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 200):  # a few texts at a time bounds the rows held
                label, least, term = [], [], []
                for y, text in zip(pdf["__y"].iloc[at:at + 200].tolist(), pdf["__text"].iloc[at:at + 200]):
                    if words := terms_of(text):
                        h = min(zlib.crc32(" ".join(words[i:i + 3]).encode("utf-8", "surrogatepass"))
                                for i in range(max(1, len(words) - 2)))
                        own = set(words)
                        label += [y] * len(own)
                        least += [h] * len(own)
                        term += own
                yield pd.DataFrame({"__y": label, "h": least, "term": term})

    held = sample.select("__y", "__text").mapInPandas(distinct, "__y int, h long, term string")
    n = {r["__y"]: r["n"] for r in held.groupBy("__y").agg(F.countDistinct("h").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    per = (held.groupBy("term").agg(F.countDistinct(F.when(F.col("__y") == 1, F.col("h"))).alias("a"),
                                    F.countDistinct(F.when(F.col("__y") == 0, F.col("h"))).alias("b")).toArrow())
    per = per.take(pc.sort_indices(per["term"]))  # stays Arrow: as Python strings the terms are many times as large
    a, b = per["a"].to_numpy().astype(float), per["b"].to_numpy().astype(float)
    if n1 and n0:
        phi2 = (a * (n0 - b) - b * (n1 - a)) ** 2 / (float(n1) * n0 * (a + b) * (n1 + n0 - a - b + 1e-9))
    else:
        phi2 = np.ones(len(per))
    keep = (np.maximum(a, b) >= min_texts) & (phi2 * (n1 + n0) >= max(min_chi2, min_phi2 * (n1 + n0)))
    strength = np.sqrt(np.maximum(phi2[keep], 1.0 / max(n1 + n0, 1)))
    terms = pa.concat_arrays([*per["term"].filter(pa.array(keep)).chunks, pa.array([], per["term"].type)])
    names = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms), "\n")[0].as_py()
    return Vocabulary(names, len(terms)), strength


def document_frequencies(docs: DataFrame, terms: Vocabulary) -> tuple[np.ndarray, int]:
    """Rows of ``docs`` that hold each vocabulary term, and all rows; every task
    sends one row per term it has seen."""

    held = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        terms = held.value
        seen, rows = np.zeros(len(terms), np.int64), 0
        for pdf in batches:
            rows += len(pdf)
            for at in range(0, len(pdf), TEXTS):
                own: Counter[str] = Counter()
                for text in pdf["__text"].iloc[at:at + TEXTS]:
                    own.update(set(terms_of(text)))
                t, n = terms.numbers_of(own), np.fromiter(own.values(), np.int64, len(own))
                seen[t[t >= 0]] += n[t >= 0]
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"t": np.append(at, -1), "n": np.append(seen[at], rows)})

    got = (docs.select(F.coalesce("text", F.lit("")).alias("__text")).mapInPandas(count, "t long, n long")
           .groupBy("t").agg(F.sum("n").alias("n")).toArrow())
    held.destroy()
    t, n = got["t"].to_numpy(), got["n"].to_numpy()
    df = np.zeros(len(terms), np.int64)
    df[t[t >= 0]] = n[t >= 0]
    return df, int(n[t < 0].sum())


def build_index(docs: DataFrame, labels: DataFrame, target: str = "toxic", sample_rows: int = 20000, k: int = 16,
                block_size: int = 64, min_chi2: float = 0.0, min_phi2: float = 0.0, min_texts: int = 1) -> ExampleIndex:
    """Index over all terms of at most ``sample_rows`` labelled documents, which
    is all that reaches the driver (as term numbers and counts).  ``min_chi2``,
    ``min_phi2`` and ``min_texts`` leave terms out on demand."""
    context = docs.sparkSession.sparkContext
    sample = training_rows(docs, labels, target, sample_rows)
    terms, strength = _associations(sample, min_chi2, min_phi2, min_texts)
    df, total = document_frequencies(docs, terms)
    weight = (np.log((1.0 + total) / (1.0 + df)) + 1.0) * strength
    none = np.empty(0, np.int64)
    index = ExampleIndex(terms, weight, none, none, np.zeros(1, np.int64), np.empty(0, np.int32), np.empty(0, np.int32), block_size, k,
                         0.0, (np.empty(0), np.empty(0)), 0.0)
    sent = context.broadcast(index)

    @F.pandas_udf("struct<t: binary, n: binary>")
    def counted(s: pd.Series) -> pd.DataFrame:
        got = list(sent.value.counts(s.tolist()))
        return pd.DataFrame({"t": [t.tobytes() for t, _ in got], "n": [n.astype(np.min_scalar_type(n.max(initial=0))).tobytes() for _, n in got]})

    rows = sample.select("__id", "__y", counted("__text").alias("v")).select("__id", "__y", "v.*").toArrow().to_pandas()
    rows = rows.sort_values(["__id", "__y", "t", "n"], kind="stable")
    y = rows["__y"].to_numpy(np.int64)
    index.base = (int(y.sum()) + 0.5) / (len(y) + 1.0)
    some = rows["t"].map(len).to_numpy() > 0
    index.blank = (int(y[~some].sum()) + 0.5) / (int((~some).sum()) + 1.0) if (~some).any() else index.base
    if not some.any():
        return index
    index.ids, index.labels = rows["__id"].to_numpy(np.int64)[some], y[some]
    size = rows["t"][some].map(len).to_numpy() // 4
    index.first = np.append(0, np.cumsum(size))
    index.held = np.frombuffer(b"".join(rows["t"][some]), np.int32)
    index.times = np.concatenate([np.frombuffer(n, f"u{4 * len(n) // len(t)}") for t, n in zip(rows["t"][some], rows["n"][some])])
    del rows
    sent.destroy()
    sent = context.broadcast(index)

    def votes(batches):
        index = sent.value
        for pdf in batches:
            own = pdf["id"].tolist()
            near = index.nearest([index.example(i) for i in own], own)
            yield pd.DataFrame({"id": own, "vote": [index.vote(x) for x in near]})

    voted = docs.sparkSession.range(len(size)).mapInPandas(votes, "id long, vote double").toArrow().to_pandas().sort_values("id")
    index.steps = _isotonic(voted["vote"].to_numpy(float), index.labels.astype(float))
    sent.destroy()
    return index


def with_toxicity(docs: DataFrame, index: ExampleIndex, out: str = "toxicity", evidence: int = 3) -> DataFrame:
    """``docs`` with a struct column ``out``: score, the number of neighbours,
    and evidence (``id:label:cosine`` of the nearest, and the greatest terms).
    Every row stays; a column called ``out`` is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("struct<score: double, neighbours: int, evidence: string>")
    def judge(s: pd.Series) -> pd.DataFrame:
        index = sent.value
        names = index.terms.order
        made = []
        for at in range(0, len(s), TEXTS):
            vectors = index.vectors(s.iloc[at:at + TEXTS].tolist())
            for (t, w), near in zip(vectors, index.nearest(vectors)):
                shown = [f"{index.ids[i]}:{index.labels[i]}:{c:.4f}" for c, i in near[:evidence]]
                top = t[np.argsort(-w, kind="stable")[:evidence]]
                made.append((index.probability(near), len(near), " ".join(shown + [names[i] for i in top])))
        return pd.DataFrame(made, columns=["score", "neighbours", "evidence"])

    return docs.withColumn(out, judge(F.coalesce("text", F.lit(""))))
