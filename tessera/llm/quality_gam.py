"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits the features in turn; each visit fits a shallow tree
to the log-loss gradient over that one feature's bins and adds it, shrunk, to
the feature's lookup table.  The best pairs of features then get two-way
tables the same way.  A score is the logistic of the sum of table entries, so
scoring a batch is one gather and add per table.

Labels are learned from a bounded sample (``sample_rows``); the features of
every document come from its whole text.  Null text counts as empty; an empty
text has all-zero features and gets a score like any other.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("log_chars", "log_words", "word_length", "upper", "digits", "space", "newlines", "marks", "symbols",
            "exclaims", "bars", "high_bytes", "entropy", "distinct", "top_word", "repeats", "line_copies",
            "long_words", "short_words", "mark_ends")
_MARKS = np.zeros(256, bool)
_MARKS[[b for b in b".,;:!?'\"()[]{}-_/\\"]] = True
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[b for b in b"#$%&*+<=>@^`|~"]] = True


def text_features(text: str | None) -> list[float]:
    """Features of one whole text, in the order of ``FEATURES``."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(raw)
    words = text.split()
    k = len(words)
    if not n or not k:
        return [float(np.log1p(len(text)))] + [0.0] * (len(FEATURES) - 1)
    count = np.bincount(raw, minlength=256)
    upper, lower = count[65:91].sum(), count[97:123].sum()
    share = count[count > 0] / n
    often = Counter(words)
    lines = [x for x in text.split("\n") if x]
    lengths = np.fromiter(map(len, words), np.int64, k)
    repeats = sum(map(str.__eq__, words, words[1:]))
    ends = sum(1 for w in words if not w[-1].isalnum())
    return [float(np.log1p(len(text))), float(np.log1p(k)), float(lengths.mean()), upper / max(1, upper + lower),
            count[48:58].sum() / n, (count[32] + count[9:14].sum()) / n, count[10] / k, count[_MARKS].sum() / n,
            count[_SYMBOLS].sum() / n, count[33] / k, count[124] / k, count[128:].sum() / n,
            float(-(share * np.log2(share)).sum()), len(often) / k, max(often.values()) / k, repeats / k,
            1 - len(set(lines)) / max(1, len(lines)), float((lengths > 15).mean()), float((lengths == 1).mean()), ends / k]


@dataclass
class GamModel:
    """Bin edges and lookup tables; a few thousand numbers whatever the data."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
        for b, t in zip(bins, self.tables):
            total += t[b]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            total += t[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray, cut: int, ridge: float) -> tuple[float, float, float]:
    gl, hl = g[:cut].sum(), h[:cut].sum()
    gr, hr = g[cut:].sum(), h[cut:].sum()
    return gl * gl / (hl + ridge) + gr * gr / (hr + ridge), gl / (hl + ridge), gr / (hr + ridge)


def _tree_1d(g: np.ndarray, h: np.ndarray, ridge: float, depth: int = 2) -> np.ndarray:
    """Newton step per bin of a tree of ``depth`` over the bins' order."""
    if depth == 0 or len(g) < 2:
        return np.full(len(g), g.sum() / (h.sum() + ridge))
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = cg ** 2 / (ch + ridge) + (g.sum() - cg) ** 2 / (h.sum() - ch + ridge)
    cut = int(np.argmax(gain)) + 1
    return np.concatenate([_tree_1d(g[:cut], h[:cut], ridge, depth - 1), _tree_1d(g[cut:], h[cut:], ridge, depth - 1)])


def _tree_2d(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """One cut on the first axis, then one on the second axis in either half."""
    best, out = -1.0, np.zeros_like(g)
    for a in range(1, g.shape[0]):
        gain, parts = 0.0, []
        for rows in (slice(None, a), slice(a, None)):
            gs, hs = g[rows].sum(0), h[rows].sum(0)
            found = max((_leaf(gs, hs, c, ridge) + (c,) for c in range(1, len(gs))), default=None)
            if found is None:
                return out, 0.0
            gain += found[0]
            parts.append((rows, found))
        if gain > best:
            best, out = gain, np.zeros_like(g)
            for rows, (_, left, right, c) in parts:
                out[rows, :c], out[rows, c:] = left, right
    return out, best


def fit_gam(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, rate: float = 0.1, ridge: float = 2.0,
            n_pairs: int = 8, pair_bins: int = 8, pair_rounds: int = 60) -> GamModel:
    """Fit on feature rows ``x`` and 0/1 labels ``y``.  With no rows, or one
    class only, the tables stay zero and every score is the smoothed base rate."""
    d = x.shape[1]
    rate_1 = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(rate_1 / (1 - rate_1)))
    edges = [_edges(x[:, j], bins) if len(x) else np.empty(0) for j in range(d)]
    b = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    coarse = [np.arange(len(e) + 1) * pair_bins // (len(e) + 1) for e in edges]
    model = GamModel(base, edges, tables, coarse, [], [])
    if not len(y) or y.min() == y.max():
        return model
    f = np.full(len(y), base)

    def step() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(d):
            if len(tables[j]) > 1:
                g, h = step()
                up = rate * _tree_1d(np.bincount(b[j], g, len(tables[j])), np.bincount(b[j], h, len(tables[j])), ridge)
                tables[j] += up
                f += up[b[j]]
    g, h = step()
    c = [coarse[j][b[j]] for j in range(d)]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(c[i] * pair_bins + c[j], v, pair_bins * pair_bins).reshape(pair_bins, pair_bins)

    ranked = sorted(((_tree_2d(grid(i, j, g), grid(i, j, h), ridge)[1], i, j) for i in range(d) for j in range(i)),
                    reverse=True)[:n_pairs]
    model.pairs = [(i, j) for _, i, j in ranked]
    model.pair_tables = [np.zeros((pair_bins, pair_bins)) for _ in ranked]
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.pair_tables):
            g, h = step()
            up = rate * _tree_2d(grid(i, j, g), grid(i, j, h), ridge)[0]
            t += up
            f += up[c[i], c[j]]
    return model


def training_rows(docs: DataFrame, labels: DataFrame, target: str, sample_rows: int) -> DataFrame:
    """Texts and labels of at most ``sample_rows`` labelled documents, picked by
    a hash of the id.  Rows without a label or id are left out; of repeated
    label rows the least label counts.  The picked ids are broadcast: at most
    ``sample_rows`` rows of two numbers."""
    picked = (labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").alias("__id")).agg(F.min(target).cast("int").alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id").limit(sample_rows))
    return (docs.select(F.col("doc_id").alias("__doc"), F.coalesce("text", F.lit("")).alias("__text"))
            .join(F.broadcast(picked), F.col("__doc") == F.col("__id")).select("__id", "__text", "__y"))


def fit_quality(docs: DataFrame, labels: DataFrame, target: str = "quality", sample_rows: int = 20000, **kw) -> GamModel:
    """Learn from ``labels`` (doc_id, ``target``); only the rows given are seen,
    so the caller leaves held-out ids out.  What reaches the driver is
    ``sample_rows`` rows of 20 numbers at most."""
    width = len(FEATURES)

    @F.pandas_udf("array<double>")
    def features(s: pd.Series) -> pd.Series:
        return pd.Series([text_features(t) for t in s])

    got = training_rows(docs, labels, target, sample_rows).select("__id", "__y", features("__text").alias("x")).toPandas()
    got = got.sort_values(["__id", "__y"], kind="stable")
    x = np.array(got["x"].tolist(), float).reshape(-1, width)
    return fit_gam(x, got["__y"].to_numpy(float), **kw)


def quality_score(model: GamModel):
    """Column function: text -> probability of label 1 (never null)."""
    width = len(FEATURES)

    @F.pandas_udf("double")
    def score(s: pd.Series) -> pd.Series:
        x = np.array([text_features(t) for t in s], float).reshape(-1, width)
        return pd.Series(model.score(x))

    return score


def with_quality(docs: DataFrame, model: GamModel, out: str = "score") -> DataFrame:
    """``docs`` with the score of its whole text in ``out`` (a column of that
    name is replaced); every row stays, repeated rows score alike."""
    return docs.withColumn(out, quality_score(model)(F.coalesce("text", F.lit(""))))
