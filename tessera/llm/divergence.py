"""Divergence of the sources of each language, by hash-consed segment trees.

Terms of a language are numbered and their counts in one group (language and
source) are the leaves of a segment tree.  Trees are hash-consed: a subtree of
equal counts is one node whoever has it, so a rare group's tree is mostly the
one all-zero subtree of each height.  Two groups are compared by walking their
trees together; a pair of nodes that comes up again is priced once.

In Spark the lower levels of a language's trees are cut into subtrees of about
``LEAVES`` terms by the terms' hash; a task holds one such subtree of at most
two blocks of ``SOURCE_BLOCK`` sources, and the upper levels are the sum over
subtrees.  Neither a language nor a source nor a term is ever in one task.

Numbers: of the terms that occur in at least ``min_docs`` documents of the
language, a group with N occurrences gives p = 1 + floor(scale (count + 1) /
(N + V)); f = floor((p - q)^2 / q).  All of it is whole-number arithmetic.

Edge cases: null text, lang and source count as empty; every row is a document
of its own, repeated rows too; groups without terms take part (N = 0); a
language without kept terms has pairs of value 0 and no terms; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged

LEAVES = 4096
SOURCE_BLOCK = 64
FLUSH = 2_000_000  # term occurrences that a task counts at once
# bytes that stay in a term (A-Z become a-z, all of UTF-8 beyond ASCII stays); the rest separate terms
_TERM_BYTES = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _count_terms(held: int):
    """Task: (lang, source, term, c, d), occurrences and documents, summed over up to ``held`` occurrences."""

    def rows(code, group, tokens, owner):
        names, groups = list(code), list(group)
        sizes = np.array([len(t) for t in tokens])
        flat = np.concatenate(tokens).astype(np.int64)
        doc = np.repeat(np.arange(len(tokens)), sizes)
        pair, c = np.unique(doc * len(names) + flat, return_counts=True)
        who = np.array(owner)[pair // len(names)] * len(names) + pair % len(names)
        key, at, d = np.unique(who, return_inverse=True, return_counts=True)
        total = np.bincount(at, weights=c, minlength=len(key)).astype(np.int64)
        for i in range(0, len(key), 100_000):
            g, t = key[i:i + 100_000] // len(names), key[i:i + 100_000] % len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([groups[x][0] for x in g]), pa.array([groups[x][1] for x in g]), pa.array([names[x].decode() for x in t]),
                 pa.array(total[i:i + 100_000]), pa.array(d[i:i + 100_000])], names=["lang", "source", "term", "c", "d"])

    def run(batches):
        code, group, tokens, owner, size = _Numbers(), _Numbers(), [], [], 0
        for batch in batches:
            for text, lang, source in zip(*[batch.column(c).to_pylist() for c in ("text", "lang", "source")]):
                words = text.encode().translate(_TERM_BYTES).split()
                if words:
                    tokens.append(np.fromiter(map(code.__getitem__, words), np.int32, len(words)))
                    owner.append(group[lang, source])
                    size += len(words)
                if size >= held:
                    yield from rows(code, group, tokens, owner)
                    code, group, tokens, owner, size = _Numbers(), _Numbers(), [], [], 0
        if tokens:
            yield from rows(code, group, tokens, owner)

    return run


class _Numbers(dict):
    """Numbers keys in order of first use."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class ConsedTrees:
    """Segment trees over the rows of ``leaves`` (trees x a power of two), with
    equal subtrees of all trees as one node.  ``levels[k]`` are the (left, right)
    children of the nodes of height k + 1."""

    def __init__(self, leaves: np.ndarray):
        self.values, node = np.unique(leaves, return_inverse=True)
        node = node.reshape(leaves.shape)
        self.levels = []
        while node.shape[1] > 1:
            size = int(node.max()) + 1
            pair, up = np.unique(node[:, ::2].astype(np.int64) * size + node[:, 1::2], return_inverse=True)
            self.levels.append((pair // size, pair % size))
            node = up.reshape(node.shape[0], -1)
        self.roots = node[:, 0]

    def price(self, a: int, b: int, leaf) -> tuple[int, ...]:
        """Sums of ``leaf(values of a, values of b)`` (a tuple of arrays) over the
        leaves of trees ``a`` and ``b``, each pair of nodes priced once."""
        x, y = self.roots[[a]].astype(np.int64), self.roots[[b]].astype(np.int64)
        memo = []
        for left, right in reversed(self.levels):
            size = max(int(left.max()), int(right.max())) + 1
            both, at = np.unique(np.concatenate([left[x] * size + left[y], right[x] * size + right[y]]), return_inverse=True)
            memo.append(at)
            x, y = both // size, both % size
        sums = leaf(self.values[x], self.values[y])
        for at in reversed(memo):
            half = len(at) // 2
            sums = tuple(s[at[:half]] + s[at[half:]] for s in sums)
        return tuple(int(s[0]) for s in sums)


def _share(c: np.ndarray, total: int, scale: int) -> np.ndarray:
    """1 + floor(scale (c + 1) / total), exactly; 64-bit integers where they hold it."""
    if len(c) and scale * (int(c.max()) + 1) >= 2 ** 63:
        return np.array([1 + scale * (int(v) + 1) // total for v in c], np.int64)
    return 1 + scale * (c + 1) // total


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _compare(scale: int, top: int):
    """Task of one subtree: priced pairs of sources and each source's first terms."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lang, _, bi, bj = key
        marks, rows = pdf[pdf["term"].isna()], pdf[pdf["term"].notna()]
        out = []
        sources = marks["source"].tolist()
        sizes = [int(n) + int(v) for n, v in zip(marks["n"], marks["v"])]
        blocks = marks["block"].tolist()
        every = int(marks["n_lang"].iloc[0]) + int(marks["v"].iloc[0])
        size = int(marks["terms"].iloc[0])  # terms of the subtree, also those that only other blocks' sources have
        place = {s: i for i, s in enumerate(sources)}
        terms, at = np.unique(rows["term"].to_numpy(object), return_inverse=True)
        leaves = np.full((len(sources), 1 << (size - 1).bit_length()), -1, np.int64)  # -1: no term here, priced 0
        leaves[:, :size] = 0
        leaves[rows["source"].map(place).to_numpy(np.int64), at] = rows["c"].to_numpy(np.int64)
        trees = ConsedTrees(leaves)

        def leaf(a: int, b: int):
            def f(x, y):
                p, q = _share(x, sizes[a], scale), _share(y, sizes[b], scale)
                return np.where(x < 0, 0, _distance(p, q)), np.where(x < 0, 0, _distance(q, p))
            return f

        for a in range(len(sources)):
            for b in range(a + 1, len(sources)):
                if bi == bj or blocks[a] != blocks[b]:
                    ab, ba = trees.price(a, b, leaf(a, b))
                    out += [(lang, sources[a], "pair", sources[b], ab), (lang, sources[b], "pair", sources[a], ba)]
        if bi == bj:
            total = np.zeros(len(terms), np.int64)
            total[at] = rows["total"].to_numpy(np.int64)
            q = _share(total, every, scale)
            for a, source in enumerate(sources):
                own = leaves[a, :len(terms)]
                p = _share(own, sizes[a], scale)
                f = _distance(p, q)
                have = np.flatnonzero((own > 0) & (p > q))
                first = sorted(have, key=lambda i: (-f[i], terms[i].encode()))[:top]
                out += [(lang, source, "term", terms[i], int(f[i])) for i in first]
        return pd.DataFrame(out, columns=["lang", "source", "part", "item", "value"])

    return run


def term_counts(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """(lang, source, term, c, total, lead): occurrences of each kept term in a group
    and in its language; ``lead`` marks one row a term.  Counts are summed in
    tasks before they are dealt by term, so a common term has a row a task and group."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    found = own.mapInArrow(_count_terms(FLUSH), "lang string, source string, term string, c long, d long")
    counts = found.repartition(parts, "lang", "term").groupBy("lang", "term", "source").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    w = Window.partitionBy("lang", "term")
    counts = counts.withColumns({"docs": F.sum("d").over(w), "total": F.sum("c").over(w),
                                 "lead": F.row_number().over(w.orderBy("source")) == 1})
    return counts.where(F.col("docs") >= min_docs).select("lang", "source", "term", "c", "total", "lead")


def source_divergence(docs: DataFrame, min_docs: int = 3, scale: int = 1_000_000_000, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank.  Part ``pair`` prices a group against
    every other source of its language, part ``term`` lists the ``top`` terms that
    it uses more than the language does."""
    kept = staged(term_counts(docs, min_docs), "divergence-counts")
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("c").alias("n_lang"), F.count_if("lead").alias("v"))
    each = groups.groupBy("lang").agg(F.count("*").alias("s")).join(langs, "lang", "left")
    groups = groups.join(sums, ["lang", "source"], "left").join(each, "lang").na.fill(0, ["n", "n_lang", "v"])
    groups = staged(groups, "divergence-groups").withColumns({
        "chunks": F.ceil(F.col("v") / LEAVES).cast("int"), "nb": F.ceil(F.col("s") / SOURCE_BLOCK).cast("int")})
    layout = groups.select("lang", "chunks", "nb").distinct()
    placed = kept.join(layout, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int"))

    # one row a term and group, and one mark a subtree and group; each goes to the pairs of blocks its own is in
    block = F.pmod(F.xxhash64("source"), F.col("nb")).cast("int").alias("block")
    subtrees = placed.where("lead").groupBy("lang", "chunk").agg(F.count("*").alias("terms"))
    numbers = ("n", "v", "n_lang", "terms")
    rows = placed.select("lang", "chunk", block, "nb", "source", "term", "c", "total", *[F.lit(None).cast("long").alias(c) for c in numbers])
    marks = groups.join(subtrees, "lang").select("lang", "chunk", block, "nb", "source", F.lit(None).cast("string").alias("term"),
                                                 *[F.lit(None).cast("long").alias(c) for c in ("c", "total")], *numbers)
    work = rows.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    work = work.withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}).drop("other", "nb")
    priced = work.groupBy("lang", "chunk", "bi", "bj").applyInPandas(
        _compare(scale, top), "lang string, source string, part string, item string, value long")
    priced = staged(priced, "divergence-priced")

    other = groups.select("lang", F.col("source").alias("item"))
    sums = priced.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", "source").join(other, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(order)),
              priced.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)]
    return ranked[0].unionByName(ranked[1])
