"""N-gram Jaccard join by prefix trees, and the classes of near copies it gives.

A document's set holds the hashes of its distinct word n-grams.  Two documents
link when their sets' Jaccard similarity reaches a threshold.  The steps:

1. Equal sets are one node, named by 62 bits of the sum of their hashes; only
   nodes are compared.
2. Sets are put into one global order: by hash, but n-grams that many nodes
   carry near the front (``HOT_TOKENS`` at most, a bounded list) go behind the
   others.  Two linked sets share an n-gram among the first
   ``n - ceil(t n) + 1`` of either, so nodes meet on those n-grams.
3. Where nodes meet, a parity sketch (each n-gram flips one bit; the differing
   bits of two sketches are never more than the differing n-grams) rules pairs
   out exactly.  What it leaves is written as spanning trees, not as pairs, and
   their components are clusters that no link leaves.
4. In each cluster the full ordered sets form a prefix tree.  A set walks
   the tree level by level, adds the overlap of a branch once for all sets below
   it, and drops branches whose remaining length can't reach the threshold.
   Links are again written as spanning trees.

Large groups and clusters are cut into blocks, and pairs of blocks are spread
over tasks, so no task holds more than two blocks and no group is capped.

Edge cases: null or wordless text has an empty set, linked with nothing; a text
shorter than n words has its whole word sequence as its one n-gram; a null
doc_id stays in the result and takes the least id that it links to, else null;
repeated rows have equal sets; if one id has several texts, each has its row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged, unused
from tessera.llm.components import components

HOT_TOKENS = 65536
SAMPLE_BITS = 0.2       # the share of hash space of which every n-gram is kept beside the prefix
GROUP_BLOCK = 2048
CLUSTER_BLOCK = 256
EDGE_ROWS = 100_000     # edges a task holds before it hands them on
SKETCH_WORDS = 1_000_000  # words of sketches compared at a time
PAIR_ROWS = 200_000     # pairs of a large group compared at a time
PROFILE_ROWS = 1000     # texts whose n-grams a task holds at a time
_CUT = np.uint64(int(SAMPLE_BITS * 2 ** 64))
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_31, _29 = np.uint64(31), np.uint64(29)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text; A-Z count as a-z."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    if len(h) < words:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(parts))], np.uint64)
    else:
        n = len(h) - words + 1
        total = h[:n].copy()
        for i in range(1, words):
            total = (total ^ (total >> _29)) * _A + h[i:i + n]
        h = total
    h = (h ^ (h >> _31)) * _B
    h = (h ^ (h >> _29)) * _C
    return np.unique(h ^ (h >> _31))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity bits, a power of two of them and at least 512 and the set's size;
    halves folded together by XOR give the sketch of half the size."""
    bits = max(512, 1 << max(0, len(tokens) - 1).bit_length())
    at = (tokens >> np.uint64(7)) & np.uint64(bits - 1)
    odd = (np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def _fold(s: np.ndarray, size: int) -> np.ndarray:
    while len(s) > size:
        s = s[:len(s) // 2] ^ s[len(s) // 2:]
    return s


class Forest:
    """Union-find over local places; keeps the edges that joined something."""

    def __init__(self, n: int):
        self.up, self.edges = list(range(n)), []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.edges.append((x, y))


def _groups(batches, keys: list[str]):
    """Frames that hold whole key groups, from batches sorted by key."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        last = np.logical_and.reduce([pdf[k].to_numpy() == pdf[k].iloc[-1] for k in keys])
        cut = len(pdf) - int(last[::-1].argmin()) if not last.all() else 0
        rest = pdf.iloc[cut:]
        if cut:
            yield pdf.iloc[:cut]
    if rest is not None and len(rest):
        yield rest


def _may_link(n1, n2, differ, t: tuple[int, int]):
    """Whether sets of these sizes with at least ``differ`` unshared n-grams can
    link: intersection <= (n1 + n2 - differ) / 2."""
    num, den = t
    both = n1 + n2
    small, large = np.minimum(n1, n2), np.maximum(n1, n2)
    return (den * small >= num * large) & (den * (both - differ) >= num * (both + differ))


def _meet(keys: list[str], t: tuple[int, int]):
    """Task of step 3: spanning edges of the pairs that sketches can't rule out."""

    def run(batches):
        found: set[tuple[int, int]] = set()
        for pdf in _groups(batches, keys):
            ids, n = pdf["rep"].to_numpy(), pdf["n"].to_numpy()
            two = pdf["bi"].to_numpy() != pdf["bj"].to_numpy()
            left = pdf["block"].to_numpy() == pdf["bi"].to_numpy()
            raw = [np.frombuffer(b, np.uint64) for b in pdf["sketch"]]
            width = np.fromiter(map(len, raw), np.int64, len(raw))
            levels = {}
            for w in np.unique(width):
                at = np.flatnonzero((width == w) | (width == 2 * w))
                place = np.full(len(raw), -1)
                place[at] = np.arange(len(at))
                levels[int(w)] = (place, np.stack([_fold(raw[i], int(w)) for i in at]))
            new = np.ones(len(pdf), bool)
            new[1:] = np.logical_or.reduce([pdf[k].to_numpy()[1:] != pdf[k].to_numpy()[:-1] for k in keys])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(pdf)))
            todo, held = [], 0
            for size in np.unique(sizes):
                if 2 <= size <= 16:
                    i, j = np.triu_indices(size, 1)
                    base = starts[sizes == size][:, None]
                    todo.append(((base + i).ravel(), (base + j).ravel()))
            for start, size in zip(starts[sizes > 16], sizes[sizes > 16]):
                for i in range(start, start + size - 1):
                    j = np.arange(i + 1, start + size)
                    todo.append((np.full(len(j), i), j))
                    held += len(j)
                    if held > PAIR_ROWS:
                        _survivors(todo, ids, n, width, levels, two, left, t, found)
                        todo, held = [], 0
            _survivors(todo, ids, n, width, levels, two, left, t, found)
            if len(found) > EDGE_ROWS:
                yield pd.DataFrame(sorted(found), columns=["a", "b"])
                found = set()
        yield pd.DataFrame(sorted(found), columns=["a", "b"], dtype=np.int64)

    return run


def _survivors(todo, ids, n, width, levels, two, left, t, found) -> None:
    if not todo:
        return
    i, j = (np.concatenate(x) for x in zip(*todo))
    fit = _may_link(n[i], n[j], 0, t) & (~two[i] | (left[i] != left[j]))
    i, j = i[fit], j[fit]
    if not len(i):
        return
    w = np.minimum(width[i], width[j])
    forest, keep = {}, []
    for level in np.unique(w):
        place, rows = levels[int(level)]
        at = np.flatnonzero(w == level)
        for part in np.array_split(at, max(1, len(at) * int(level) // SKETCH_WORDS)):
            differ = np.bitwise_count(rows[place[i[part]]] ^ rows[place[j[part]]]).sum(1, dtype=np.int64)
            keep.append(part[_may_link(n[i[part]], n[j[part]], differ, t)])

    def root(x):
        while forest.get(x, x) != x:
            forest[x] = forest.get(forest[x], forest[x])
            x = forest[x]
        return x

    for a, b in zip(ids[i[np.concatenate(keep)]].tolist(), ids[j[np.concatenate(keep)]].tolist()):
        x, y = root(a), root(b)
        if x != y:
            forest[max(x, y)] = min(x, y)
            found.add((min(a, b), max(a, b)))


class PrefixTree:
    """Ordered sets as a tree of segments of ``step`` n-grams.  A node is a run
    of sets, in lexicographic order, that agree up to the end of its segment."""

    def __init__(self, sets: list[np.ndarray], step: int):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sizes = np.array([len(sets[i]) for i in self.order])
        self.vocabulary = np.unique(np.concatenate(sets))
        self.step, self.levels = step, []
        top = len(self.vocabulary)
        depth = -(-int(self.sizes.max()) // step)
        grid = np.full((len(sets), depth * step), top, np.int64)
        for row, i in enumerate(self.order):
            grid[row, :len(sets[i])] = np.searchsorted(self.vocabulary, sets[i])
        parent = np.zeros(len(sets), np.int64)
        for d in range(depth):
            part = grid[:, d * step:(d + 1) * step]
            live = self.sizes > d * step
            new = np.ones(len(sets), bool)
            new[1:] = (parent[1:] != parent[:-1]) | (part[1:] != part[:-1]).any(1) | (live[1:] != live[:-1])
            node = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            largest = np.maximum.reduceat(self.sizes, first)
            self.levels.append((parent[first], part[first], largest, live[first], node))
            parent = node
        self.leaves = parent

    def walk(self, x: np.ndarray, t: tuple[int, int]) -> np.ndarray:
        """Places in ``order`` whose sets link with ``x``."""
        num, den = t
        mark = np.zeros(len(self.vocabulary) + 1, np.int32)
        pos = np.searchsorted(self.vocabulary, x)
        ok = pos < len(self.vocabulary)
        pos, own = pos[ok], x[ok]
        mark[pos[self.vocabulary[pos] == own]] = 1
        overlap, alive = np.zeros(1, np.int64), np.ones(1, bool)
        for d, (parent, part, largest, live, _) in enumerate(self.levels):
            on = alive[parent]
            here = overlap[parent]
            look = np.flatnonzero(on & live)
            if len(look):
                here[look] += mark[part[look]].sum(1)
            # overlap can still grow by what lies below this segment, most for the largest set
            best = here + np.maximum(largest - (d + 1) * self.step, 0)
            alive = on & ((num + den) * best >= num * (len(x) + largest))
            overlap = here
            if not alive.any():
                return np.empty(0, np.int64)
        shared = overlap[self.leaves]
        return np.flatnonzero(alive[self.leaves] & ((num + den) * shared >= num * (len(x) + self.sizes)))


def _verify(keys: list[str], words: int, t: tuple[int, int]):
    """Task of step 4: spanning edges of the links inside a cluster's block or
    between two of its blocks."""

    def run(batches):
        for frame in _groups(batches, keys):
            out = []
            for _, pdf in frame.groupby(keys, sort=False):
                if len(pdf) < 2:
                    continue
                sets = [shingle_set(x, words) for x in pdf["text"]]
                ids = pdf["rep"].tolist()
                between = pdf["bi"].iloc[0] != pdf["bj"].iloc[0]
                left = (pdf["block"] == pdf["bi"]).to_numpy()
                inner = np.flatnonzero(~left) if between else np.arange(len(sets))
                probes = np.flatnonzero(left) if between else inner
                if not len(inner) or not len(probes):
                    continue
                tree = PrefixTree([sets[i] for i in inner], 16 if len(inner) > 32 else 64)
                forest = Forest(len(sets))
                for p in probes:
                    for place in tree.walk(sets[p], t):
                        forest.join(int(p), int(inner[tree.order[place]]))
                out += [(ids[i], ids[j]) for i, j in forest.edges]
            yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return run


def _blocks(rows: DataFrame, count: str, size: int) -> DataFrame:
    """Cut groups of more than ``size`` rows into blocks by a hash of the node;
    every row goes to each pair of blocks that its own block is in."""
    nb = F.ceil(F.col(count) / size).cast("int")
    cut = rows.withColumn("__nb", nb).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("__nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__nb") - 1)).alias("__o")
    cut = cut.select(*[c for c in cut.columns if c != "__nb"], other)
    return cut.withColumn("bi", F.least("block", "__o")).withColumn("bj", F.greatest("block", "__o")).drop("__o")


def _member_filter(ids: DataFrame, col: str, bits: int = 1 << 23):
    """Splits rows by a long key: ``(rows, key) -> (some, others)``.  ``some`` have
    all rows whose key is in ``ids`` and few more, so that texts outside a small
    set need not be shuffled to find that out.  The table of one bit a hash has a
    fixed size; it is looked up by joins, not in Python, where each task would
    hold another worker for it."""
    spots = ids.select(F.pmod(F.xxhash64(col), F.lit(bits)).alias("s"))
    words = spots.groupBy(F.shiftright("s", 5).alias("__w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("__m"))
    words = staged(words, "ngram-members")

    def split(rows: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        word, mask = unused(rows, "__w", "__m")
        table = F.broadcast(words.select(F.col("__w").alias(word), F.col("__m").alias(mask)))
        spot = F.pmod(F.xxhash64(key), F.lit(bits))
        on = (F.shiftright(spot, 5) == F.col(word)) & (F.col(mask).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 32).cast("int"))) != 0)
        return rows.join(table, on, "left_semi"), rows.join(table, on, "left_anti")

    return split


def _node(tokens: np.ndarray) -> int:
    return int(tokens.sum() >> np.uint64(2)) if len(tokens) else 0


def near_copy_classes(docs: DataFrame, words: int = 4, threshold: tuple[int, int] = (85, 100), hot: int = 32) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least doc_id
    reachable by links of at least ``threshold`` = numerator / denominator)."""
    return _classes(docs, words, threshold, hot).select("doc_id", "n_shingles", "component_id")


def _classes(docs: DataFrame, words: int = 4, threshold: tuple[int, int] = (85, 100), hot: int = 32) -> DataFrame:
    """``near_copy_classes`` with each document's node (rep) and its class (component; null without words)."""
    num, den = t = threshold
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def prefix(n: int) -> int:
        return n - -(-num * n // den) + 1 if n else 0

    def profile(batches):
        for batch in batches:
            for at in range(0, len(batch), PROFILE_ROWS):
                pdf, rows = batch.iloc[at:at + PROFILE_ROWS], []
                for text in pdf["text"]:
                    s = shingle_set(text, words)
                    keep = s[:max(prefix(len(s)), int(np.searchsorted(s, _CUT)))]
                    rows.append((len(s), _node(s), sketch(s).tobytes(), keep.tobytes()))
                made = pd.DataFrame(rows, columns=["n", "rep", "sketch", "tokens"])
                made.insert(0, "doc_id", pdf["doc_id"].astype("Int64").array)
                yield made

    def front(batches):
        for pdf in batches:
            got = [np.frombuffer(b, np.uint64)[:prefix(n)] for b, n in zip(pdf["tokens"], pdf["n"])]
            if got:
                every = np.concatenate(got)
                yield pd.DataFrame({"token": every[every < _CUT].view(np.int64)})

    def ordered_front(batches):
        for pdf in (b.iloc[at:at + PROFILE_ROWS] for b in batches for at in range(0, len(b), PROFILE_ROWS)):
            token, owner = [], []
            for rep, b, n in zip(pdf["rep"].tolist(), pdf["tokens"], pdf["n"].tolist()):
                s, p = np.frombuffer(b, np.uint64), prefix(n)
                at = np.searchsorted(common, s)
                late = (common[np.minimum(at, len(common) - 1)] == s) if len(common) else np.zeros(len(s), bool)
                if late[:p].any():
                    s = s[np.argsort(np.where(late, 1, np.where(s < _CUT, 0, 2)), kind="stable")]
                token.append(s[:p])
                owner.append(np.full(len(token[-1]), rep, np.int64))
            if token:
                yield pd.DataFrame({"token": np.concatenate(token).view(np.int64), "rep": np.concatenate(owner)})

    def nodes(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["doc_id"].astype("Int64"), "rep": [_node(shingle_set(x, words)) for x in pdf["text"]], "text": pdf["text"]})

    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sets = staged(every.mapInPandas(profile, "doc_id long, n long, rep long, sketch binary, tokens binary"), "ngram-sets")
    full = sets.where("n > 0")
    often = (full.select("n", "tokens").mapInPandas(front, "token long").groupBy("token").agg(F.count("*").alias("c"))
             .where(F.col("c") > hot).orderBy(F.col("c").desc(), "token").limit(HOT_TOKENS).toPandas())
    common = np.sort(often["token"].to_numpy(np.int64).view(np.uint64))

    # nodes that meet on an n-gram; copies of a text meet on all of theirs and are one node
    meets = staged(full.select("rep", "n", "tokens").mapInPandas(ordered_front, "token long, rep long"), "ngram-fronts")
    shared = meets.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    met = staged(meets.join(shared, "token").distinct(), "ngram-meets")
    counts = met.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    faces = full.groupBy("rep").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    pairs = _blocks(met.join(counts, "token"), "c", GROUP_BLOCK).join(faces, "rep")
    keys = ["token", "bi", "bj"]
    pairs = pairs.select(*keys, "block", "rep", "n", "sketch").repartition(parts, *keys).sortWithinPartitions(*keys)
    near = staged(components(pairs.mapInPandas(_meet(keys, t), "a long, b long")), "ngram-clusters")

    # one text of each node in a cluster, to the task that holds its part of the cluster
    sizes = near.groupBy("component").agg(F.count("*").alias("c"))
    cut = _blocks(near.withColumnRenamed("node", "rep").join(sizes, "component"), "c", CLUSTER_BLOCK)
    named = full.select("doc_id", "rep").join(near.select(F.col("node").alias("rep")), "rep").groupBy("rep").agg(F.min("doc_id").alias("id"))
    named = staged(named, "ngram-named")
    wanted, _ = _member_filter(named.where("id IS NOT NULL"), "id")(every.where(F.col("doc_id").isNotNull()), F.col("doc_id"))
    # an id may have several texts: each row's own node says whether it is the one
    fetched = wanted.mapInPandas(nodes, "id long, rep long, text string")
    texts = fetched.join(named.where("id IS NOT NULL"), ["id", "rep"]).select("rep", "text")
    unnamed = every.where(F.col("doc_id").isNull()).mapInPandas(nodes, "id long, rep long, text string").select("rep", "text")
    texts = texts.unionByName(unnamed.join(named.where("id IS NULL").select("rep"), "rep")).groupBy("rep").agg(F.min("text").alias("text"))
    keys = ["component", "bi", "bj"]
    work = cut.join(texts, "rep").select(*keys, "block", "rep", "text").repartition(parts, *keys).sortWithinPartitions(*keys)
    links = staged(components(work.mapInPandas(_verify(keys, words, t), "a long, b long")), "ngram-links")

    ids = sets.select("doc_id", F.col("n").alias("n_shingles"), "rep")
    classed = ids.join(links.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn(
        "component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep")))
    least = classed.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = ["doc_id", "n_shingles", "rep", "component", "component_id"]
    linked = classed.where("n_shingles > 0").join(least, "component").select(*out)
    return linked.unionByName(classed.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")).select(*out))


def drop_near_copies(docs: DataFrame, words: int = 4, **kw) -> DataFrame:
    """``docs`` with one document of each class: the one whose id names it (of
    several texts under that id the one with the least node).  A class without
    an id keeps one row; rows of no words and no id stay once a text."""
    classes = staged(_classes(docs, words, **kw), "ngram-classes")
    own, key, node = unused(docs, "__node", "__id", "__rep")

    @F.pandas_udf("long")
    def named(s: pd.Series) -> pd.Series:
        return pd.Series([_node(shingle_set(x, words)) for x in s], dtype="int64")

    kept = classes.where("n_shingles > 0 AND doc_id <=> component_id").groupBy("component", "component_id").agg(F.min("rep").alias("rep"))
    # only rows whose id is that of a dropped one need their node, or an exchange
    spoken = classes.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "rep").distinct()
    dropped = staged(spoken.join(kept.select(F.col("component_id").alias("doc_id"), "rep"), ["doc_id", "rep"], "left_anti"), "ngram-dropped")
    maybe, others = _member_filter(dropped, "doc_id")(docs.where(F.col("doc_id").isNotNull()), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
    judged = maybe.withColumn(own, named(F.coalesce("text", F.lit(""))))
    gone = dropped.select(F.col("doc_id").alias(key), F.col("rep").alias(node))
    judged = judged.join(gone, (F.col("doc_id") == F.col(key)) & (F.col(own) == F.col(node)), "left_anti").drop(own)
    out = others.unionByName(judged)
    if classes.where("doc_id IS NULL AND component_id IS NULL").isEmpty():
        return out
    unnamed = docs.where(F.col("doc_id").isNull()).withColumn(own, named(F.coalesce("text", F.lit(""))))
    once = unnamed.join(kept.where("component_id IS NULL").select(F.col("rep").alias(node)), F.col(own) == F.col(node), "left_semi").dropDuplicates([own])
    wordless = unnamed.where(F.col(own) == 0).dropDuplicates(["text"])
    return out.unionByName(once.drop(own)).unionByName(wordless.drop(own))
