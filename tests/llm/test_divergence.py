import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import divergence as V

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=3, scale=1_000_000_000, top=200):
    docs = [((lang or ""), (source or ""), [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(text or "")])
            for text, lang, source in rows]
    out = []
    for lang in {x[0] for x in docs}:
        here = [x for x in docs if x[0] == lang]
        df = Counter(t for _, _, ws in here for t in set(ws))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for _, s, ws in here:
            counts[s].update(w for w in ws if df[w] >= min_docs)
        whole = sum(counts.values(), Counter())

        def p(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + scale * (c[t] + 1) // n for t in kept}

        of = {s: p(c) for s, c in counts.items()}
        q = p(whole)
        for s in of:
            pairs = [(sum((of[s][t] - of[o][t]) ** 2 // of[o][t] for t in kept), o) for o in of if o != s]
            pairs.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", o, v, i + 1) for i, (v, o) in enumerate(pairs)]
            terms = [((of[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] > 0 and of[s][t] > q[t]]
            terms.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", t, v, i + 1) for i, (v, t) in enumerate(terms[:top])]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("value", F.lit("x")).withColumn("c", F.lit(1))
    return sorted(tuple(r) for r in V.source_divergence(df, **kw).collect())


def random_rows(n, seed, sources=5):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Éa", "éa", "x1y", "ZZ"]
    out = []
    for i in range(n):
        k = int(rng.integers(0, 40))
        text = " ".join(words[int(j)] for j in (rng.zipf(1.4, k) % len(words)))
        out.append((text, ["en", "de", None][i % 3], [None, "a", "b", "c", "d", "e", "f", "g"][int(rng.integers(sources))]))
    return out


def test_equals_brute_force(spark, monkeypatch):
    rows = random_rows(240, 1) + [(None, "en", "a"), ("", "xx", "a"), ("", "xx", "b"), ("same same", "yy", "q")] + [("same Same", "yy", None)] * 3
    expect = brute(rows)
    assert run(spark, rows) == expect
    assert any(r[0] == "xx" and r[4] == 0 for r in expect)


def test_subtrees_and_blocks_change_nothing(spark, monkeypatch):
    rows = random_rows(200, 2, sources=8)
    expect = brute(rows, top=7)
    monkeypatch.setattr(V, "LEAVES", 8)
    monkeypatch.setattr(V, "SOURCE_BLOCK", 2)
    monkeypatch.setattr(V, "FLUSH", 50)
    assert run(spark, rows, top=7) == expect


def test_equal_subtrees_are_one_node():
    leaves = np.zeros((3, 1024), np.int64)
    leaves[1, 5] = leaves[2, 5] = 7
    trees = V.ConsedTrees(leaves)
    assert trees.roots[1] == trees.roots[2] != trees.roots[0]
    assert sum(len(x) for x, _ in trees.levels) == 20  # an all-zero node and a node over the 7 at each height
    priced = []

    def leaf(x, y):
        priced.append(len(x))
        return (x + 10 * y + 1, x)

    assert trees.price(1, 0, leaf) == (1024 + 7, 7)
    assert priced == [2]  # the pairs (0, 0) and (7, 0), once each


def test_large_counts_stay_exact():
    c = np.array([0, 10 ** 10, 3 * 10 ** 10], np.int64)
    assert V._share(c, 4 * 10 ** 10, 10 ** 9).tolist() == [1 + 10 ** 9 * (int(x) + 1) // (4 * 10 ** 10) for x in c]


def test_odd_tables(spark, odd, none):
    assert V.source_divergence(none).count() == 0
    rows = [tuple(r) for r in odd.select("text", "lang", "source").collect()]
    assert sorted(tuple(r) for r in V.source_divergence(odd).collect()) == brute(rows)
