import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import substrings as S


def split(text):
    return (text or "").encode().split()


def brute(docs, window=20):
    """{(doc_id, text): (n_words, removed spans, kept)}; ``docs`` in their order, equal rows once."""
    seen, out = set(), {}
    for key, text in docs:
        w = split(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            if g in seen:
                gone[i:i + window] = [True] * window
            seen.add(g)
        edges = [i for i in range(len(w) + 1) if (gone[i] if i < len(w) else False) != (gone[i - 1] if i else False)]
        out[key, text] = (len(w), list(zip(edges[::2], edges[1::2])), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("seed", "version", "repeats", "found")})
    got = S.remove_repeats(df, **kw).collect()
    return {(r.doc_id, r.text): (r.repeats.n_words, [(s.start, s.end) for s in r.repeats.spans], r.repeats.kept) for r in got}, got


def corpus(seed, n, vocabulary=400):
    """Random texts with passages, copies, near copies, periodic stretches and repeats inside a text."""
    rng = np.random.default_rng(seed)

    def words(k):
        return [f"w{int(x)}" for x in rng.integers(0, vocabulary, k)]

    passages = [words(int(rng.integers(15, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        w = words(int(rng.integers(0, 80)))
        for _ in range(int(rng.integers(0, 3))):
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = passages[int(rng.zipf(1.6)) % len(passages)]
        if rng.random() < 0.1:
            w += ["x", "y", "z"] * 15
        if rng.random() < 0.1 and w:
            w += w[:30]
        rows.append((i * 7, " ".join(w)))
        if rng.random() < 0.2:
            rows.append((i * 7 + 1, rows[-1][1]))
        if rng.random() < 0.2 and len(w) > 30:
            w = list(w)
            w[int(rng.integers(0, len(w)))] = "other"
            rows.append((i * 7 + 2, " ".join(w)))
    return rows


@pytest.mark.parametrize("shard,window", [(2000, 20), (20, 20), (30, 5)])
def test_equals_brute_force(spark, monkeypatch, shard, window):
    monkeypatch.setattr(S, "SHARD", shard)
    rows = corpus(shard + window, 90)
    expect = brute([(i, t) for i, t in rows], window)
    got, _ = run(spark, rows, window=window)
    assert got == expect
    assert sum(len(x[1]) for x in expect.values()) > 40


def test_common_passage_in_unlike_surroundings(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD", 15)  # one seed has many more passages than a shard
    rng = np.random.default_rng(9)
    common = [f"c{i}" for i in range(24)]
    rows = [(i, " ".join([f"l{int(x)}" for x in rng.integers(0, 5, 6)] + common + [f"r{int(x)}" for x in rng.integers(0, 5, 6)])) for i in range(200)]
    assert run(spark, rows)[0] == brute([(i, t) for i, t in rows])


def test_order_of_null_and_equal_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got, rows = run(spark, [(None, text), (5, text), (5, text), (7, text)])
    assert len(rows) == 4
    assert got[5, text][1] == [] and got[7, text][1] == got[None, text][1] == [(0, 30)]
    a, b = text + " a", text + " b"
    got, _ = run(spark, [(3, a), (3, b)])
    assert sorted(len(v[1]) for v in got.values()) == [0, 1]  # one version of the document comes first


def test_white_space_and_case(spark):
    words = [f"W{i}" for i in range(25)]
    rows = [(1, "\t".join(words)), (2, " \n".join(words) + "\x0b\x0c"), (3, "\xa0".join(words)), (4, " ".join(words).lower())]
    got, _ = run(spark, rows)
    assert got == brute([(i, t) for i, t in rows])
    assert got[2, rows[1][1]][2] == "" and got[4, rows[3][1]][1] == []


def test_automaton_statistics():
    rng = np.random.default_rng(1)
    for _ in range(60):
        automaton, added = S.SuffixAutomaton(), []
        for _ in range(6):
            s = rng.integers(0, 3, int(rng.integers(1, 25))).tolist()
            held = {tuple(t[i:j]) for t in added for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
            best = [max([0, *[k for k in range(1, e + 2) if tuple(s[e + 1 - k:e + 1]) in held]]) for e in range(len(s))]
            assert automaton.matches(s) == best
            automaton.add(s)
            added.append(s)


def test_equal_windows_have_equal_seeds():
    rng = np.random.default_rng(2)
    words = [b"%d" % x for x in rng.integers(0, 3, 400)]
    start, n, seed, _ = S.runs(words, 20)
    assert n.sum() == 381 and start[0] == 0 and (start[1:] == np.cumsum(n)[:-1]).all() and n.max() <= 62
    of = np.repeat(seed, n)
    seeds = {}
    for i in range(381):
        assert seeds.setdefault(tuple(words[i:i + 20]), of[i]) == of[i]


def test_odd_tables(spark, odd, none):
    assert S.remove_repeats(none).count() == 0
    got = S.remove_repeats(odd).collect()
    assert len(got) == odd.count() and {c for c in odd.columns} <= set(got[0].asDict())
    assert {(r.doc_id, r.repeats.n_removed) for r in got} == {(1, 0), (2, 20), (3, 0), (4, 0), (None, 20), (5, 0), (6, 0), (7, 0), (8, 0)}
