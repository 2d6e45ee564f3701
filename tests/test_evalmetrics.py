"""Evaluation aggregates: hand-computed edges."""

import random
from math import comb

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import evalmetrics as EV


def _verdicts(spark, spec):
    rows = []
    for t, (n, c) in enumerate(spec):
        rows += [(t, i, i < c) for i in range(n)]
    return spark.createDataFrame(rows, "task_id long, sample_id long, passed boolean")


def test_pass_at_k_exact(spark):
    v = _verdicts(spark, [(200, 42)])
    got = {r.k: r.pass_at_k for r in EV.pass_at_k(v, [1, 10]).collect()}
    assert abs(got[1] - 0.21) < 1e-9
    assert abs(got[10] - (1 - comb(158, 10) / comb(200, 10))) < 1e-6


def test_pass_at_k_edges_and_skips(spark):
    v = _verdicts(spark, [(5, 0), (5, 5), (5, 4)])
    got = {r.k: (r.pass_at_k, r.n_tasks) for r in EV.pass_at_k(v, [1, 5, 10]).collect()}
    assert got[1] == (round((0 + 1 + 0.8) / 3, 6), 3)
    assert got[5] == (round((0 + 1 + 1) / 3, 6), 3)
    assert got[10] == (0.0, 0)  # n < k everywhere: reported as 0 with no tasks


def test_pass_at_k_monotone_in_k(spark):
    v = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("user_id").alias("task_id"), F.col("event_id").alias("sample_id"), (F.col("event_type") != "error").alias("passed"))
    got = sorted((r.k, r.pass_at_k) for r in EV.pass_at_k(v, [1, 2, 5]).collect())
    vals = [p for _, p in got]
    assert all(0 <= p <= 1 for p in vals) and vals == sorted(vals)


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_edit_distance_is_code_points(spark):
    pairs = [("é😀x", "ex"), ("", "abc"), ("kitten", "sitting"), ("über", "uber")]
    df = spark.createDataFrame(pairs, "p string, t string")
    got = EV.edit_distance(df, "p", "t").first().avg_edit_distance
    assert abs(got - sum(_lev(a, b) for a, b in pairs) / len(pairs)) < 1e-9


def test_distances_of_many_pairs_are_those_of_each(spark):
    r = random.Random(11)
    pairs = [("", ""), ("", "abc"), ("x" * 64, "y" * 64), ("é😀" * 40, "\ud800e" * 33), ("a", "b" * 900)]
    for n in (1, 5, 7, 8, 9, 63, 64, 65, 200):
        for _ in range(40):
            a = "".join(r.choice("ab é😀中") for _ in range(n))
            b = "".join(r.choice("ab é😀z") for _ in range(r.choice([n, n + 1, 2 * n, 300])))
            pairs.append(r.choice([(a, b), (b, a), (a, a), (a, a[:n // 2] + b[:3] + a[n // 2:])]))
    a, b = (list(x) for x in zip(*pairs))
    want = [EV.levenshtein_distance(x, y) for x, y in pairs]
    assert EV.levenshtein_distances(a, b) == want
    assert [_lev(x, y) for x, y in pairs[::7]] == want[::7]
    assert EV.levenshtein_distances(a, b, 5) == [min(d, 6) for d in want]
    assert EV.levenshtein_distances([], []) == []
    df = spark.createDataFrame([(None, "x"), ("y", None)], "p string, t string")
    assert tuple(EV.edit_distance(df, "p", "t").first()) == (2, None)


def test_distances_of_lines_cost_little_each():
    import time
    r = random.Random(12)
    lines = ["".join(r.choice("abcdefgh ,.") for _ in range(r.randrange(300, 500))) for _ in range(1001)]
    start = time.process_time()
    one = [EV.levenshtein_distance(x, y) for x, y in zip(lines[:200], lines[1:201])]
    each = (time.process_time() - start) * 5
    start = time.process_time()
    assert EV.levenshtein_distances(lines[:-1], lines[1:])[:200] == one
    assert time.process_time() - start < each / 2


def test_completion_match_empty_is_not_prefix(spark):
    df = spark.createDataFrame([("", "abc"), ("ab", "abc"), (" abc ", "abc")], "p string, t string")
    r = EV.completion_match(df, "p", "t").first()
    assert r.n_scored == 3 and r.prefix_match == round(1 / 3, 6) and r.exact_match == round(1 / 3, 6)


def test_confusion_zero_denominators(spark):
    df = spark.createDataFrame([(False, False), (False, False)], "t boolean, p boolean")
    r = EV.confusion(df, "t", "p").first()
    assert (r.precision, r.recall, r.f1, r.tn) == (0.0, 0.0, 0.0, 2)


def test_bleu_identical_and_disjoint(spark):
    same = spark.createDataFrame([(1, "a b c d e", "a b c d e")], "id long, p string, r string")
    assert EV.corpus_bleu(same, "id", "p", "r").first().bleu == 1.0
    none = spark.createDataFrame([(1, "x y z w", "a b c d")], "id long, p string, r string")
    assert EV.corpus_bleu(none, "id", "p", "r").first().bleu == 0.0


def test_pass_at_k_of_a_hot_task(spark):
    from tessera.operators.evalmetrics import pass_at_k_column
    got = spark.createDataFrame([(3_000_000_000, 2_999_995_000, 10), (10, 3, 2), (5, 0, 1), (5, 5, 1)], "n long, c long, k int").select(
        pass_at_k_column("n", "c", "k").alias("p")).collect()
    assert abs(got[0]["p"] - 1.0) < 1e-9 and abs(got[1]["p"] - (1 - 7 / 10 * 6 / 9)) < 1e-12
    assert got[2]["p"] == 0.0 and got[3]["p"] == 1.0
