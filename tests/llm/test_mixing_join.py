import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import components as C
from tessera.llm import mixing as M
from tessera.llm import ngram_join as J
from tessera.llm.common import running_total, successors
from tests.llm.conftest import SF


def test_running_total_and_successors(spark):
    r = random.Random(1)
    rows = [(r.choice("ab"), r.choice([r.randrange(3000), r.randrange(10 ** 10), -r.randrange(5000)]), r.randrange(9)) for _ in range(800)] + [("a", None, 4)]
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)], "g string, k long, v long, i long")
    got = {x["i"]: x["t"] for x in running_total(df, ["g"], "k", "v", "t", ["i"]).collect()}
    at = {"a": 0, "b": 0}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][1] is not None, rows[i][1] or 0, i)):
        g, _, v = rows[i]
        assert got[i] == at[g]
        at[g] += v
    keys = sorted({x[1] for x in rows if x[1] is not None})
    nxt = {x["key"]: x["next"] for x in successors(df.where("k IS NOT NULL"), "k").collect()}
    assert nxt == dict(zip(keys, keys[1:] + [None]))


def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    out, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        capped = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not capped:
            return out | {s: level * weight[s] for s in free}
        for s in capped:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def test_targets_equal_resharing(spark):
    for sizes in ({"a": 1000, "b": 1, "c": 10, None: 5, "é": 0}, {"x": 7}, {"a": 5, "b": 5, "c": 5, "d": 5}, {"a": 0, None: 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in M.targets(df).collect()}
        want = _targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_permutation_is_one(spark):
    for n in (1, 2, 17, 1000):
        got = spark.range(n).select(M.permuted(F.col("id"), F.lit(n), F.lit(5)).alias("p")).toPandas().p
        assert sorted(got) == list(range(n))


def test_mix_odd_rows(spark, odd, none):
    got = M.mix(odd).toPandas()
    assert len(got) == 10 and (got.taken <= 3 * got["size"]).all() and set(got[got["size"] == 0].doc_id.dropna()) == {3, 4, 6}
    assert M.mix(none).count() == 0 and M.mixed_documents(none).count() == 0
    assert M.mixed_documents(odd).columns == odd.columns
    assert sorted(map(str, M.mix(odd).collect())) == sorted(map(str, M.mix(odd.repartition(5)).collect()))


def test_registered_mix_meets_targets(spark):
    from tessera.llm.queries import QUERIES
    got = QUERIES["op5_source_mix"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source"), "doc_id").toPandas()
    per = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), n=("source_size", "first"))
    want = _targets(per["size"].to_dict())
    assert (per["n"] == per["size"]).all() and all(abs(per.target[s] - want[s]) < 1e-6 for s in want)
    assert (abs(per.taken - per.target) <= np.maximum(100, 0.01 * per.target)).all()


def test_components_of_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 500)] + [(1000, 2000), (2000, 3000)]
    random.Random(2).shuffle(edges)
    got = {r["node"]: r["component"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(501), 0), **dict.fromkeys((1000, 2000, 3000), 1000)}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _brute(rows, words, num, den):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {x: min((r[0] for r, y in zip(rows, label) if y == x and r[0] is not None), default=None) for x in label}
    return sorted(((r[0], len(s), least[x] if s else r[0]) for r, s, x in zip(rows, sets, label)), key=str)


def _copies(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and r.random() < 0.7:
            w = r.choice(rows)[1].split()
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                w[r.randrange(len(w))] = str(r.random())
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(r.choice("abcdefghij") + str(r.randrange(40)) for _ in range(r.choice([3, 30, 80, 160])))))
    return rows


def test_classes_equal_brute_force(spark, monkeypatch):
    rows = _copies(4, 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for blocks in ((2048, 256), (8, 8)):  # small blocks also run the pairs of blocks
        monkeypatch.setattr(J, "GROUP_BLOCK", blocks[0])
        monkeypatch.setattr(J, "CLUSTER_BLOCK", blocks[1])
        got = J.near_copy_classes(df, 4, (85, 100), hot=4)
        assert sorted(map(tuple, got.collect()), key=str) == _brute(rows, 4, 85, 100)


def test_classes_with_little_held_in_a_task(spark, monkeypatch):
    rows = _copies(5, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for name, size in (("EDGE_ROWS", 3), ("SKETCH_WORDS", 16), ("PROFILE_ROWS", 7)):
        monkeypatch.setattr(J, name, size)
    assert sorted(map(tuple, J.near_copy_classes(df, 4, (85, 100), hot=4).collect()), key=str) == _brute(rows, 4, 85, 100)


def test_join_odd_rows(spark, odd, odd_rows, none):
    got = sorted(map(tuple, J.near_copy_classes(odd, 5, (80, 100)).collect()), key=str)
    assert got == _brute([(r[0], r[1]) for r in odd_rows], 5, 80, 100)
    assert J.near_copy_classes(none).count() == 0 and J.drop_near_copies(none).count() == 0
    kept = J.drop_near_copies(odd, words=5, threshold=(80, 100))
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 3, 4, 5, 6, 7}


def test_prefix_tree_walk_equals_sets():
    r = np.random.default_rng(3)
    base = np.unique(r.integers(0, 2 ** 63, 120, dtype=np.uint64))
    sets = []
    for i in range(40):
        keep = base[r.random(len(base)) < r.choice([0.5, 0.9, 0.97, 1.0])]
        sets.append(np.unique(np.append(keep, r.integers(0, 2 ** 63, r.integers(0, 9), dtype=np.uint64))))
    for step in (4, 16, 64):
        tree = J.PrefixTree(sets, step)
        for x in sets:
            got = {tree.order[p] for p in tree.walk(x, (85, 100))}
            want = {i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, x)) >= 85 * len(np.union1d(s, x))}
            assert got == want


def test_one_id_with_several_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(200)) for c in "ab")
    near = b.replace("b199", "other")
    df = spark.createDataFrame([(5, a), (5, b), (7, near), (9, a + " more")], "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in J.near_copy_classes(df).collect()}
    assert got == {(5, 197): 5, (7, 197): 5, (9, 198): 5}
    assert sorted(map(tuple, J.drop_near_copies(df).collect())) == [(5, a), (5, b)]


def test_rows_without_id_join_their_class(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(200)) for x in "abc")
    rows = [(1, a), (None, a + " more"), (None, b), (None, b), (None, b + " more"), (None, c), (None, ""), (None, ""), (3, " "), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in J.drop_near_copies(df).collect()]
    assert len(got) == 6 and {(1, a), (None, c), (None, ""), (3, " "), (4, None)} < set(got)
    assert len({t for i, t in got if i is None and t.startswith("b")}) == 1


def test_member_split_is_whole_and_needs_no_python(spark):
    ids = spark.range(0, 3000, 3).withColumnRenamed("id", "own")
    rows = spark.createDataFrame([(i, f"t{i}", i) for i in range(-50, 3050)], "doc_id long, text string, __w long").repartition(3)
    some, others = J._member_filter(ids, "own", 1 << 12)(rows, F.col("doc_id"))
    a, b = ({r.doc_id for r in x.collect()} for x in (some, others))
    assert a >= set(range(0, 3000, 3)) and not a & b and a | b == set(range(-50, 3050))
    assert len(b) > 500 and some.columns == others.columns == rows.columns
    none, every = J._member_filter(ids.where("own < 0"), "own")(rows, F.col("doc_id"))
    assert none.count() == 0 and every.count() == 3100
    assert not any(x in d._jdf.queryExecution().executedPlan().toString() for d in (some, others) for x in ("ArrowEvalPython", "NestedLoop", "SortMergeJoin"))


def test_tasks_of_the_join_hold_one_python_worker(spark):
    df = spark.createDataFrame(_copies(6, 60), "doc_id long, text string")
    plan = J.drop_near_copies(df, 4, threshold=(85, 100))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # the node of rows whose id may be a dropped one; two a task before


def test_pairs_of_a_large_group_in_parts(spark, monkeypatch):
    rows = _copies(9, 80)
    monkeypatch.setattr(J, "PAIR_ROWS", 5)
    got = J.near_copy_classes(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 4, (85, 100), hot=64)
    assert sorted(map(tuple, got.collect()), key=str) == _brute(rows, 4, 85, 100)
