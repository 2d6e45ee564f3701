import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import quality_gam as Q
from tessera.llm import toxicity as X
from tests.llm.conftest import SF

LABELS = "doc_id long, quality int, toxic int"


def _corpus(spark, n=300):
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        r = random.Random(i)
        words = [f"w{r.randrange(300)}" for _ in range(60)]
        rows.append((i, ("!!! ".join(words).upper() if bad else " ".join(words)) + (" idiot moron" if i % 5 == 0 else ""), "en", "s", 0))
        labels.append((i, 0 if bad else 1, 1 if i % 5 == 0 else 0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, LABELS)


def test_gam_learns_and_scores_by_tables():
    r = np.random.default_rng(1)
    x = r.normal(size=(2000, len(Q.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction that no single feature shows
    m = Q.fit_gam(x, y)
    assert ((m.score(x) > 0.5) == (y > 0)).mean() > 0.9
    total = m.base
    for j, (e, t) in enumerate(zip(m.edges, m.tables)):
        total += t[np.searchsorted(e, x[5, j], side="right")]
    for (i, j), t in zip(m.pairs, m.pair_tables):
        a, b = (m.coarse[k][np.searchsorted(m.edges[k], x[5, k], side="right")] for k in (i, j))
        total += t[a, b]
    assert abs(1 / (1 + np.exp(-total)) - m.score(x[5:6])[0]) < 1e-12


def test_quality_separates_and_handles_odd_rows(spark, odd, none):
    docs, labels = _corpus(spark)
    model = Q.fit_quality(docs, labels.where("doc_id % 2 = 0"))
    got = Q.with_quality(docs, model).join(labels, "doc_id").where("doc_id % 2 = 1").toPandas()
    assert ((got.score >= 0.3) == (got.quality == 1)).mean() > 0.95
    scored = Q.with_quality(odd, model).toPandas()
    assert len(scored) == 10 and scored.score.between(0, 1).all()
    assert scored[scored.doc_id == 1].score.nunique() == 1
    assert Q.with_quality(none, model).count() == 0


def test_quality_without_labels_gives_base_rate(spark, odd, none):
    empty = spark.createDataFrame([(1, None, None), (None, 1, 1)], LABELS)
    for docs in (odd, none):
        model = Q.fit_quality(docs, empty)
        assert all(r.score == 0.5 for r in Q.with_quality(docs, model).collect())


def test_neighbours_equal_brute_force(spark):
    docs, labels = _corpus(spark)
    index = X.build_index(docs, labels, k=5, block_size=8, min_texts=2, min_chi2=0.0, min_phi2=0.0)
    vectors = {}
    for b, block in enumerate(index.blocks):
        for t, (at, w) in block.items():
            for i, v in zip(at, w):
                vectors.setdefault(b * 8 + int(i), {})[t] = float(v)
    for text in ["w1 w2 idiot", "w3 w3 w9 moron idiot", "nothing here", "w10 w20 w30"]:
        q = index.vector(text)
        want = sorted(((-sum(q[t] * v.get(t, 0.0) for t in q), i) for i, v in vectors.items()), key=lambda p: (round(p[0], 12), p[1]))
        want = [(-s, i) for s, i in want if s < 0][:5]
        got = index.neighbours(q)
        assert [round(s, 9) for s, _ in got] == [round(s, 9) for s, _ in want]


def test_toxicity_scores(spark, odd, none):
    docs, labels = _corpus(spark)
    index = X.build_index(docs, labels.where("doc_id % 2 = 0"))
    got = X.with_toxicity(docs, index).join(labels, "doc_id").where("doc_id % 2 = 1").select("toxic", "toxicity.*").toPandas()
    assert ((got.score >= 0.3) == (got.toxic == 1)).all()
    judged = X.with_toxicity(odd, index).select("doc_id", "toxicity.*").toPandas()
    assert len(judged) == 10 and judged.score.between(0, 1).all()
    assert X.with_toxicity(none, index).count() == 0
    blank = X.build_index(none, labels)
    assert X.with_toxicity(docs, blank).select("toxicity.score").distinct().count() == 1


def test_registered_queries(spark):
    from tessera.llm.queries import QUERIES
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_toxicity_neighbours", "op3_quality_gam"):
        got = QUERIES[name](spark, SF)
        assert got.select("doc_id").distinct().count() == got.count() == n
        assert got.where(~F.col("score").between(0, 1) | (F.col("predicted") != (F.col("score") >= 0.3).cast("int"))).count() == 0


def test_rare_toxic_words_are_evidence(spark):
    docs, labels = _corpus(spark, 600)  # 120 toxic; "zorgl" is in 2 of them, under 2 %
    rare = spark.createDataFrame([(1000 + i, f"zorgl w{i} w{i + 40} w{i + 90}", "en", "s", 0) for i in range(4)], docs.schema)
    named = spark.createDataFrame([(1000, 1, 1), (1001, 1, 1)], LABELS)
    index = X.build_index(docs.unionByName(rare), labels.unionByName(named))
    assert "zorgl" in index.terms and "w17" in index.terms
    got = X.with_toxicity(rare, index).where("doc_id > 1001").select("toxicity.*").collect()
    assert all(r.neighbours > 0 and r.evidence.split()[0].split(":")[1] == "1" and r.score >= 0.3 for r in got)


def test_driver_holds_the_terms_as_one_string(spark):
    docs, labels = _corpus(spark)
    index = X.build_index(docs, labels)
    assert index.terms.made is None  # no term became a Python object of the driver's
    assert list(index.terms) == sorted(index.terms) == index.terms.order and len(index.terms) == len(index.weight)
    assert [index.terms[t] for t in index.terms] == list(range(len(index.terms))) and "nosuchterm" not in index.terms
    empty = X.Vocabulary("", 0)
    assert not empty and list(empty) == [] and empty.get("a") is None


def test_terms_are_word_characters_of_the_lowered_text():
    r = random.Random(3)
    letters = [chr(c) for c in range(0x3000)] + list("\u03a3\u03c2\u0130\u212a\u00a0\u2003_'.:  \x1c") * 40
    texts = ["".join(r.choices(letters, k=40)) for _ in range(3000)] + [None, "", "\u039f\u03a3'\u0391 A_b-C9", "I\u0307\u0130x"]
    assert all(X.terms_of(t) == re.findall(r"\w+", (t or "").lower()) for t in texts)


def test_rough_cosines_leave_few_examples_to_compare(spark, monkeypatch):
    docs, labels = _corpus(spark, 600)
    copies = docs.where("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 5000)
    index = X.build_index(docs.unionByName(copies), labels.unionByName(copies.selectExpr("doc_id", "1 AS quality", "0 AS toxic")), k=4)
    texts = [r.text for r in docs.where("doc_id < 60").orderBy("doc_id").collect()] + ["w1 w2", "none of these", ""]
    vectors, every, seen = index.vectors(texts), np.arange(len(index.ids)), []
    exact = [index.exact(v, every) for v in vectors]
    assert max(float(np.abs(a - b).max()) for a, b in zip(index.rough(vectors), exact)) <= index.slack / 2
    look = X.ExampleIndex.exact
    monkeypatch.setattr(X.ExampleIndex, "exact", lambda self, v, some: seen.append(len(some)) or look(self, v, some))
    got = index.nearest(vectors)
    assert got == [[(float(c[i]), int(i)) for i in np.argsort(-c, kind="stable")[:4] if c[i] > 0] for c in exact]
    assert sum(seen[:60]) < 60 * 12 < 60 * len(every)  # before, all were compared in doubles


def test_terms_of_many_texts_at_a_time(spark, monkeypatch):
    docs, labels = _corpus(spark)
    texts = [r.text for r in docs.orderBy("doc_id").collect()] + ["", None]
    one = X.build_index(docs, labels)
    want = [one.counts([t]) for t in texts]
    monkeypatch.setattr(X, "TEXTS", 7)
    two = X.build_index(docs, labels)
    assert (one.weight == two.weight).all() and list(one.terms) == list(two.terms)
    for a, b in zip(want, one.counts(texts), strict=True):
        (t, n), = a
        assert (t == b[0]).all() and (n == b[1]).all()
        assert all(x < y for x, y in zip(t, t[1:]))
