"""Sequence operators: properties and hand-computed edges."""

from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import bpe as B
from tessera.operators import sequences as S


def test_fim_reassembles_with_newlines(spark):
    rows = [(i, "\n".join(f"line{j}" for j in range(n))) for i, n in enumerate([0, 1, 2, 3, 4, 10, 37])]
    df = spark.createDataFrame(rows, "id long, content string")
    out = S.fim_transform(df, rate=1.0).collect()
    for r in out:
        n = len(r.content.split("\n"))
        assert r.fim_applied == (n >= 3)
        if not r.fim_applied:
            assert r.fim_text == r.content
            continue
        assert 1 <= r.split1 <= n - 2 and r.split1 + 1 <= r.split2 <= n - 1
        pre = r.fim_text.split("<|fim_suffix|>")[0][len("<|fim_prefix|>"):]
        suf, mid = r.fim_text.split("<|fim_suffix|>")[1].split("<|fim_middle|>")
        assert "\n".join([pre, mid, suf]) == r.content


def test_fim_rate_zero_is_identity(spark):
    df = spark.createDataFrame([(1, "a\nb\nc\nd")], "id long, content string")
    assert S.fim_transform(df, rate=0.0).first().fim_text == "a\nb\nc\nd"


def test_chunk_edges(spark):
    L = 128
    lens = [0, 99, 100, L, L + 99, L + 100]
    df = spark.createDataFrame([(i, list(range(n))) for i, n in enumerate(lens)], "id long, input_ids array<int>")
    got = sorted((r.id, r.chunk_idx, len(r.input_ids)) for r in S.chunk(df, "input_ids", L, 100).collect())
    assert got == [(2, 0, 100), (3, 0, 128), (4, 0, 128), (5, 0, 128), (5, 1, 100)]


def test_pack_next_fit_conserves_tokens(spark):
    lens = [50, 50, 30, 100, 120, 10, 90, 100, 5]
    df = spark.createDataFrame([(i, [i] * n) for i, n in enumerate(lens)], "id long, input_ids array<int>")
    blocks = S.pack(df, "input_ids", "id", [], max_length=100, ids_per_group=10**9).orderBy("block").collect()
    assert [b.length for b in blocks] == [100, 30, 100, 120, 100, 100, 5]
    assert sum(b.length for b in blocks) == sum(lens)
    assert Counter(x for b in blocks for x in b.input_ids) == Counter({i: n for i, n in enumerate(lens)})


def test_label_mask(spark):
    df = spark.createDataFrame([([5, 6, 7, 8, 9], 1)], "ids array<int>, plen int")
    tp = S.truncate_pad(F.col("ids"), 8)
    r = df.select(S.masked_labels(tp["input_ids"], tp["attention_mask"], F.col("plen")).alias("l"),
                  tp["attention_mask"].alias("m")).first()
    assert r.m == [1, 1, 1, 1, 1, 0, 0, 0]
    assert r.l == [-100, -100, -100, 8, 9, -100, -100, -100]


def _python_bpe(freq, num_merges, min_frequency):
    words = {tuple(w): n for w, n in freq.items() if n >= min_frequency}
    merges = []
    for _ in range(num_merges):
        pairs = Counter()
        for w, n in words.items():
            for a, b in zip(w, w[1:]):
                pairs[(a, b)] += n
        cands = [(-c, p) for p, c in pairs.items() if c >= min_frequency]
        if not cands:
            break
        _, (a, b) = min(cands)
        merges.append((a, b))
        new = {}
        for w, n in words.items():
            out, i = [], 0
            while i < len(w):
                if i < len(w) - 1 and w[i] == a and w[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            new[tuple(out)] = new.get(tuple(out), 0) + n
        words = new
    return merges


def test_bpe_matches_python_reference(spark):
    corpus = ["low lower lowest", "newer wider low low", "aaa aaaa", "ééé é", "lowlow"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "id long, text string")
    freq = B.piece_frequencies(df)
    f = {r.piece: r.n for r in freq.collect()}
    model, table = B.learn_merges(freq, num_merges=12, min_frequency=1)
    assert model.merges == _python_bpe(f, 12, 1)
    enc = {r.id: r.input_ids for r in B.encode(df, model).collect()}
    vocab = model.vocab()
    inv = {v: k for k, v in vocab.items()}
    for i, t in enumerate(corpus):
        assert "".join(inv[x] for x in enc[i]) == t


def test_bpe_encode_keeps_every_document_and_knows_every_character(spark):
    from tessera.operators import bpe as B
    docs = spark.createDataFrame([(1, "abab"), (2, ""), (3, None), (4, "xyz")], "id long, text string")
    model, _ = B.learn_merges(B.piece_frequencies(docs), 2)
    got = {r["id"]: r["input_ids"] for r in B.encode(docs, model).collect()}
    assert got.keys() == {1, 2, 3, 4} and got[2] == got[3] == [] and len(model.vocab()) not in got[4]


def test_unrelated_rows_do_not_change_blocks(spark):
    few = spark.range(100).select(F.col("id"), F.transform(F.sequence(F.lit(1), F.lit(7)), lambda x: x.cast("int")).alias("ids"))
    many = spark.range(1000).select(F.col("id"), F.transform(F.sequence(F.lit(1), F.lit(7)), lambda x: x.cast("int")).alias("ids"))
    blocks = [{(r["pack_group"], r["block"]): r["length"] for r in S.pack(d, "ids", "id", [], max_length=50, ids_per_group=50).collect()} for d in (few, many)]
    assert blocks[0].items() <= blocks[1].items()


def test_encode_is_piecewise_over_batches(spark):
    """Ids of a document are those of its pieces, whatever else is in its batch; a batch stays in Arrow columns."""
    from tessera.operators import bpe
    texts = ["aa ab abab", None, "", "zq ab", "é日 aab", " ", "ab"]
    model = bpe.BpeModel(alphabet=sorted(set("abz q")), merges=[("a", "b"), (" ", "ab")])
    got = {r.id: r.input_ids for r in bpe.encode(spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1), model).collect()}
    v, unk = model.vocab(), len(model.vocab())
    assert got[0] == [v["a"], v["a"], v[" ab"], v[" ab"], v["ab"]] and got[1] == got[2] == []
    assert got[3] == [v["z"], v["q"], v[" ab"]] and got[4] == [unk, unk, v[" "], v["a"], v["ab"]] and got[5] == [v[" "]] and got[6] == [v["ab"]]


def test_documents_ids_are_put_together_without_python_lists():
    import numpy as np
    import pyarrow as pa
    from tessera.operators import bpe
    docs = pa.array([["x", "y"], [], ["y"], None, ["z", "x"]], pa.list_(pa.string())).slice(1)
    coded = docs.flatten().dictionary_encode()
    ids = [np.array({"x": [1], "y": [2, 3], "z": []}[p], "int32") for p in coded.dictionary.to_pylist()]
    assert bpe._ids_of_documents(docs.fill_null([]), coded.indices.to_numpy(), ids).to_pylist() == [[], [2, 3], [], [1]]


def test_many_merges_a_job_equal_one_at_a_time(spark):
    """The driver's last merges, batches of stretches and merges of ties give the same model."""
    import random
    rng = random.Random(3)
    freq = {"aaaaaaa": 9, "xaaaa": 7, "a": 5, "rare": 1}
    while len(freq) < 80:
        freq["".join(rng.choice("abcé😀") for _ in range(rng.randint(1, 8)))] = rng.choice([2, 2, 3, 40])
    table = spark.createDataFrame(list(freq.items()), "piece string, n long")
    expect = _python_bpe({p: n for p, n in freq.items() if n >= 2}, 60, 2)
    for limits in ({}, {"held": 0, "batch": 16}, {"held": 0, "batch": 1, "sample": 3}):
        model, got = B.learn_merges(table, 60, 2, **limits)
        assert model.merges == expect and got.count() == len(expect)


def test_t3_encodes_with_a_whole_vocabulary(spark, tmp_path):
    """Long words become one id; with eight merges they did not."""
    from tessera.plans import reg_sequences as R
    text = " internationalisation of distillation" * 3
    spark.createDataFrame([(1, "en", text), (2, "en", ""), (3, "en", None)], "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.id: r.n_tokens for r in R.q_t3(spark, str(tmp_path)).collect()}
    assert got == {1: 9, 2: 0, 3: 0}
