from collections import Counter

import numpy as np
import pytest

from tessera.operators import bytebpe as B


def sequential(freq, vocab_size, least=2, specials=6):
    """One merge after another, recounting: highest count, then least pair."""
    at = {b: specials + i for i, b in enumerate(B.byte_order())}
    words = [([at[x] for x in p.encode()], n) for p, n in freq.items()]
    merges, counts = [], []
    while specials + 256 + len(merges) < vocab_size:
        pairs = Counter()
        for w, n in words:
            for p in zip(w, w[1:]):
                pairs[p] += n
        if not pairs:
            break
        (a, b), c = min(pairs.items(), key=lambda x: (-x[1], x[0]))
        if c < least:
            break
        new = specials + 256 + len(merges)
        merges.append((a, b))
        counts.append(c)
        out = []
        for w, n in words:
            if len(w) > 1 and any(p == (a, b) for p in zip(w, w[1:])):
                m, i = [], 0
                while i < len(w):
                    if w[i:i + 2] == [a, b]:
                        m.append(new)
                        i += 2
                    else:
                        m.append(w[i])
                        i += 1
                w = m
            out.append((w, n))
        words = out
    return merges, counts


def pieces(seed, n):
    rng = np.random.default_rng(seed)
    stems = ["".join(chr(97 + int(x)) for x in rng.zipf(1.5, int(rng.integers(1, 5))) % 26) for _ in range(n // 4)] + ["é", "日本", "aaaa", "abab"]
    out = Counter()
    for _ in range(n):
        out[" " * int(rng.integers(0, 2)) + "".join(stems[int(rng.zipf(1.3)) % len(stems)] for _ in range(int(rng.integers(1, 5))))] += int(rng.zipf(1.6)) % 500 + 1
    return dict(out)


def table(spark, freq):
    return spark.createDataFrame(list(freq.items()), "piece string, n long")


@pytest.mark.parametrize("sample", [100_000, 60, 1])
def test_batches_equal_the_sequential_order(spark, sample):
    freq, stats = pieces(1, 700), {}
    merges, counts = sequential(freq, 400)
    got = B.learn(table(spark, freq), 400, sample=sample, batch=64, stats=stats)
    assert got.merges == merges and got.counts == counts and len(merges) == 138
    if sample == 100_000:  # a forecast on all pieces always holds
        assert stats["jobs"] == 3


def test_two_thousand_merges(spark):
    freq, stats = pieces(2, 3000), {}
    merges, counts = sequential(freq, 2262)
    got = B.learn(table(spark, freq), 2262, sample=1500, stats=stats)
    assert got.merges == merges and got.counts == counts and len(merges) == 2000


def test_stops_at_min_frequency(spark):
    freq = {"ab": 5, "abc": 1, "xy": 1}
    got = B.learn(table(spark, freq), 1000, min_frequency=2)
    assert got.merges == sequential(freq, 1000)[0] and len(got.merges) == 1
    assert B.learn(table(spark, {}), 1000).merges == []


def test_alphabet_and_specials():
    model = B.ByteBpe()
    names = model.vocabulary()
    assert names[0] == b"<|pad|>" and len(names) == 262 and sorted(names[6:]) == [bytes([i]) for i in range(256)]
    assert names[6] == b"!" and names[model.symbols(b" ")[0]] == b" "


def test_pieces_and_round_trip(spark):
    texts = ["Hello  world's  end\n\n x", " lead", "", None, "tab\tand nbsp", "a<|eos|>b <|pad|><|pad|>", "日本語 é 123abc!?", "it's we'll", "   "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.p for r in df.select("id", B.byte_pieces("text").alias("p")).collect()}
    assert got[0] == [" Hello", " ", " world", "'s", " ", " end", "\n\n", " x"]
    assert got[1] == [" lead"] and got[2] == [] and got[3] is None and got[8] == ["   "]
    assert got[7] == [" it", "'s", " we", "'ll"]
    model = B.learn(B.piece_frequencies(df), 300, min_frequency=1)
    out = {r.id: r for r in B.decode(B.encode(df, model), model).collect()}
    for i, t in enumerate(texts):
        if t is None or i == 5:
            continue
        assert out[i].decoded == (t if t[:1].isspace() or not t else " " + t)
    assert out[3].input_ids == [] and out[3].decoded == ""
    eos, pad = model.specials.index("<|eos|>"), model.specials.index("<|pad|>")
    assert [x for x in out[5].input_ids if x < 6] == [eos, pad, pad]
    assert out[5].decoded == " a<|eos|> b <|pad|><|pad|>"


def test_encoding_is_the_merge_order(spark):
    freq = pieces(3, 300)
    model = B.learn(table(spark, freq), 330)
    df = spark.createDataFrame([(1, "aaaa abab zzz")], "id int, text string")
    ids = B.encode(df, model).first().input_ids
    expect = []
    for p in [" aaaa", " abab", " zzz"]:
        word = model.symbols(p.encode())
        for i, (a, b) in enumerate(model.merges):
            word = B._merge(word, a, b, model.base + i)
        expect += word
    assert ids == expect


def test_few_jobs_where_words_outnumber_the_sample(spark):
    freq, stats = pieces(2, 3000), {}
    got = B.learn(table(spark, freq), 562, sample=1000, stats=stats)
    assert (got.merges, got.counts) == sequential(freq, 562)
    assert stats["jobs"] <= 20


def test_words_are_merged_together():
    words = [[1, 1, 1], [1, 1, 1, 1], [2, 1, 1, 2], [3], [1, 2, 1, 2, 1], [1, 1]]
    merges = [(1, 1), (1, 2), (10, 10), (11, 11)]
    sym, word = np.concatenate(words), np.repeat(np.arange(len(words)), [len(w) for w in words])
    got = B._apply(sym.astype("int64"), word, B._ranked(merges), 10)
    expect = []
    for w in words:
        for i, (a, b) in enumerate(merges):
            w = B._merge(w, a, b, 10 + i)
        expect.append(w)
    assert [got[0][got[1] == i].tolist() for i in range(len(words))] == expect
