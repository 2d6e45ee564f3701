import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import collocations as C


def brute(rows, longest=4, least=30, top=2000):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    rows = []
    for (lang, g), a in cand.items():
        if any(l == lang and len(h) > len(g) and 100 * b >= 80 * a and any(h[i:i + len(g)] == g for i in range(len(h))) for (l, h), b in cand.items()):
            continue
        score, k = min((2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g)))
        rows.append((lang, -score, -a, " ".join(g), f[lang, g[:k]], f[lang, g[k:]]))
    rows.sort(key=lambda r: (r[0], r[1], r[2], r[3].encode()))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in rows:
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase, -a, l, r, n[lang], -score))
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("w1", F.lit("x")).withColumn("c", F.lit(1))
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


def sample(seed, n=150):
    rng = np.random.default_rng(seed)
    words = ["of", "The", "the", "new", "york", "é", "Éa", "x-1", "a", "b", "c", "d"]
    marks = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "\xa0"]
    rows = []
    for i in range(n):
        body = "".join(words[int(rng.zipf(1.5)) % len(words)] + marks[int(rng.integers(len(marks)))] for _ in range(int(rng.integers(0, 60))))
        rows.append((body, ["en", "de", None, "und"][i % 4]))
    return rows + [("new york city hall " * 50, "en"), (None, "en"), ("", "fr"), (" .,; ", "fr"), ("a a a a a a " * 40, "fr")]


def test_equals_brute_force(spark, monkeypatch):
    rows = sample(3, 900)
    expect = brute(rows)
    assert len(expect) > 40 and {r[0] for r in expect} == {"en", "de", "und", "fr"}
    assert run(spark, rows) == expect
    monkeypatch.setattr(C, "FLUSH", 400)  # counted in many parts and many buckets
    assert run(spark, rows, bucket=400) == expect


def test_full_slots_are_spread(spark, monkeypatch):
    rows = sample(4, 80)
    monkeypatch.setattr(C, "SLOTS", 8)  # every slot holds more than a bucket is meant for
    assert run(spark, rows, bucket=20, min_count=12, top=9) == brute(rows, least=12, top=9)


def test_other_lengths(spark):
    rows = sample(5, 60)
    assert run(spark, rows, longest=3, min_count=10, bucket=400) == brute(rows, longest=3, least=10)


def test_windows_stop_at_the_end_of_a_piece_and_of_a_text(spark):
    rows = [("a b. a b", "en"), ("a b", "en")] * 30
    got = run(spark, rows, bucket=400)
    assert got == [("en", 1, "a b", 90, 90, 90, 180, 1_000_000)]


def test_odd_tables(spark, odd, none):
    assert C.collocations(none, bucket=400).count() == 0
    rows = [tuple(r) for r in odd.select("text", "lang").collect()]
    assert sorted(tuple(r) for r in C.collocations(odd, min_count=2, bucket=400).collect()) == brute(rows, least=2)
