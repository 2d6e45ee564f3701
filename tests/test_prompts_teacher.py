"""Prompt, quality and teacher operators: hand-computed edges and brute force."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import prompts as P
from tessera.operators import quality as Q
from tessera.operators import teacher as TE


def test_completion_stops_earliest(spark):
    rows = [("ab", "abx = 1\ndef f():\n#c"), ("ab", "ab y\n#c\ndef g"), ("ab", "abplain"), ("abcdef", "ab")]
    df = spark.createDataFrame(rows, "p string, o string")
    got = [r.c for r in df.select(P.extract_completion(F.col("p"), F.col("o")).alias("c")).collect()]
    assert got == ["x = 1", " y", "plain", ""]


def test_import_header(spark):
    src = "# comment\n\nimport os\nfrom x import y\nx = 1\nimport late"
    r = spark.createDataFrame([(src,), ("def f(): pass",)], "c string").select(P.import_header(F.col("c")).alias("i")).collect()
    assert r[0].i == ["import os", "from x import y"] and r[1].i == []


def test_file_summary_signatures_or_head(spark):
    sig = "import os\ndef a():\n    pass\nclass B:  \n    x = 1\n"
    long = "\n".join(f"line {i}" for i in range(60))
    r = spark.createDataFrame([(sig,), (long,)], "c string").select(P.file_summary(F.col("c")).alias("s")).collect()
    assert r[0].s == "def a():\nclass B:"
    assert r[1].s == "".join(f"line {i}\n" for i in range(50))


def test_related_files(spark):
    files = spark.createDataFrame([("p", f) for f in ["src/a.py", "src/b.py", "src/c.txt", "lib/utils.py", "lib/x.py",
                                                      "config.py", "src/helpers.py"]], "project string, path string")
    cur = spark.createDataFrame([("p", "src/a.py")], "project string, path string")
    got = [(r.cand, r.used) for r in P.related_files(files, cur).orderBy("rank").collect()]
    assert got == [("src/b.py", True), ("src/helpers.py", True), ("config.py", True), ("lib/utils.py", False)]


def test_containment_join_matches_brute_force(spark):
    b = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10_000, "short"), (10_001, "")], "item_id long, text string")
    needles = b.unionByName(extra)
    got = {r.item_id: r.match_doc_id for r in P.containment_join(needles, d, "text", "text", "item_id", "doc_id").collect()}
    docs = [(r.doc_id, r.text) for r in d.collect()]
    exp = {}
    for r in needles.collect():
        hits = [i for i, t in docs if r.text.strip() in t]
        exp[r.item_id] = min(hits) if hits else None
    assert got == exp and any(v is not None for v in exp.values())


def test_payload_normalisation_shapes(spark):
    rows = [
        ("openai", json.dumps({"choices": [{"message": {"content": "A"}}], "usage": {"total_tokens": 9, "prompt_tokens": 4, "completion_tokens": 5}})),
        ("anthropic", json.dumps({"content": [{"text": "B"}], "usage": {"input_tokens": 3, "output_tokens": 4}})),
        ("local", json.dumps({"choices": [{"message": {"content": "C"}}]})),
        ("openai", json.dumps({"choices": [], "usage": {"total_tokens": 1}})),
        ("openai", "{not json"),
        ("anthropic", "{not json"),
    ]
    out = TE.normalize_response(spark.createDataFrame(rows, "provider string, raw string")).collect()
    assert [(r.content, r.tokens_used, r.parse_error) for r in out] == [
        ("A", 9, False), ("B", 7, False), ("C", 0, False), (None, 1, True), (None, 0, True), (None, 0, True)]


def test_cost_known_unknown_local(spark):
    rows = [("openai", "gpt-4", 1000, 1000), ("openai", "mystery", 1000, 0), ("anthropic", "claude-3-haiku-20240307", 2000, 4000),
            ("local", "x", 5000, 5000), ("openai", "gpt-4", 0, 0)]
    df = spark.createDataFrame(rows, "provider string, model string, input_tokens long, output_tokens long")
    got = [round(r.cost_estimate, 9) for r in TE.estimate_cost(df).collect()]
    assert got == [0.09, 0.01, 0.0055, 0.0, 0.0]


def test_cache_key_matches_python(spark):
    import hashlib
    prompt, params = "héllo", {"temperature": 0.7, "model": "gpt-4", "max_tokens": 512}
    exp = hashlib.sha256(f"{prompt}{json.dumps(params, sort_keys=True)}".encode()).hexdigest()[:16]
    df = spark.createDataFrame([(prompt,)], "p string")
    got = df.select(TE.cache_key(F.col("p"), TE.canonical_params(F.lit("gpt-4"), F.lit(0.7), F.lit(512)))).first()[0]
    assert got == exp


def test_response_quality_edges(spark):
    code = "```\ncode\n```" + "x" * 40
    rows = [("x" * 49, "explanation"), ("x" * 50, "explanation"), ("I cannot " + "x" * 50, "explanation"),
            ("i cannot " + "x" * 50, "explanation"), ("x" * 60, "bug_fix"), (code, "bug_fix")]
    df = spark.createDataFrame(rows, "response string, category string")
    got = [r.reject_reason for r in Q.response_reject_reason(df).collect()]
    assert got == ["too_short", None, "refusal", None, "no_code", None]


def test_basic_checks_edges(spark):
    line = "a" * 19 + "\n"
    rows = [("a" * 99,), ("abcd\n" * 20,), ("a" * 100001,), ("a\nb\nc\n" + "a" * 100,),
            ((("a" * 199 + "\n") * 5)[:-1] + "a",), ("#" * 60 + "a" * 40 + "\n\n\n\n",), (line * 10,)]
    got = [r.reject_reason for r in Q.basic_checks(spark.createDataFrame(rows, "content string")).collect()]
    assert got == ["too_short", None, "too_long", "too_few_lines", None, "low_alnum", None]


def test_containment_rounds_short_needles_and_scopes(spark, monkeypatch):
    import random
    monkeypatch.setattr(P, "FIRST_CANDIDATES", 1)
    monkeypatch.setattr(P, "NEEDLE_BYTES", 60)  # several passes of short needles
    r = random.Random(7)
    common = "a passage that very many of the texts have in common, word for word. "
    texts = [(i, ["x", "y", None][i % 3], common + "".join(r.choice("abc é") for _ in range(60)) + f" tail {i % 7}") for i in range(90)]
    needles = [(1, "x", common), (2, "y", common + texts[46][2][len(common):]), (3, "x", "é"), (4, "y", "tail 5"), (5, None, "tail 6"), (6, "x", ""), (7, "x", "zzzz"),
               (8, "y", texts[70][2][30:110]), (9, "z", "tail"), (10, "x", None), (11, "x", "  tail 3 "), (12, "x", "tail 3")]
    hay = spark.createDataFrame([*texts, (500, "x", None)], "doc_id long, s string, text string")
    df = spark.createDataFrame(needles, "n long, s string, needle string")
    got = {x.n: x.match_doc_id for x in P.containment_join(df, hay, "needle", "text", "n", "doc_id", ["s"]).collect()}
    for n, s, needle in needles:
        hits = [i for i, t, text in texts if s is not None and t == s and needle is not None and needle.strip() in text]
        assert got[n] == (min(hits) if hits else None), n
