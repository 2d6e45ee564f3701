"""Scans, sinks and the tidy plan on authored fixture files."""

import gzip
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.plans import tidy
from tessera.sources import files as S


@pytest.fixture()
def tmp(spark):
    return tempfile.mkdtemp(prefix="tessera-test-")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_tolerant_jsonl_order_types_and_limit(spark, tmp):
    lines = [
        json.dumps({"prompt": "p1", "response": "r1"}),
        "",
        "{broken json",
        json.dumps({"prompt": 7, "response": "r2"}),
        json.dumps({"prompt": "p3"}),
        json.dumps({"prompt": "p4", "response": "r4"}),
    ]
    _write(f"{tmp}/a.jsonl", "\n".join(lines) + "\n")
    got = [r.text for r in S.tolerant_jsonl_texts(spark, f"{tmp}/a.jsonl").orderBy("file", "line_key", "field_idx").collect()]
    assert got == ["p1", "r1", "r2", "p3", "p4", "r4"]
    # limit ends between the two fields of the last line
    got5 = [r.text for r in S.tolerant_jsonl_texts(spark, f"{tmp}/a.jsonl", limit=5).orderBy("file", "line_key", "field_idx").collect()]
    assert got5 == ["p1", "r1", "r2", "p3", "p4"]


def test_field_limit_in_file_order_over_files_and_splits(spark, tmp):
    want = []
    for f in range(3):
        lines = []
        for i in range(400):
            lines.append(json.dumps({"prompt": f"p{f}-{i}", "response": f"r{f}-{i}" if i % 3 else None}) if i % 5 else "{broken")
            if i % 5:
                want += [f"p{f}-{i}"] + ([f"r{f}-{i}"] if i % 3 else [])
        _write(f"{tmp}/many/f{f}.jsonl", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # several splits a file
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert S.lines_in_order(spark, f"{tmp}/many").select("line_key.block").distinct().count() > 3
        for limit in (0, 1, 7, 533, 534, 1000, len(want), len(want) + 5):
            rows = S.tolerant_jsonl_texts(spark, f"{tmp}/many", limit=limit).orderBy("file", "line_key", "field_idx").collect()
            assert [r.text for r in rows] == want[:limit]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_strict_jsonl_fails_on_bad_line(spark, tmp):
    _write(f"{tmp}/ok.jsonl", '{"prompt": "a", "response": "b"}\n\n{"prompt": "c", "response": "d"}\n')
    assert S.strict_jsonl(spark, f"{tmp}/ok.jsonl", "prompt string, response string").count() == 2
    _write(f"{tmp}/bad.jsonl", '{"prompt": "a", "response": "b"}\n{oops\n')
    with pytest.raises(Exception):
        S.strict_jsonl(spark, f"{tmp}/bad.jsonl", "prompt string, response string").collect()


def test_json_array_and_keyed_last_wins_and_gz(spark, tmp):
    _write(f"{tmp}/arr.json", json.dumps([{"prompt": "a", "category": "x"}, {"prompt": "b", "category": "y"}]))
    assert sorted(r.prompt for r in S.json_array_document(spark, f"{tmp}/arr.json").collect()) == ["a", "b"]
    rows = [{"task_id": "T/0", "prompt": "old"}, {"task_id": "T/1", "prompt": "x"}, {"task_id": "T/0", "prompt": "new"}]
    _write(f"{tmp}/problems.jsonl", "\n".join(json.dumps(r) for r in rows) + "\n")
    df = S.keyed_last_wins(spark, [f"{tmp}/missing.jsonl", f"{tmp}/problems.jsonl"], "task_id", "task_id string, prompt string")
    assert {r.task_id: r.prompt for r in df.collect()} == {"T/0": "new", "T/1": "x"}
    with gzip.open(f"{tmp}/h.jsonl.gz", "wt", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")
    assert S.gz_jsonl(spark, f"{tmp}/h.jsonl.gz", "task_id string, prompt string").count() == 3


def _prompt_file(category, language, body, rule=True):
    head = f"Category: {category}\nLanguage: {language}\n\n"
    return head + ("=" * 60 + "\n\n" if rule else "") + body + "\n"


def test_tidy_plan_counts_parse_and_fix(spark, tmp):
    pdir, adir = f"{tmp}/prompts", f"{tmp}/answers"
    _write(f"{pdir}/explanation/001_python.txt",
           _prompt_file("explanation", "python", "Explain what this code does and how it works:\nfn main() {\n    println!(\"hi\");\n}"))
    _write(f"{pdir}/explanation/002_java.txt", _prompt_file("explanation", "java", "Explain this code:\nno code here"))
    _write(f"{pdir}/algorithm/001_go.txt", _prompt_file("algorithm", "go", "Body with ==== runs\nsecond line", rule=False))
    _write(f"{pdir}/algorithm/002_rust.txt", _prompt_file("algorithm", "rust", "unanswered"))
    _write(f"{adir}/explanation/001_python.txt", "  answer one \n")
    _write(f"{adir}/explanation/002_java.txt", "answer two")
    _write(f"{adir}/algorithm/001_go.txt", "answer three\n\n")
    ex, missing = tidy.tidy_pairs(spark, pdir, adir)
    rows = {r.rel_path: r for r in ex.collect()}
    assert set(rows) == {"explanation/001_python.txt", "explanation/002_java.txt", "algorithm/001_go.txt"}
    assert [r.rel_path for r in missing.collect()] == ["algorithm/002_rust.txt"]
    r1 = rows["explanation/001_python.txt"]
    assert (r1.language, r1.was_fixed, r1.response) == ("rust", True, "answer one")
    assert rows["explanation/002_java.txt"].was_fixed is False
    assert rows["algorithm/001_go.txt"].prompt == "Body with ==== runs\nsecond line"
    assert r1.prompt.startswith("Explain what this code does")
    # the cascade checks javascript before rust: `let mut` is labelled javascript
    from tessera.operators.prompts import detect_code_language
    probe = spark.createDataFrame([("fn main() { let mut x = 1; }",), ("import java.util.List;",)], "t string")
    assert [r.d for r in probe.select(detect_code_language(F.col("t")).alias("d")).collect()] == ["javascript", "python"]
    prompts = S.text_tree(spark, pdir)
    st = tidy.tidy_stats(prompts, ex).first()
    assert (st.total, st.valid, st.missing_answer, st.fixed) == (4, 3, 1, 1)


def test_text_tree_reads_packed_members_beside_loose_files(spark, tmp):
    _write(f"{tmp}/t/loose/a.txt", "one\ntwo")
    rows = [("deep/b.txt", " line\r\n\u2028 \"q\" \\ é😀\n"), ("deep/c.md", "other"), ("d.txt", None)]
    S.write_packed_tree(spark.createDataFrame(rows, "rel_path string, content string"), f"{tmp}/t/packs")
    got = {tuple(r) for r in S.text_tree(spark, f"{tmp}/t", packs="*.json").collect()}
    assert got == {("loose/a.txt", "one\ntwo"), ("deep/b.txt", rows[0][1]), ("d.txt", "")}
    assert [r.rel_path for r in S.text_tree(spark, f"{tmp}/t").collect()] == ["loose/a.txt"]


def test_tidy_queries_write_no_file_a_pair(spark, tmp, monkeypatch):
    from tessera.plans import reg_files
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t}") for c in range(60) for t in range(4)]
    rows.append((70, 0, "user", None))
    rows.append((70, 1, "assistant", None))
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp}/sf/conversations.parquet")
    monkeypatch.setattr(reg_files, "scratch", lambda spark, name: f"{tmp}/{name}")
    stats = reg_files.q_a3_tidy(spark, f"{tmp}/sf").first()
    assert stats.total == 121 and stats.valid + stats.missing_answer == 121 and 90 <= stats.valid < 121
    ex = reg_files.q_j1(spark, f"{tmp}/sf").collect()
    assert len({r.rel_path for r in ex}) == len(ex) == stats.valid and all(r.rel_path.startswith("key=") for r in ex)
    for name in ("j1", "a3"):
        assert len([f for _, _, fs in os.walk(f"{tmp}/{name}") for f in fs if f.startswith("part-")]) < 60


def test_head_split_sizes(spark):
    for n, dev in [(5, 5), (10, 10), (11, 10), (100, 10), (109, 10), (250, 25)]:
        df = spark.range(n).select(F.col("id").cast("string").alias("rel_path"))
        got = tidy.head_split(df).where("split = 'dev'").count()
        assert got == min(dev, n)


def test_overwrite_guard_and_prompt_names(spark, tmp):
    df = spark.createDataFrame([(1, "algorithm", "go"), (2, "algorithm", "rust"), (3, "explanation", "python")],
                               "id long, category string, language string")
    named = S.with_prompt_file_names(df)
    assert sorted(r.file_name for r in named.collect()) == ["001_go", "001_python", "002_rust"]
    S.write_prompts_by_category(named, f"{tmp}/out")
    with pytest.raises(Exception):
        S.write_prompts_by_category(named, f"{tmp}/out")
    S.write_prompts_by_category(named, f"{tmp}/out", allow_overwrite=True)
    assert spark.read.json(f"{tmp}/out").count() == 3
