"""Property tests: splits partition the data, dedup is idempotent, FIM
reassembles, user reject rules compose."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import dedup as D
from tessera.operators import quality as Q
from tessera.operators import sequences as S
from tessera.plans import tidy


def test_hash_split_partitions_rows(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    s = tidy.hash_split(d, "doc_id")
    dev, train = s.where("split = 'dev'"), s.where("split = 'train'")
    assert dev.count() + train.count() == d.count()
    assert dev.select("doc_id").intersect(train.select("doc_id")).count() == 0


def test_exact_dedup_idempotent_on_corpus(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text")
    once = D.exact_dedup(d, "text", "doc_id", ["lang"]).drop("content_hash")
    twice = D.exact_dedup(once, "text", "doc_id", ["lang"]).drop("content_hash")
    assert once.count() == twice.count() < d.count()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\n"), max_size=12),
                min_size=0, max_size=12))
def test_fim_reassembles_random_texts(spark, lines):
    text = "\n".join(lines)
    df = spark.createDataFrame([(1, text)], "id long, content string")
    r = S.fim_transform(df, rate=1.0).first()
    if not r.fim_applied:
        assert r.fim_text == text and len(text.split("\n")) < 3
        return
    pre = r.fim_text.split("<|fim_suffix|>")[0][len("<|fim_prefix|>"):]
    suf, mid = r.fim_text.split("<|fim_suffix|>", 1)[1].split("<|fim_middle|>", 1)
    assert "\n".join([pre, mid, suf]) == text


def test_custom_rules_and_rejects_table(spark):
    df = spark.createDataFrame([("x" * 10,), ("x" * 200 + "\n" * 6,), ("TODO " + "y" * 200 + "\n" * 6,)], "content string")
    base = Q.basic_checks(df)
    custom = Q.custom_reject_reason(base, [("has_todo", F.col("content").contains("TODO"))])
    kept, rejects = Q.split_rejects(custom)
    assert kept.count() == 1
    assert sorted(r.reject_reason for r in rejects.collect()) == ["has_todo", "too_short"]
