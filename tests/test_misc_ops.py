"""Small operators: templates, grid, specials, shuffle-for-write, filters, sampling."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.operators import bpe as B
from tessera.operators import prompts as P
from tessera.operators import quality as Q
from tessera.operators import sampling as M


def _templates(spark):
    schema = T.StructType([T.StructField("t_idx", T.LongType()), T.StructField("category", T.StringType()),
                           T.StructField("template", T.StringType()),
                           T.StructField("variables", T.MapType(T.StringType(), T.ArrayType(T.StringType())))])
    return spark.createDataFrame([(0, "c", "Use {a} with {b} and {a}", {"a": ["x", "y"], "b": ["1", "2", "3"]}),
                                  (1, "d", "Plain", {})], schema)


def test_fill_template_replaces_all_occurrences(spark):
    df = spark.createDataFrame([("Use {a} with {b} and {a}",)], "t string")
    r = df.select(P.fill_template(F.col("t"), F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit("1"))).alias("p")).first()
    assert r.p == "Use x with 1 and x"


def test_expand_grid_enumerates_product(spark):
    got = sorted(r.prompt for r in P.expand_grid(_templates(spark)).collect())
    assert len(got) == 2 * 3 + 1 and "Plain" in got and "Use y with 3 and y" in got


def test_generated_prompts_are_deterministic_and_filled(spark):
    ids = spark.range(200).withColumnRenamed("id", "id")
    a = {r.id: r.prompt for r in P.generate_prompts(ids, _templates(spark)).collect()}
    b = {r.id: r.prompt for r in P.generate_prompts(ids.repartition(7), _templates(spark)).collect()}
    assert a == b and all("{" not in p for p in a.values())
    assert len(set(a.values())) > 3


def test_special_tokens_profiles(spark):
    t = {r.token: r.id for r in B.special_token_table(spark, "trainer").collect()}
    assert t["<|pad|>"] == 0 and t["<|fim_suffix|>"] == 5
    g = B.special_token_table(spark, "guide").collect()
    assert len(g) == len(K.SPECIAL_TOKENS_GUIDE) and g[0].token == "<|endoftext|>"


def test_shuffle_for_write_keeps_rows(spark):
    df = spark.range(1000)
    out = M.shuffle_for_write(df, 4)
    assert out.rdd.getNumPartitions() == 4 and sorted(r.id for r in out.collect()) == list(range(1000))


def test_completion_filter_and_placeholder_skip(spark):
    df = spark.createDataFrame([("def f():\n    return 1\n",), ("def f(:\n  x",), ("x = 1",)], "completion string")
    assert [r.completion for r in Q.completion_filter(df).collect()] == ["def f():\n    return 1\n"]
    p = spark.createDataFrame([("Explain:\n# Code snippet here",), ("Write code",)], "prompt string")
    assert [r.prompt for r in Q.skip_placeholders(p).collect()] == ["Write code"]


def test_bernoulli_rate_and_partition_independence(spark):
    df = spark.range(20000)
    a = M.bernoulli(df, 0.3, "id")
    b = M.bernoulli(df.repartition(13), 0.3, "id")
    n = a.count()
    assert 5600 < n < 6400 and a.exceptAll(b).count() == 0


def test_license_policy(spark):
    df = spark.createDataFrame([("Released under the MIT License.",), ("licensed under the GNU General Public License v3",),
                                ("no licence here",)], "content string")
    got = [(r.license, r.license_ok) for r in Q.license_policy(df).collect()]
    assert got == [("mit", True), ("gpl", False), ("none", True)]


def test_whole_text_pairs_and_unanswered_prompts(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    q = E.queries()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").toPandas()
    want = {i: max(len(t or "") - 1, 0) for i, t in zip(docs.doc_id, docs.text)}
    assert {r["doc_id"]: r["n_pairs"] for r in q["t7_shifted_pairs_whole"](spark, SF_SMALL).collect()} == want
    users = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").where("role = 'user'").count()
    got = q["j5_exchange_zip"](spark, SF_SMALL).collect()
    assert len(got) == users and all(r["response_conv"] in (None, r["prompt_conv"]) for r in got)
