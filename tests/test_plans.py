"""Physical-plan guards: no cross products, pruned scans, pushed filters."""

import pytest

from conftest import SF_SMALL

GUARDED = ["a16_corpus_report", "d1_exact_dedup", "d2_minhash_signature", "a11_corpus_bleu", "j8_benchmark_containment",
           "p23_chat_prompts", "w8_loss_spikes", "a7_task_accuracy", "p9_route_answers", "m6_mixture", "s4_keyed_last_wins",
           "p27_cost_estimate", "w9_running_cost", "j11_target_mix", "f14_prefilter_requests"]


def _plan(spark, name):
    import __spark_entry__ as E
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", GUARDED)
def test_no_cross_products(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_scan_is_pruned(spark):
    plan = _plan(spark, "a16_corpus_report")
    assert "ReadSchema: struct<text:string,lang:string>" in plan


def test_filters_reach_the_scan(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(spark, "s6_filtered_source")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l][0]
    pushed = scan.split("PushedFilters: ")[1]
    assert "LessThan(n_chars,2000)" in pushed and "StringEndsWith(source,1)" in pushed
