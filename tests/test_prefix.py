"""Distributed prefix scan equals the window definition, incl. a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.plans.prefix import prefix_scan, row_numbers


def test_row_numbers_hot_group(spark):
    # group 0 holds half of all rows; 16 range partitions split it
    df = spark.range(0, 5000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 7).alias("g"),
                                     (F.col("id") % 13).alias("v"))
    got = row_numbers(df, ["g"], ["id"], "rn", num_partitions=16)
    w = Window.partitionBy("g").orderBy("id")
    exp = df.withColumn("rn", F.row_number().over(w))
    assert got.select("id", "rn").exceptAll(exp.select("id", "rn")).count() == 0
    assert got.count() == 5000


def test_running_sum_global_and_grouped(spark):
    df = spark.range(0, 3000).select("id", (F.col("id") % 5).alias("g"), (F.col("id") % 11 * 1.5).alias("v"))
    for groups in ([], ["g"]):
        got = prefix_scan(df, groups, ["id"], "v", "cum", num_partitions=7, integral=False)
        w = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
        exp = df.withColumn("cum", F.sum("v").over(w))
        j = got.select("id", "cum").join(exp.select("id", F.col("cum").alias("e")), "id")
        assert j.where(F.abs(F.col("cum") - F.col("e")) > 1e-6).count() == 0
        assert j.count() == 3000


def test_running_min_max(spark):
    df = spark.range(0, 4000).select("id", (F.col("id") % 3).alias("g"),
                                     (F.sin(F.col("id")) * 100).alias("v"))
    for op, fn in (("min", F.min), ("max", F.max)):
        got = prefix_scan(df, ["g"], ["id"], "v", "r", num_partitions=9, integral=False, op=op)
        w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
        exp = df.withColumn("e", fn("v").over(w))
        j = got.select("id", "r").join(exp.select("id", "e"), "id")
        assert j.where(F.abs(F.col("r") - F.col("e")) > 1e-9).count() == 0 and j.count() == 4000


def test_groups_do_not_disturb_each_other(spark):
    rows = [("a", 1, 1e17), ("b", 1, 0.1), ("b", 2, 0.2), ("c", 1, float("inf")), ("d", 1, 0.5), ("d", 2, None), (None, 1, 2.0), (None, 2, 3.0)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    got = {(r["g"], r["id"]): r["s"] for r in prefix_scan(df, ["g"], ["id"], "v", "s", num_partitions=3, integral=False).collect()}
    assert got == {("a", 1): 1e17, ("b", 1): 0.1, ("b", 2): 0.1 + 0.2, ("c", 1): float("inf"), ("d", 1): 0.5, ("d", 2): 0.5,
                   (None, 1): 2.0, (None, 2): 5.0}


def test_large_integers_stay_exact_without_exchange_reuse(spark):
    df = spark.range(0, 20000).select("id", (F.col("id") % 3).alias("g"), (F.col("id") + F.lit(2 ** 53)).alias("v"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = row_numbers(df, [], ["id"], "rn", num_partitions=8)
        assert rows.where("rn <> id + 1").count() == 0 and rows.count() == 20000
        total = prefix_scan(df.where("id < 30"), ["g"], ["id"], "v", "s", num_partitions=4)
        assert total.where("id = 27").first()["s"] == sum(i + 2 ** 53 for i in range(0, 28, 3))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
