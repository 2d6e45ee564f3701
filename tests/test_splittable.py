"""Split monitors: equal to one pass over each key, whatever the batches and tasks."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import neardup as N
from tessera.plans.prefix import scans
from tessera.streaming import monitor as S
from tessera.streaming import splittable as X


def test_scans_equal_windows(spark):
    n = 6000
    df = spark.range(0, n).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 1, None).otherwise(F.col("id") % 5).alias("g"),
                                  F.when(F.col("id") % 4 != 0, (F.xxhash64("id") % 1000)).alias("v"), (F.col("id") * 0.5).alias("x"))
    got = scans(df, ["g"], ["id"], {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "x"), "prev": ("last", "v")}, num_partitions=13)
    w = Window.partitionBy("g").orderBy("id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumns({"s": F.coalesce(F.sum("v").over(w), F.lit(0)), "lo": F.min("v").over(before), "hi": F.max("x").over(before),
                          "prev": F.last("v", ignorenulls=True).over(before)})
    assert got.columns == exp.columns
    assert got.exceptAll(exp.select(got.columns)).count() == 0 and got.count() == n


def test_scans_with_small_arrow_batches_and_few_rows(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        test_scans_equal_windows(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
        one = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None), (2, 1, None)], "g int, i int, v long")
        rows = {(r.g, r.i): (r.p, r.m) for r in scans(one, ["g"], ["i"], {"p": ("last", "v"), "m": ("min", "v")}, 2).collect()}
        assert rows == {(1, 1): (None, None), (1, 2): (None, None), (1, 3): (5, 5), (2, 1): (None, None)}
        assert scans(one.limit(0), ["g"], ["i"], {"p": ("last", "v")}, 2).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def alerts(events, budget, factor):
    """events: (run, t, id, cost, loss) in any order -> alert rows, one event at a time."""
    out, state = [], {}
    for run, t, eid, cost, loss in sorted(events):
        c, prev, best, breached = state.get(run, (0.0, None, None, False))
        c += cost or 0.0
        if c > budget and not breached:
            breached = True
            out.append((run, "budget_breach", eid, round(c, 6)))
        if loss is not None:
            if prev is not None and loss > factor * prev:
                out.append((run, "loss_spike", eid, loss))
            if best is None or loss < best:
                best = loss
                out.append((run, "new_best", eid, loss))
            prev = loss
        state[run] = (c, prev, best, breached)
    return sorted(out)


def test_hot_run_over_batches(spark):
    rng = np.random.default_rng(5)
    events = [(int(r), int(t), i, float(rng.integers(-3, 9)), None if rng.random() < 0.1 else float(rng.integers(1, 60)))
              for i, (r, t) in enumerate(zip(rng.choice([1, 1, 1, 2, 3, 4], 900), np.sort(rng.integers(0, 5000, 900))))]
    schema = "run long, t long, id long, cost double, loss double"
    base = S.scratch(spark, "t-split-r5")
    for k in range(4):
        spark.createDataFrame(events[k * 225:(k + 1) * 225], schema).coalesce(1).write.parquet(f"{base}/in/seq={k}")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        S.run_available_now(X.run_monitor(stream, "run", "t", "id", "cost", "loss", 300.0, f"{base}/state", f"{base}/out"), f"{base}/ckpt")

    run()
    spark.createDataFrame([(1, 6000, 900, 1.0, 0.5), (9, 6000, 901, 400.0, 7.0)], schema).coalesce(1).write.parquet(f"{base}/in/seq=4")
    run()  # restarted: state comes from the snapshots
    out = spark.read.parquet(f"{base}/out")
    got = sorted((r.run_id, r.kind, r.event_id, r.value) for r in out.collect())
    assert got == alerts([*events, (1, 6000, 900, 1.0, 0.5), (9, 6000, 901, 400.0, 7.0)], 300.0, 2.0)
    assert len(X._folders(spark, f"{base}/state", "b=")) == 2  # earlier snapshots are removed


def test_hot_run_is_split_over_tasks(spark):
    rows = spark.range(0, 30000).select(F.lit(1).alias("run"), F.col("id").alias("t"), F.lit(1.0).alias("v"))
    ranged = rows.repartitionByRange(8, "run", "t").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(ranged) == 8 and max(r["count"] for r in ranged) < 8000
    assert scans(rows, ["run"], ["t"], {"s": ("sum", "v")}, 8).where("s <> t + 1").count() == 0


def sessions(events, gap):
    out = []
    for user, t in sorted(events):
        if out and out[-1][0] == user and t - out[-1][2] < gap:
            out[-1][2] = t
            out[-1][3] += 1
        else:
            out.append([user, t, t, 1])
    return sorted((u, a, b + gap, n) for u, a, b, n in out)


def test_sessions_open_and_closed_over_batches(spark):
    rng = np.random.default_rng(6)
    gap, delay = 100, 1000
    times = np.sort(rng.integers(0, 20000, 600))
    jitter = rng.integers(0, 400, 600)  # out of order, but never late
    events = [(int(u), int(max(t - j, 0))) for u, t, j in zip(rng.choice([1, 1, 1, 2, 3], 600), times, jitter)]
    base = S.scratch(spark, "t-split-r8")
    for k in range(5):
        spark.createDataFrame(events[k * 120:(k + 1) * 120], "u long, t long").coalesce(1).write.parquet(f"{base}/in/seq={k}")
    stream = spark.readStream.schema("u long, t long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    found = X.Sessions(base, "long", gap, delay)
    S.run_available_now(found.writer(stream, "u", "t"), f"{base}/ckpt")
    got = sorted(tuple(r) for r in found.result(spark).collect())
    assert got == sessions(events, gap)
    still = found.open.latest(spark).count()
    assert 0 < still < len(got)


def test_late_events_are_dropped(spark):
    base = S.scratch(spark, "t-split-late")
    for k, rows in enumerate([[(1, 5000), (1, 5010)], [(1, 3000), (2, 4950)]]):
        spark.createDataFrame(rows, "u long, t long").coalesce(1).write.parquet(f"{base}/in/seq={k}")
    stream = spark.readStream.schema("u long, t long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    found = X.Sessions(base, "long", 100, 500)
    S.run_available_now(found.writer(stream, "u", "t"), f"{base}/ckpt")
    assert sorted(tuple(r) for r in found.result(spark).collect()) == [(1, 5000, 5110, 2), (2, 4950, 5050, 1)]


def test_online_near_dup_equals_batch(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text")
    base = S.scratch(spark, "t-split-r7")
    S.stage_files(d.withColumn("us", F.col("doc_id")), "us", 5, f"{base}/in")
    stream = spark.readStream.schema(d.schema.add("us", "long")).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    w = X.online_near_dup(stream, "doc_id", "text", ["lang"], f"{base}/index", f"{base}/out", compact_every=2)
    S.run_available_now(w, f"{base}/ckpt")
    got = {r.doc_id: r.kept for r in spark.read.parquet(f"{base}/out").collect()}
    exp = {r.doc_id: r.near_dup_kept for r in N.near_dup(d, "text", "doc_id", ["lang"]).collect()}
    assert got == exp and not all(exp.values())
    assert len(X._folders(spark, f"{base}/index/bands", "upto=")) == 1
    assert len(X._folders(spark, f"{base}/index/bands", "b=")) <= 2


def test_index_reads_only_the_slots_of_a_batch(spark):
    path = S.scratch(spark, "t-index")
    index = X.AppendIndex(path, "v long", every=3)
    for b in range(6):
        index.append(spark.range(0, 40).select(F.col("id").alias("v"), (F.col("id") % 4).cast("int").alias("slot")), b)
    some = index.before(spark, 4, [2])
    assert {r.v % 4 for r in some.collect()} == {2} and some.count() == 40
    assert index.before(spark, 6).count() == 240
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert all("slot" in scan.split("]")[0] for scan in plan.split("PartitionFilters: [")[1:])
