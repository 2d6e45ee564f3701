"""Streaming queries (R1-R8): file streams over the given tables, drained with
``availableNow``; each result must equal its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import keyed_unit, sql_unit
from tessera.plans.registry import register
from tessera.plans.reg_dedup import _first_wins_sql
from tessera.streaming import monitor as S
from tessera.streaming import splittable as X

def _event_stream(spark, sf, name):
    """A file stream over the events table itself; each run gets its own
    checkpoint and sink folder."""
    stream = S.stream_table(spark, sf, "events").withColumn("t", S.event_time("ts"))
    return stream, S.scratch(spark, name)


@register("r4_stream_tumbling_windows", """
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) + 3600 AS window_end,
       event_type, count(*) AS n_events, round(sum(value), 6) AS total, round(sum(value), 6) / 3600 AS per_second
FROM events GROUP BY ALL""")
def q_r4(spark, sf):
    stream, base = _event_stream(spark, sf, "r4")
    agg = S.windowed_metrics(stream, "t", ["event_type"], "value", "1 hour", delay="1 day")
    S.run_available_now(S.run_update_to_folders(agg, f"{base}/out"), f"{base}/ckpt")
    return S.latest_rows(spark, f"{base}/out", ["window_start", "event_type"])


@register("r4_stream_sliding_windows", """
WITH x AS (SELECT *, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS h FROM events),
y AS (SELECT h AS ws, event_type, value FROM x UNION ALL SELECT h - 3600 AS ws, event_type, value FROM x)
SELECT ws AS window_start, ws + 7200 AS window_end, event_type, count(*) AS n_events, round(sum(value), 6) AS total,
       round(sum(value), 6) / 7200 AS per_second FROM y GROUP BY ALL""")
def q_r4_sliding(spark, sf):
    stream, base = _event_stream(spark, sf, "r4s")
    agg = S.windowed_metrics(stream, "t", ["event_type"], "value", "2 hours", "1 hour", delay="1 day")
    S.run_available_now(S.run_update_to_folders(agg, f"{base}/out"), f"{base}/ckpt")
    return S.latest_rows(spark, f"{base}/out", ["window_start", "event_type"])


@register("r8_stream_sessions", """
WITH x AS (SELECT user_id, epoch_us(ts) AS us FROM events),
y AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) < 1800000000 THEN 0 ELSE 1 END AS brk FROM x),
z AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM y)
SELECT user_id, min(us) AS session_start_us, max(us) + 1800000000 AS session_end_us, count(*) AS n_events FROM z GROUP BY user_id, sid""")
def q_r8(spark, sf):
    """All sessions, those still open too."""
    stream, base = _event_stream(spark, sf, "r8")
    found = X.Sessions(base, "long", gap_us=1_800_000_000, delay_us=3_600_000_000)
    S.run_available_now(found.writer(stream.withColumn("us", S.epoch_micros("ts")), "user_id", "us"), f"{base}/ckpt")
    return found.result(spark).withColumnRenamed("user", "user_id")


_BUDGET = 3000.0


@register("r5_r6_stream_run_monitor", f"""
WITH o AS (SELECT user_id AS run_id, event_id, value, ts FROM events),
r AS (SELECT *, sum(value) OVER w AS rc, lag(value) OVER w AS prev, min(value) OVER (PARTITION BY run_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM o
      WINDOW w AS (PARTITION BY run_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT run_id, 'budget_breach' AS kind, min_by(event_id, (ts, event_id)) AS event_id, round(min_by(rc, (ts, event_id)), 6) AS value
      FROM r WHERE rc > {_BUDGET} GROUP BY run_id)
SELECT * FROM b
UNION ALL SELECT run_id, 'loss_spike', event_id, value FROM r WHERE prev IS NOT NULL AND value > 2.0 * prev
UNION ALL SELECT run_id, 'new_best', event_id, value FROM r WHERE best_before IS NULL OR value < best_before""")
def q_r5(spark, sf):
    stream, base = _event_stream(spark, sf, "r5")
    w = X.run_monitor(stream, "user_id", "t", "event_id", "value", "value", _BUDGET, f"{base}/state", f"{base}/out")
    S.run_available_now(w, f"{base}/ckpt")
    return spark.read.schema("run_id long, kind string, event_id long, value double, batch_id long").parquet(f"{base}/out").drop("batch_id")


@register("r1_r2_stream_usage_totals", """
SELECT event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY event_type""")
def q_r1(spark, sf):
    stream, base = _event_stream(spark, sf, "r1")
    stream = stream.unionByName(stream.where(keyed_unit("redeliver", "event_id") < 0.05))  # delivered twice
    w = S.usage_totals_stream(stream, "event_id", "t", ["event_type"], "value", f"{base}/out")
    S.run_available_now(w, f"{base}/ckpt")
    return S.read_usage_totals(spark, f"{base}/out", ["event_type"])


@register("r3_stream_dead_letter", f"""
SELECT 'ok' AS status, count(*) AS n FROM events
UNION ALL SELECT 'rejected', count(*) FROM events WHERE {sql_unit('corrupt', 'event_id')} < 0.02""")
def q_r3(spark, sf):
    e = S.stream_table(spark, sf, "events")
    base = S.scratch(spark, "r3")
    good = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value"))
    bad = F.when(keyed_unit("corrupt", "event_id") < 0.02, F.concat(F.lit("{\"event_id\": "), F.col("event_id").cast("string"), F.lit(", \"ts")))
    lines = e.select(F.explode(F.array_compact(F.array(good, bad))).alias("value"))
    parsed = S.parse_with_rejects(lines, e.select("event_id", "ts", "user_id", "event_type", "value").schema)

    def write_batch(batch, batch_id):
        (batch.select(F.when(F.col("_corrupt").isNull(), F.lit("ok")).otherwise(F.lit("rejected")).alias("status"))
         .groupBy("status").agg(F.count("*").alias("n"))
         .write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}"))
        batch.where(F.col("_corrupt").isNotNull()).select("_corrupt").write.mode("overwrite").parquet(f"{base}/rejects/batch_id={batch_id}")

    S.run_available_now(parsed.writeStream.foreachBatch(write_batch), f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").groupBy("status").agg(F.sum("n").alias("n"))


@register("r7_stream_near_dup", _first_wins_sql(0.85) + "SELECT doc_id, near_dup_kept AS kept FROM r")
def q_r7(spark, sf):
    """Near copies of kept earlier documents, decided online; Jaccard verified."""
    base = S.scratch(spark, "r7")
    stream = S.stream_table(spark, sf, "documents").select("doc_id", "lang", "text")
    w = X.online_near_dup(stream, "doc_id", "text", ["lang"], f"{base}/index", f"{base}/out")
    S.run_available_now(w, f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").select("doc_id", "kept")
