"""Structured Streaming run monitors.

The reference only iterates files and appends to logs; these are the
streaming forms, each runnable with ``trigger(availableNow=True)`` so that a
bounded input produces exactly the batch result:

* R1/R2  usage totals over a re-delivering response log: watermark +
         ``dropDuplicatesWithinWatermark`` on the request id; ``foreachBatch``
         writes each micro-batch to its own ``batch_id`` folder with overwrite,
         so a replayed batch after a restart is idempotent.
* R3     dead-letter: malformed JSON lines go to a rejects sink, never lost.
* R4     tumbling / sliding event-time windows with a watermark.
* R5/R6  per-run stateful monitor (``applyInPandasWithState``): running cost
         with a one-time budget alert, loss spikes vs the previous value,
         best-so-far — state is O(1) per run.
* R7     online near-duplicate check: each micro-batch is joined on band
         buckets with the growing index of *kept* documents, resolved within
         the batch with the same first-wins rule, and the kept bands appended.
* R8     session windows per user; rows later than the watermark are dropped.

Checkpoints and sinks live under the shared checkpoint folder
(``spark.checkpoint.dir``), never on a machine-local path.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir

EPOCH_NTZ = "1970-01-01 00:00:00"


def event_time(ts_ntz) -> Column:
    """TIMESTAMP for a TIMESTAMP_NTZ column, read as UTC wall-clock time
    (independent of the session time zone; watermarks need TIMESTAMP)."""
    c = F.col(ts_ntz) if isinstance(ts_ntz, str) else ts_ntz
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), c)
    return F.timestamp_micros(micros)


def epoch_micros(ts_ntz) -> Column:
    c = F.col(ts_ntz) if isinstance(ts_ntz, str) else ts_ntz
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), c)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, asked of the file system that holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A file stream over ``<folder>/<name>.parquet``, a folder of files or one file."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    one = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder) if one else reader.parquet(path)


def stage_files(df: DataFrame, order_micros: str, n_files: int, base: str, fmt: str = "parquet",
                redeliver: DataFrame | None = None) -> str:
    """Write ``df`` as ``n_files`` single-file folders in ascending
    ``order_micros`` ranges, one after another, so a file source replays
    them in time order (it orders files by modification time).  This
    replays a bounded table as a stream (tests, driver queries); production
    input arrives from the log that produces it.  Rows of
    ``redeliver`` (same schema) are written again right after the *next*
    range: a duplicate delivery that crosses a micro-batch boundary."""
    lo, hi = df.agg(F.min(order_micros), F.max(order_micros)).first()
    width = max(1, (hi - lo) // n_files + 1) if lo is not None else 1

    def part(frame):
        return frame.withColumn("_part", F.floor((F.col(order_micros) - F.lit(lo or 0)) / F.lit(width)).cast("int"))

    staged = part(df)
    again = part(redeliver) if redeliver is not None else None
    seq = 0
    for i in range(n_files):
        for frame, src in ((staged, i), (again, i - 1)):
            if frame is None or src < 0:
                continue
            # one time-sorted file per range: the source replays files by
            # modification time, so parallel part files would reorder rows
            out = frame.where(F.col("_part") == src).drop("_part").coalesce(1).sortWithinPartitions(order_micros)
            target = f"{base}/seq={seq:05d}"
            (out.write.mode("overwrite").parquet(target) if fmt == "parquet" else out.write.mode("overwrite").text(target))
            seq += 1
    return base


def run_update_to_folders(agg: DataFrame, sink: str):
    """Update-mode aggregate -> each micro-batch's changed rows in
    ``sink/batch_id=N`` (overwrite, idempotent on replay)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
    return agg.writeStream.outputMode("update").foreachBatch(write_batch)


def latest_rows(spark: SparkSession, sink: str, keys) -> DataFrame:
    """Final state of an update-mode sink: per key, the row of the latest batch."""
    rows = spark.read.parquet(sink)
    cols = [c for c in rows.columns if c != "batch_id"]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in cols if c not in keys]), "batch_id").alias("r"))
    return best.select(*keys, "r.*")


def run_available_now(writer, checkpoint: str):
    """Start a prepared ``DataStreamWriter``, drain all input, stop."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()
    return q


# --- R4 ----------------------------------------------------------------------------

def windowed_metrics(stream: DataFrame, time_col: str, group_cols, value_col: str, window: str,
                     slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Event-time windows (tumbling, or sliding when ``slide``) with counts,
    sums and a per-second rate; ``window_start``/``window_end`` as epoch seconds."""
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    agg = (stream.withWatermark(time_col, delay).groupBy(w.alias("w"), *group_cols)
           .agg(F.count("*").alias("n_events"), F.sum(value_col).alias("total")))
    secs = F.unix_seconds(F.col("w.end")) - F.unix_seconds(F.col("w.start"))
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"),
                      F.unix_seconds(F.col("w.end")).alias("window_end"), *group_cols, "n_events",
                      F.round("total", 6).alias("total"), (F.round("total", 6) / secs).alias("per_second"))


# --- R8 ----------------------------------------------------------------------------

def sessions(stream: DataFrame, time_col: str, user_col: str, gap: str, delay: str = "1 hour") -> DataFrame:
    """Session windows per user (append mode: a session is emitted once the
    watermark passes its end; with ``availableNow`` the sessions still open
    within ``delay`` of the last event stay in state for the next run)."""
    s = (stream.withWatermark(time_col, delay).groupBy(F.session_window(time_col, gap).alias("s"), user_col)
         .agg(F.count("*").alias("n_events")))
    return s.select(user_col, F.unix_micros(F.col("s.start")).alias("session_start_us"),
                    F.unix_micros(F.col("s.end")).alias("session_end_us"), "n_events")


# --- R5 / R6 -------------------------------------------------------------------------

ALERT_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
STATE_SCHEMA = T.StructType([
    T.StructField("running_cost", T.DoubleType()), T.StructField("prev_loss", T.DoubleType()),
    T.StructField("best", T.DoubleType()), T.StructField("breached", T.BooleanType())])


def _monitor_fn(budget: float, spike_factor: float):
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        run_id = int(key[0])
        if state.exists:
            cost, prev, best, breached = state.get
        else:
            cost, prev, best, breached = 0.0, None, None, False
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["t", "event_id"], kind="stable")
        out = []
        for eid, c, loss in zip(pdf["event_id"].to_numpy(), pdf["cost"].to_numpy(), pdf["loss"].to_numpy()):
            cost += float(c)
            if not breached and cost > budget:
                breached = True
                out.append((run_id, "budget_breach", int(eid), round(cost, 6)))
            if prev is not None and loss > spike_factor * prev:
                out.append((run_id, "loss_spike", int(eid), float(loss)))
            if best is None or loss < best:
                best = float(loss)
                out.append((run_id, "new_best", int(eid), float(loss)))
            prev = float(loss)
        state.update((cost, prev, best, breached))
        yield pd.DataFrame(out, columns=["run_id", "kind", "event_id", "value"])
    return fn


def run_monitor(stream: DataFrame, run_col: str, time_col: str, id_col: str, cost_col: str, loss_col: str,
                budget: float, spike_factor: float = 2.0) -> DataFrame:
    """Per-run alerts: first budget breach, loss spikes, new best losses."""
    s = stream.select(F.col(run_col).alias("run_id"), F.col(time_col).alias("t"), F.col(id_col).alias("event_id"),
                      F.col(cost_col).cast("double").alias("cost"), F.col(loss_col).cast("double").alias("loss"))
    return s.groupBy("run_id").applyInPandasWithState(
        _monitor_fn(budget, spike_factor), ALERT_SCHEMA, STATE_SCHEMA, "append", "NoTimeout")


# --- R1 / R2 -------------------------------------------------------------------------

def usage_totals_stream(stream: DataFrame, key: str, time_col: str, group_cols, value_col: str,
                        sink: str, delay: str = "1 day"):
    """Dedup re-delivered rows within the watermark, write per-batch partial
    totals into ``sink/batch_id=N`` (overwrite: replays are idempotent)."""
    dedup = stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy(*group_cols).agg(F.count("*").alias("n"), F.sum(value_col).alias("total"))
        part.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return dedup.writeStream.foreachBatch(write_batch)


def read_usage_totals(spark: SparkSession, sink: str, group_cols) -> DataFrame:
    parts = spark.read.parquet(sink)
    return parts.groupBy(*group_cols).agg(F.sum("n").alias("n"), F.round(F.sum("total"), 6).alias("total"))


# --- R3 ------------------------------------------------------------------------------

def parse_with_rejects(stream_text: DataFrame, schema: T.StructType, text_col: str = "value") -> DataFrame:
    """JSON lines -> parsed columns plus ``_corrupt`` for malformed lines."""
    parsed = stream_text.select(F.col(text_col).alias("_raw"), F.from_json(F.col(text_col), schema, {"mode": "PERMISSIVE"}).alias("j"))
    ok = F.try_parse_json(F.col("_raw")).isNotNull()
    return parsed.select("j.*", F.when(~ok, F.col("_raw")).alias("_corrupt"))


# --- R7 --------------------------------------------------------------------------------

def online_near_dup(stream: DataFrame, id_col: str, text_col: str, scope, index_path: str, out_path: str,
                    bands: int = 8, rows: int = 16):
    """foreachBatch: drop a doc when a band bucket holds a kept earlier doc
    (index of earlier batches, or earlier in this batch); append kept bands."""
    from tessera.operators import dedup as D

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        docs = batch.select(id_col, *scope, text_col)
        sigs = D.signatures(docs, text_col, id_col, scope)
        members = D.band_buckets(sigs, id_col, "signature", bands, rows, scope)
        members = members.cache()
        # only earlier batches' kept bands: a replayed batch sees the same index
        if path_exists(spark, index_path):
            index = spark.read.parquet(index_path).where(F.col("batch_id") < batch_id)
            hit = members.join(index.select("bucket").distinct(), "bucket", "left_semi").select(id_col).distinct()
        else:  # first batch
            hit = members.limit(0).select(id_col)
        rest = members.join(hit, id_col, "left_anti")
        multi = D._multi_member(rest, id_col)
        decided = D.first_wins(multi, id_col) if multi.limit(1).count() else multi.select(id_col).withColumn("kept", F.lit(True))
        verdict = (docs.select(id_col).join(hit.withColumn("_hit", F.lit(True)), id_col, "left")
                   .join(decided, id_col, "left")
                   .select(id_col, F.when(F.col("_hit"), F.lit(False)).otherwise(F.coalesce("kept", F.lit(True))).alias("kept")))
        verdict.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        kept_bands = members.join(verdict.where("kept").select(id_col), id_col, "left_semi").select("bucket", id_col)
        kept_bands.write.mode("overwrite").parquet(f"{index_path}/batch_id={batch_id}")
        members.unpersist()

    return stream.writeStream.foreachBatch(process)
