"""Stateful monitors whose work on one key is split over tasks.

A micro-batch is a table: running sums, minima and previous values come from
``plans.prefix.scans``, which spreads a hot run or user over any number of
tasks.  What a key carries from batch to batch are a few rows that enter the next
batch's scan ahead of its events.  State and results are written per batch id with
overwrite, and a batch reads only state of earlier ids, so a replayed batch
gives the same rows.  Folders lie under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.prefix import scans
from tessera.session import stage


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers N of the finished ``<path>/<prefix>N`` folders, ascending."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    done = [n for n in names if n.startswith(prefix) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n[len(prefix):]) for n in done)


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Snapshots:
    """One table a batch id; a batch reads the latest of an earlier id, and the
    ones before that are removed."""

    def __init__(self, path: str, schema: str):
        self.path, self.schema = path, schema

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        ids = [n for n in _folders(spark, self.path, "b=") if n < batch_id]
        if not ids:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/b={ids[-1]}")

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/b={batch_id}")
        ids = [n for n in _folders(df.sparkSession, self.path, "b=") if n < batch_id]
        for n in ids[:-1]:
            _remove(df.sparkSession, f"{self.path}/b={n}")

    def latest(self, spark: SparkSession) -> DataFrame:
        return self.before(spark, 2 ** 62)


# --- R5 / R6 -----------------------------------------------------------------------

RUN_STATE = "run_id long, cost double, low double, last double, breached boolean"


def run_monitor(stream: DataFrame, run_col: str, time_col: str, id_col: str, cost_col: str, loss_col: str, budget: float,
                state_path: str, out_path: str, spike_factor: float = 2.0):
    """Writer of per-run alerts (run_id, kind, event_id, value): the first time
    the running cost passes the budget, losses beyond ``spike_factor`` times the
    previous one, new least losses.  Events of a run are taken in the order of
    time and id within a batch; null costs add nothing, null losses are skipped."""
    state = Snapshots(state_path, RUN_STATE)
    loss = F.col(loss_col).cast("double")
    events = stream.select(F.col(run_col).cast("long").alias("run_id"), F.lit(1).alias("own"), F.col(time_col).alias("t"), F.col(id_col).cast("long").alias("event_id"),
                           F.col(cost_col).cast("double").alias("cost"), loss.alias("low"), loss.alias("last"), F.lit(False).alias("breached"))

    def process(batch: DataFrame, batch_id: int) -> None:
        carried = state.before(batch.sparkSession, batch_id)
        carried = carried.withColumns({"own": F.lit(0), "t": F.lit(None).cast(batch.schema["t"].dataType), "event_id": F.lit(None).cast("long")})
        rows = scans(batch.unionByName(carried), ["run_id"], ["own", "t", "event_id"],
                     {"running": ("sum", "cost"), "best": ("min", "low"), "prev": ("last", "last")})
        own = rows.where("own = 1")
        over = F.when((F.col("own") == 1) & (F.col("running") > budget), F.struct("t", "event_id", "running"))
        first = rows.groupBy("run_id").agg(F.min(over).alias("at"), F.max("breached").alias("before")).where("at IS NOT NULL AND NOT before")
        alerts = first.select("run_id", F.lit("budget_breach").alias("kind"), "at.event_id", F.round("at.running", 6).alias("value"))
        for kind, rule in (("loss_spike", F.col("low") > spike_factor * F.col("prev")),
                           ("new_best", F.col("low").isNotNull() & (F.col("best").isNull() | (F.col("low") < F.col("best"))))):
            alerts = alerts.unionByName(own.where(rule).select("run_id", F.lit(kind).alias("kind"), "event_id", F.col("low").alias("value")))
        alerts.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        order = F.when(F.col("last").isNotNull(), F.struct("own", "t", "event_id"))
        state.write(rows.groupBy("run_id").agg(
            F.sum("cost").alias("cost"), F.min("low").alias("low"), F.max_by("last", order).alias("last"),
            F.max(F.col("breached") | ((F.col("own") == 1) & (F.col("running") > budget))).alias("breached")), batch_id)

    return events.writeStream.foreachBatch(process)


# --- R8 ------------------------------------------------------------------------------

def merge_sessions(intervals: DataFrame, gap_us: int) -> DataFrame:
    """(user, start, last, n) intervals -> sessions of the same form: intervals of a
    user are one session while each starts within ``gap_us`` of what came before it."""
    reach = scans(intervals, ["user"], ["start", "last", "n"], {"reach": ("max", "last")})
    starts = F.col("reach").isNull() | (F.col("start") - F.col("reach") >= gap_us)
    marked = reach.select("user", "start", "last", "n", (~starts).cast("long").alias("more"), starts.cast("long").alias("new"))
    numbered = scans(marked, ["user"], ["start", "more"], {"session": ("sum", "new")})
    return numbered.groupBy("user", "session").agg(F.min("start").alias("start"), F.max("last").alias("last"), F.sum("n").alias("n")).drop("session")


class Sessions:
    """Sessions per user with a state of mergeable part sessions.

    A batch's events and the part sessions still open are merged; sessions that no
    timely event can reach any more are closed and appended to ``out``, the others stay.  An
    event is late, and dropped, if its own session would end at or before the
    watermark (the greatest time of earlier batches less the delay).  ``result``
    returns closed and open sessions alike."""

    INTERVAL = "start long, last long, n long"

    def __init__(self, base: str, user_type: str, gap_us: int, delay_us: int):
        self.gap, self.delay, self.out = gap_us, delay_us, f"{base}/closed"
        self.schema = f"user {user_type}, {self.INTERVAL}"
        self.open = Snapshots(f"{base}/open", self.schema)
        self.mark = Snapshots(f"{base}/mark", "greatest long")

    def writer(self, stream: DataFrame, user_col: str, time_us):
        us = F.col(time_us) if isinstance(time_us, str) else time_us
        events = stream.select(F.col(user_col).alias("user"), us.alias("start"), us.alias("last"), F.lit(1).cast("long").alias("n"))

        def process(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            known = self.mark.before(spark, batch_id).agg(F.max("greatest")).first()[0]
            timely = batch.where(F.col("start").isNotNull())
            if known is not None:
                timely = timely.where(F.col("start") + self.gap > known - self.delay)
            greatest = timely.agg(F.max("start")).first()[0]
            greatest = max([x for x in (known, greatest) if x is not None], default=None)
            merged = stage(merge_sessions(timely.unionByName(self.open.before(spark, batch_id)), self.gap), "sessions")
            # a timely event starts after the watermark less the gap and reaches back by the gap
            done = F.lit(False) if greatest is None else F.col("last") + 2 * self.gap <= greatest - self.delay
            merged.where(done).write.mode("overwrite").parquet(f"{self.out}/batch_id={batch_id}")
            self.open.write(merged.where(~done), batch_id)
            self.mark.write(spark.createDataFrame([(greatest,)], "greatest long"), batch_id)

        return events.writeStream.foreachBatch(process)

    def result(self, spark: SparkSession) -> DataFrame:
        closed = spark.read.schema(f"{self.schema}, batch_id long").parquet(self.out).drop("batch_id")
        every = closed.unionByName(self.open.latest(spark))
        return every.select("user", F.col("start").alias("session_start_us"), (F.col("last") + self.gap).alias("session_end_us"), F.col("n").alias("n_events"))


# --- R7 --------------------------------------------------------------------------------

class AppendIndex:
    """A table that grows by one folder a batch, partitioned by ``slot``.  After
    ``every`` batches the folders are merged into one.  Rows hold their batch id,
    so a replayed batch sees only what came before it, merged or not."""

    def __init__(self, path: str, schema: str, every: int = 8):
        self.path, self.schema, self.every = path, f"{schema}, batch long, slot int", every

    def _parts(self, spark: SparkSession) -> list[str]:
        whole = _folders(spark, self.path, "upto=")
        top = whole[-1] if whole else -1
        return [f"upto={n}" for n in whole[-1:]] + [f"b={n}" for n in _folders(spark, self.path, "b=") if n > top]

    def before(self, spark: SparkSession, batch_id: int, slots: list[int] | None = None) -> DataFrame:
        """Rows of earlier batches; only files of the given slots are read."""
        out = spark.createDataFrame([], self.schema)
        for part in self._parts(spark):
            rows = spark.read.schema(self.schema).parquet(f"{self.path}/{part}").where(F.col("batch") < batch_id)
            out = out.unionByName(rows if slots is None else rows.where(F.col("slot").isin(slots)))
        return out

    def any_before(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether the index has rows of earlier batches."""
        return not self.before(spark, batch_id).isEmpty()

    def append(self, df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("batch", F.lit(batch_id).cast("long"))
        rows.repartition("slot").write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/b={batch_id}")
        spark = df.sparkSession
        parts = self._parts(spark)
        if len(parts) > self.every:
            self.before(spark, batch_id + 1).repartition("slot").write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/upto={batch_id}")
            for part in parts:
                _remove(spark, f"{self.path}/{part}")


def online_near_dup(stream: DataFrame, id_col: str, text_col: str, scope, index_path: str, out_path: str, p=None,
                    prefixes: int = 4, compact_every: int = 8):
    """Writer of (id, kept): a document is dropped iff a kept one of an earlier
    batch, or an earlier kept one of its own batch, is its near copy (exact Jaccard
    of token sets, as in ``operators.neardup``).

    The index of kept documents is append-only: band memberships lie by band and
    bucket prefix, token sets and their sketches by a hash of their name.  A batch
    reads the slots that its own buckets fall in, of the sketches those of the
    pairs that meet there, and of the token sets those of the pairs that sketches allow."""
    from tessera.operators import neardup as N
    p = N.Verified() if p is None else p
    scope = list(scope)
    bands = AppendIndex(f"{index_path}/bands", "bucket long, node long, n int", compact_every)
    sets = AppendIndex(f"{index_path}/sets", "node long, toks array<long>, sketch array<long>", compact_every)
    slot = (F.col("band") * prefixes + F.pmod("bucket", F.lit(prefixes))).cast("int")
    name = F.pmod("node", F.lit(64)).cast("int")

    def known_copies(batch_id: int, rows: DataFrame, placed: DataFrame, members: DataFrame) -> DataFrame:
        """(node) of the batch that are near copies of kept documents."""
        spark = rows.sparkSession
        touched = [r.slot for r in members.select("slot").distinct().collect()]  # bands x prefixes at most
        known = bands.before(spark, batch_id, touched).select("slot", "bucket", F.col("node").alias("a"), F.col("n").alias("a_n"))
        near = F.least("n", "a_n") / F.greatest("n", "a_n") >= p.threshold
        pairs = stage(members.join(known, ["slot", "bucket"]).where(near).select("a", "a_n", F.col("node").alias("b")).distinct(), "neardup-met")
        held = sets.before(spark, batch_id, _slots(pairs))
        both = pairs.join(held.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
        both = both.join(placed.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("sketch").alias("sb")), "b")
        pairs = stage(both.where(N.may_be_near(F.col("sa"), F.col("a_n"), F.col("sb"), F.col("b_n"), p)).select("a", "b"), "neardup-candidates")
        held = sets.before(spark, batch_id, _slots(pairs)).select("node", "toks").join(pairs.select(F.col("a").alias("node")).distinct(), "node")
        own = N.token_sets(rows, pairs.select(F.col("b").alias("node")))
        both = pairs.join(held.select(F.col("node").alias("a"), F.col("toks").alias("ta")), "a")
        both = both.join(own.select(F.col("node").alias("b"), F.col("toks").alias("tb")), "b").withColumn("shared", F.size(F.array_intersect("ta", "tb")))
        likeness = F.col("shared") / (F.size("ta") + F.size("tb") - F.col("shared"))
        return stage(both.where(likeness >= p.threshold).select(F.col("b").alias("node")).distinct(), "neardup-hits")

    def _slots(pairs: DataFrame) -> list[int]:
        return [r[0] for r in pairs.select(F.pmod("a", F.lit(64)).cast("int")).distinct().collect()]

    def process(batch: DataFrame, batch_id: int) -> None:
        docs = batch.select(id_col, *scope, text_col)
        rows = N.profiles(docs, text_col, id_col, scope, p)
        placed = N.nodes(rows)
        members = placed.select("node", "n", F.posexplode("buckets").alias("band", "bucket")).withColumn("slot", slot)
        hit = known_copies(batch_id, rows, placed, members) if bands.any_before(batch.sparkSession, batch_id) else None
        rest = placed if hit is None else placed.join(hit, "node", "left_anti")
        dropped = N.dropped_nodes(rows, rest, p)
        dropped = stage(dropped if hit is None else hit.unionByName(dropped), "neardup-dropped")
        out = N.verdict(docs, text_col, id_col, scope, rows, placed, dropped)
        out.select(id_col, F.col("near_dup_kept").alias("kept")).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        kept = rows.join(dropped, "node", "left_anti").dropDuplicates(["node"])
        sets.append(kept.select("node", "toks", "sketch", name.alias("slot")), batch_id)
        bands.append(members.join(dropped, "node", "left_anti").select("bucket", "node", "n", "slot"), batch_id)

    return stream.writeStream.foreachBatch(process)
