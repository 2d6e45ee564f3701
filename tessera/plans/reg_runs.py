"""Logit scoring (L1-L4) and run-metric windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import keyed_unit, sql_unit
from tessera.operators import logits as L
from tessera.operators import runmetrics as R
from tessera.plans.adapters import table
from tessera.plans.registry import register


# --- logits: student = row, teacher = row vec_id + 1, a keyed 10% of labels masked ----

def _positions(spark, sf):
    e = table(spark, sf, "embeddings")
    s = e.select("vec_id", F.col("embedding").alias("student"),
                 F.when(keyed_unit("mask", "vec_id") < 0.1, F.lit(-100)).otherwise(F.pmod("label", F.size("embedding"))).alias("label"))
    t = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("teacher"))
    return s.join(t, "vec_id")


_POS_SQL = f"""
pos AS (SELECT s.vec_id, s.embedding AS student, t.embedding AS teacher,
          CASE WHEN {sql_unit('mask', 's.vec_id')} < 0.1 THEN -100 ELSE s.label % len(s.embedding) END AS label
        FROM embeddings s JOIN embeddings t ON t.vec_id = s.vec_id + 1),
z AS (SELECT vec_id, label, list_transform(student, lambda v: CAST(v AS DOUBLE)) AS zs, list_transform(teacher, lambda v: CAST(v AS DOUBLE)) AS zt FROM pos)"""


@register("l1_log_softmax", """
WITH z AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS z FROM embeddings),
m AS (SELECT vec_id, z, list_max(z) AS mx FROM z),
l AS (SELECT vec_id, z, ln(list_sum(list_transform(z, lambda v: exp(v - mx)))) + mx AS lse FROM m)
SELECT vec_id, round(lse, 6) AS logsumexp, round(exp(list_max(z) - lse), 6) AS p_max FROM l""")
def q_l1(spark, sf):
    e = L.with_log_softmax(table(spark, sf, "embeddings"), "embedding", "lp")
    return e.select("vec_id", F.round("_lp_lse", 6).alias("logsumexp"), F.round(F.exp(F.array_max("lp")), 6).alias("p_max"))


@register("l2_cross_entropy", f"""
WITH {_POS_SQL[1:]},
m AS (SELECT *, list_max(zs) AS mx FROM z),
l AS (SELECT *, ln(list_sum(list_transform(zs, lambda v: exp(v - mx)))) + mx AS lse FROM m)
SELECT label, round(avg(-(zs[label + 1] - lse)), 6) AS hard_loss, count(*) AS n_positions FROM l WHERE label <> -100 GROUP BY label""")
def q_l2(spark, sf):
    return L.cross_entropy(_positions(spark, sf), "student", "label", ["label"])


@register("l4_distillation_loss", f"""
WITH {_POS_SQL[1:]},
a AS (SELECT *, list_transform(zs, lambda v: v / 2.0) AS ss, list_transform(zt, lambda v: v / 2.0) AS tt, list_max(zs) AS mx FROM z),
b AS (SELECT *, list_max(ss) AS ms, list_max(tt) AS mt, ln(list_sum(list_transform(zs, lambda v: exp(v - mx)))) + mx AS lse1 FROM a),
c AS (SELECT *, ln(list_sum(list_transform(ss, lambda v: exp(v - ms)))) + ms AS lses,
                ln(list_sum(list_transform(tt, lambda v: exp(v - mt)))) + mt AS lset FROM b),
d AS (SELECT *, list_transform(ss, lambda v: v - lses) AS ls, list_transform(tt, lambda v: v - lset) AS lt FROM c),
e AS (SELECT label, CASE WHEN label <> -100 THEN -(zs[label + 1] - lse1) END AS nll,
             CASE WHEN label <> -100 THEN list_sum(list_transform(lt, lambda v, i: exp(v) * (v - ls[i]))) END AS kl FROM d)
SELECT round(avg(nll), 6) AS hard_loss, round(avg(kl) * 4.0, 6) AS soft_loss,
       round(0.5 * avg(nll) + 0.5 * avg(kl) * 4.0, 6) AS total_loss, count(nll) AS n_positions FROM e""")
def q_l4(spark, sf):
    return L.distillation_loss(_positions(spark, sf))


# --- run metrics over events (run = user, loss = value) and orders (spend) -------------

def _runs(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), "ts", "event_id", F.col("value").alias("loss"))
    return R.number_steps(e, "run_id", ["ts", "event_id"])


_STEPS_SQL = "steps AS (SELECT user_id AS run_id, event_id, value AS loss, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events)"


@register("w8_loss_spikes", f"""
WITH {_STEPS_SQL}
SELECT run_id, step, coalesce(loss > 2.0 * lag(loss) OVER (PARTITION BY run_id ORDER BY step), false) AS is_spike FROM steps""")
def q_w8(spark, sf):
    return R.loss_spikes(_runs(spark, sf)).select("run_id", "step", "is_spike")


@register("w9_running_cost", """
SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER w, 6) AS running_cost, sum(o_totalprice) OVER w > 500000 AS over_budget
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_w9(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    r = R.running_cost(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 500000)
    return r.select("o_custkey", "o_orderkey", F.round("running_cost", 6).alias("running_cost"), "over_budget")


@register("w9_first_breach", """
WITH r AS (SELECT o_custkey, o_orderdate, o_orderkey,
             sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rc FROM orders)
SELECT o_custkey, min(o_orderdate) AS first_breach FROM r WHERE rc > 500000 GROUP BY o_custkey""")
def q_w9_first(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    r = R.running_cost(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 500000)
    return R.first_breach(r, "o_custkey", "o_orderdate")


@register("w10_best_so_far", f"""
WITH {_STEPS_SQL}
SELECT run_id, step, min(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far,
       loss <= min(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS is_new_best FROM steps""")
def q_w10(spark, sf):
    return R.best_so_far(_runs(spark, sf), "run_id", "step", "loss").select("run_id", "step", "best_so_far", "is_new_best")


@register("w10_checkpoint_retention", f"""
WITH {_STEPS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS recency,
             step = min_by(step, (loss, step)) OVER (PARTITION BY run_id) AS is_best FROM steps)
SELECT run_id, step, recency, is_best FROM r WHERE recency <= 3 OR is_best""")
def q_w10_keep(spark, sf):
    return R.checkpoints_to_keep(_runs(spark, sf), "run_id", "step", "loss").select("run_id", "step", "recency", "is_best")


@register("w11_cadence", f"""
WITH {_STEPS_SQL}
SELECT run_id, step, step % 10 = 0 AS log, step % 25 = 0 AS eval, step % 50 = 0 AS save FROM steps WHERE step % 10 = 0 OR step % 25 = 0""")
def q_w11(spark, sf):
    c = R.cadence(_runs(spark, sf), "step", {"log": 10, "eval": 25, "save": 50})
    return c.where(F.col("log") | F.col("eval")).select("run_id", "step", "log", "eval", "save")
