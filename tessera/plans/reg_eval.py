"""Evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import keyed_pick, keyed_unit, sql_u32, sql_unit
from tessera.functions.text import lines
from tessera.operators import evalmetrics as EV
from tessera.plans.adapters import SQL_PAIRS, SQL_VERDICTS, prompt_response_pairs, table, test_outcomes, verdicts
from tessera.plans.registry import register

PYS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
_KS = [1, 10, 50]
_LANGS = ["python", "javascript", "java"]


def _pass_sql(group: str = "") -> str:
    g = f"{group}, " if group else ""
    return f"""
WITH v AS ({SQL_VERDICTS}),
pt AS (SELECT {g}task_id, count(*) AS n, count(*) FILTER (WHERE passed) AS c FROM v GROUP BY {g}task_id),
kk AS (SELECT pt.*, k FROM pt, (VALUES {", ".join(f"({k})" for k in _KS)}) t(k) WHERE n >= k),
s AS (SELECT {g}k, CASE WHEN c = 0 THEN 0.0 WHEN n - c < k THEN 1.0
        ELSE 1.0 - list_reduce(list_transform(generate_series(n - c + 1, n), lambda i: 1.0 - k / i), lambda a, b: a * b) END AS p FROM kk),
a AS (SELECT {g}k, avg(p) AS pass_at_k, count(*) AS n_tasks FROM s GROUP BY {g}k),
allk AS (SELECT DISTINCT {g.rstrip(', ') + ',' if group else ''} k FROM pt, (VALUES {", ".join(f"({k})" for k in _KS)}) t(k))
SELECT {g}allk.k, round(coalesce(a.pass_at_k, 0.0), 6) AS pass_at_k, CAST(coalesce(a.n_tasks, 0) AS BIGINT) AS n_tasks
FROM allk LEFT JOIN a USING ({g}k)"""


@register("a5_pass_at_k", _pass_sql())
def q_a5(spark, sf):
    return EV.pass_at_k(verdicts(spark, sf), _KS)


_LANG_SQL = "[" + ", ".join(f"'{x}'" for x in _LANGS) + f"][{sql_u32('task_lang', 'user_id')} % 3 + 1]"


@register("a6_pass_at_k_by_language", _pass_sql("language").replace(
    f"WITH v AS ({SQL_VERDICTS})",
    f"WITH v AS (SELECT user_id AS task_id, event_id AS sample_id, event_type <> 'error' AS passed, {_LANG_SQL} AS language FROM events)"))
def q_a6(spark, sf):
    v = verdicts(spark, sf).withColumn("language", F.element_at(F.array(*[F.lit(x) for x in _LANGS]),
                                                                  (keyed_pick("task_lang", 3, "task_id") + 1).cast("int")))
    return EV.pass_at_k(v, _KS, group_cols=["language"])


# --- A7 / A13 -----------------------------------------------------------------------------------

@register("a7_task_accuracy", """
WITH t AS (SELECT l_orderkey, bool_and(l_returnflag <> 'R') AS ok FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderpriority, count(*) AS n_tasks, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM t JOIN orders o ON o.o_orderkey = t.l_orderkey GROUP BY o.o_orderpriority""")
def q_a7(spark, sf):
    groups = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), "o_orderpriority")
    return EV.task_accuracy(test_outcomes(spark, sf), group_cols=["o_orderpriority"], task_groups=groups)


@register("a13_zero_pass_tasks", """
SELECT l_orderkey AS task_id, count(*) AS n, count(*) FILTER (WHERE l_returnflag <> 'R') AS c
FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (WHERE l_returnflag <> 'R') = 0""")
def q_a13(spark, sf):
    return EV.zero_pass_tasks(test_outcomes(spark, sf))


# --- A8 -------------------------------------------------------------------------------------------
# documents carry no bug reports: the predictor words are ones the corpus contains.
_A8_WORDS = ["token = ", "@", "license"]


@register("a8_precision_recall", """
WITH j AS (SELECT l.toxic = 1 AS truth, (contains(lower(d.text), 'token = ') OR contains(lower(d.text), '@') OR contains(lower(d.text), 'license')) AS pred
           FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
c AS (SELECT count(*) FILTER (WHERE truth AND pred) AS tp, count(*) FILTER (WHERE NOT truth AND pred) AS fp,
             count(*) FILTER (WHERE truth AND NOT pred) AS fn, count(*) FILTER (WHERE NOT truth AND NOT pred) AS tn FROM j),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r FROM c)
SELECT tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM pr""")
def q_a8(spark, sf):
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents").select("doc_id", "text")
    j = lab.join(d, "doc_id").select((F.col("toxic") == 1).alias("truth"), EV.mentions_any(F.col("text"), _A8_WORDS).alias("pred"))
    return EV.confusion(j, "truth", "pred")


# --- A9 ---------------------------------------------------------------------------------------------

@register("a9_judge_scores", """
SELECT event_type, round(avg(TRY_CAST(trim(regexp_extract(props, ':([^}]*)', 1)) AS DOUBLE)), 6) AS mean_score,
       count(TRY_CAST(trim(regexp_extract(props, ':([^}]*)', 1)) AS DOUBLE)) AS n_numeric,
       count(*) FILTER (WHERE TRY_CAST(trim(regexp_extract(props, ':([^}]*)', 1)) AS DOUBLE) IS NULL) AS n_non_numeric
FROM events GROUP BY event_type""")
def q_a9(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.regexp_extract("props", ":([^}]*)", 1).alias("judge_text"))
    return EV.judge_scores(e, "judge_text", ["event_type"])


# --- A10 ---------------------------------------------------------------------------------------------

def _completion_rows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", lines("text").alias("ls"))
    x = d.select("doc_id", "ls", F.posexplode("ls").alias("i", "target")).where(F.col("i") < F.size("ls") - 1)
    b = keyed_pick("completion", 4, "doc_id", "i")
    nxt = F.element_at("ls", (F.col("i") + 2).cast("int"))
    pred = (F.when(b == 0, F.col("target")).when(b == 1, F.left("target", (F.length("target") / 2).cast("int")))
            .when(b == 2, nxt).otherwise(F.lit("")))
    return x.select("doc_id", "i", "target", pred.alias("prediction"))


@register("a10_completion_match", f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, ls, unnest(generate_series(0, len(ls) - 2)) AS i FROM d),
y AS (SELECT doc_id, i, ls[i + 1] AS target, ls[i + 2] AS nxt, {sql_u32('completion', 'doc_id', 'i')} % 4 AS b FROM x),
z AS (SELECT target, CASE b WHEN 0 THEN target WHEN 1 THEN left(target, CAST(trunc(length(target) / 2) AS INTEGER)) WHEN 2 THEN nxt ELSE '' END AS prediction FROM y)
SELECT count(*) AS n_scored,
  round(avg(CASE WHEN regexp_replace(prediction, '^[{PYS} ]+|[{PYS} ]+$', '', 'g') = regexp_replace(target, '^[{PYS} ]+|[{PYS} ]+$', '', 'g') THEN 1.0 ELSE 0.0 END), 6) AS exact_match,
  round(avg(CASE WHEN length(string_split(prediction, chr(10))[1]) > 0 AND starts_with(target, string_split(prediction, chr(10))[1]) THEN 1.0 ELSE 0.0 END), 6) AS prefix_match
FROM z""")
def q_a10(spark, sf):
    return EV.completion_match(_completion_rows(spark, sf), "prediction", "target")


# DuckDB's levenshtein counts UTF-8 bytes; the reference counts characters.
# Code-point distance is rows-only here and brute-force checked in pytest.
@register("a10_edit_distance")
def q_a10_edit(spark, sf):
    return EV.edit_distance(_completion_rows(spark, sf), "prediction", "target")


# --- A11 ---------------------------------------------------------------------------------------------

def _bleu_sql() -> str:
    toks = lambda c: f"list_filter(string_split_regex({c}, '[{PYS}]+'), lambda x: x <> '')"
    return f"""
WITH p AS ({SQL_PAIRS}),
t AS (SELECT conv_id * 1000 + turn AS id, {toks('response')} AS ct, {toks('prompt')} AS rt FROM p),
ns AS (SELECT * FROM range(1, 5) r(n)),
cg AS (SELECT id, n, array_to_string(ct[s : s + n - 1], ' ') AS gram FROM t, ns, LATERAL (SELECT unnest(generate_series(1, len(ct) - n + 1)) AS s) WHERE len(ct) >= n),
rg AS (SELECT id, n, array_to_string(rt[s : s + n - 1], ' ') AS gram FROM t, ns, LATERAL (SELECT unnest(generate_series(1, len(rt) - n + 1)) AS s) WHERE len(rt) >= n),
cc AS (SELECT id, n, gram, count(*) AS cc FROM cg GROUP BY ALL),
rc AS (SELECT id, n, gram, count(*) AS rc FROM rg GROUP BY ALL),
m AS (SELECT n, sum(least(cc, coalesce(rc, 0))) AS matches, sum(cc) AS total FROM cc LEFT JOIN rc USING (id, n, gram) GROUP BY n),
mm AS (SELECT ns.n, m.matches, m.total FROM ns LEFT JOIN m USING (n)),
pr AS (SELECT sum(ln(matches / total)) AS log_sum, count(*) FILTER (WHERE coalesce(matches, 0) = 0) AS zero_n FROM mm),
tot AS (SELECT sum(len(ct)) AS c, sum(len(rt)) AS r FROM t),
b AS (SELECT *, CASE WHEN c >= r THEN 1.0 WHEN c = 0 THEN 0.0 ELSE exp(1 - r / c) END AS bp FROM pr, tot)
SELECT round(CASE WHEN zero_n > 0 THEN 0.0 ELSE bp * exp(log_sum / 4) END, 6) AS bleu, round(bp, 6) AS brevity_penalty,
       CAST(c AS BIGINT) AS candidate_length, CAST(r AS BIGINT) AS reference_length FROM b"""


@register("a11_corpus_bleu", _bleu_sql())
def q_a11(spark, sf):
    p = prompt_response_pairs(spark, sf).withColumn("id", F.struct("conv_id", "turn"))
    return EV.corpus_bleu(p, "id", "response", "prompt")


# --- A12 ---------------------------------------------------------------------------------------------

@register("a12_rating_means", """
WITH j AS (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN MAP {}::MAP(VARCHAR, DOUBLE)
             ELSE MAP {'quality': CAST(l.quality AS DOUBLE), 'toxic': CAST(l.toxic AS DOUBLE)} END AS ratings
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT count(*) AS n_rated, round(avg(ratings['quality']), 6) AS mean_quality, count(ratings['quality']) AS n_quality,
       round(avg(ratings['helpfulness']), 6) AS mean_helpfulness, count(ratings['helpfulness']) AS n_helpfulness
FROM j WHERE cardinality(ratings) > 0""")
def q_a12(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left").select(
        "doc_id", F.when(F.col("quality").isNull(), F.create_map().cast("map<string,double>")).otherwise(
            F.create_map(F.lit("quality"), F.col("quality").cast("double"), F.lit("toxic"), F.col("toxic").cast("double"))).alias("ratings"))
    return EV.rating_means(j, "ratings", ["quality", "helpfulness"])


# --- A14 / A15 -----------------------------------------------------------------------------------------

def _loss_rows(spark, sf):
    from tessera.plans.prefix import row_numbers
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", (F.col("value") / 10.0).alias("loss"))
    rn = row_numbers(e, [], ["ts", "event_id"], "rn")
    return rn.withColumn("batch", F.floor((F.col("rn") - 1) / 16).cast("bigint"))


@register("a14_validation_loss", """
WITH r AS (SELECT value / 10.0 AS loss, (row_number() OVER (ORDER BY ts, event_id) - 1) // 16 AS batch FROM events),
b AS (SELECT batch, avg(loss) AS bm, sum(loss) AS bs, count(*) AS bn FROM r GROUP BY batch)
SELECT round(avg(bm), 6) AS loss_batch_mean, round(sum(bs) / sum(bn), 6) AS loss_token_mean, round(exp(avg(bm)), 6) AS perplexity FROM b""")
def q_a14(spark, sf):
    return EV.validation_loss(_loss_rows(spark, sf), "loss", "batch")


@register("a15_perplexity_by_language", f"""
WITH r AS (SELECT {_LANG_SQL} AS language, value / 10.0 AS loss, event_id AS batch FROM events),
b AS (SELECT language, batch, avg(loss) AS bm, sum(loss) AS bs, count(*) AS bn FROM r GROUP BY language, batch)
SELECT language, round(avg(bm), 6) AS loss_batch_mean, round(sum(bs) / sum(bn), 6) AS loss_token_mean, round(exp(avg(bm)), 6) AS perplexity
FROM b GROUP BY language""")
def q_a15(spark, sf):
    e = table(spark, sf, "events").select(
        F.element_at(F.array(*[F.lit(x) for x in _LANGS]), (keyed_pick("task_lang", 3, "user_id") + 1).cast("int")).alias("language"),
        (F.col("value") / 10.0).alias("loss"), F.col("event_id").alias("batch"))
    return EV.validation_loss(e, "loss", "batch", ["language"])


# --- A17 / A18 -----------------------------------------------------------------------------------------

@register("a17_consensus", """
WITH c AS (SELECT user_id, event_type AS sol, count(*) AS votes FROM events GROUP BY user_id, event_type)
SELECT user_id, min_by(sol, (-votes, sol)) AS consensus, CAST(-min((-votes, sol))[1] AS BIGINT) AS votes FROM c GROUP BY user_id""")
def q_a17(spark, sf):
    return EV.consensus(table(spark, sf, "events"), "user_id", "event_type")


@register("a18_distinct_solutions", """
SELECT user_id, count(DISTINCT event_type) AS n_distinct, count(*) AS n_samples FROM events GROUP BY user_id""")
def q_a18(spark, sf):
    return EV.distinct_solutions(table(spark, sf, "events"), "user_id", "event_type")


# --- A19 weak areas -------------------------------------------------------------------------------------

@register("a19_weak_area_allocation", """
WITH t AS (SELECT l_orderkey, bool_and(l_returnflag <> 'R') AS ok FROM lineitem GROUP BY l_orderkey),
g AS (SELECT o.o_orderpriority, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS accuracy FROM t JOIN orders o ON o.o_orderkey = t.l_orderkey GROUP BY 1),
w AS (SELECT *, 0.6 - accuracy AS deficit FROM g WHERE accuracy < 0.6),
s AS (SELECT *, deficit / sum(deficit) OVER () * 100 AS ex FROM w),
f AS (SELECT *, CAST(floor(ex) AS BIGINT) AS base, ex - floor(ex) AS rem FROM s),
r AS (SELECT *, 100 - sum(base) OVER () AS lft, row_number() OVER (ORDER BY rem DESC, o_orderpriority) AS rk FROM f)
SELECT o_orderpriority, round(accuracy, 6) AS accuracy, round(deficit, 6) AS deficit, base + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS new_prompts FROM r""")
def q_a19(spark, sf):
    groups = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), "o_orderpriority")
    per_task = test_outcomes(spark, sf).groupBy("task_id").agg(F.bool_and("passed").alias("ok")).join(groups, "task_id")
    g = per_task.groupBy("o_orderpriority").agg(F.avg(F.col("ok").cast("double")).alias("accuracy"))
    return EV.allocate_prompts(g, "o_orderpriority", "accuracy", 0.6, 100)


# --- A22 / W5 / W7 -----------------------------------------------------------------------------------------

def _scored(spark, sf):
    p = prompt_response_pairs(spark, sf)
    syntax = ~F.col("response").rlike("[#$%&*]{3}")
    tests = keyed_unit("tests", "conv_id", "turn") < 0.5
    documented = F.col("response").contains("\n")
    return p.withColumn("score", EV.solution_score(syntax, tests, F.col("response"), documented))


_A22_SQL = f"""
p AS ({SQL_PAIRS}),
s0 AS (SELECT conv_id, turn, category, response,
  (CASE WHEN NOT regexp_matches(response, '[#$%&*]{{3}}') THEN 1.0 ELSE 0.0 END)
  + (CASE WHEN {sql_unit('tests', 'conv_id', 'turn')} < 0.5 THEN 2.0 ELSE 0.0 END)
  + (CASE WHEN length(response) > 50 AND length(response) < 500 THEN 0.5 ELSE 0.0 END)
  + (CASE WHEN contains(response, chr(10)) THEN 0.5 ELSE 0.0 END) AS score0 FROM p),
s AS (SELECT *, CAST(score0 AS DOUBLE) AS score FROM s0)"""


@register("a22_solution_score", f"""
WITH {_A22_SQL[1:]}
SELECT conv_id, turn, score FROM s""")
def q_a22(spark, sf):
    return _scored(spark, sf).select("conv_id", "turn", "score")


@register("w5_top_solution", f"""
WITH {_A22_SQL[1:]}
SELECT conv_id, max(score) AS score, min_by(turn, (-score, turn)) AS turn FROM s GROUP BY conv_id""")
def q_w5(spark, sf):
    return EV.best_per_key(_scored(spark, sf), "conv_id", "score", "turn", []).select("conv_id", "score", "turn")


@register("w7_best_teacher", f"""
WITH {_A22_SQL[1:]},
t AS (SELECT *, ['gpt-4', 'claude-3-opus-20240229', 'local-coder'][{sql_u32('teacher', 'conv_id', 'turn')} % 3 + 1] AS teacher FROM s)
SELECT category, max(score) AS score, min_by(teacher, (-score, teacher)) AS teacher FROM t GROUP BY category""")
def q_w7(spark, sf):
    s = _scored(spark, sf).withColumn("teacher", F.element_at(F.array(F.lit("gpt-4"), F.lit("claude-3-opus-20240229"), F.lit("local-coder")),
                                                               (keyed_pick("teacher", 3, "conv_id", "turn") + 1).cast("int")))
    return EV.best_per_key(s, "category", "score", "teacher", []).select("category", "score", "teacher")


# --- J3 / J13 -----------------------------------------------------------------------------------------------

@register("j3_samples_problems", """
SELECT e.user_id AS task_id, count(*) AS n_samples, count(b.item_id) > 0 AS has_problem
FROM events e LEFT JOIN benchmark b ON b.item_id = e.user_id GROUP BY e.user_id""")
def q_j3(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("task_id"))
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("task_id"))
    matched = e.join(b, "task_id", "left_semi").groupBy("task_id").agg(F.count("*").alias("n_samples")).withColumn("has_problem", F.lit(True))
    missing = e.join(b, "task_id", "left_anti").groupBy("task_id").agg(F.count("*").alias("n_samples")).withColumn("has_problem", F.lit(False))
    return matched.unionByName(missing)


@register("j13_leaderboard", f"""
WITH pt AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type <> 'error') AS c FROM events GROUP BY user_id),
own AS (SELECT 'this-run' AS model, '?' AS size, round(100 * avg(CASE WHEN c = 0 THEN 0.0 WHEN n - c < 1 THEN 1.0 ELSE c / n END), 6) AS pass_at_1 FROM pt)
SELECT * FROM (VALUES ('CodeGen-Mono', '16B', 29.3), ('StarCoder', '15B', 33.6), ('Code Llama', '13B', 36.0), ('GPT-3.5-turbo', '?', 48.1)) v(model, size, pass_at_1)
UNION ALL SELECT * FROM own""")
def q_j13(spark, sf):
    p1 = EV.pass_at_k(verdicts(spark, sf), [1], digits=None).select(F.lit("this-run").alias("model"), F.lit("?").alias("size"),
                                                         F.round(F.col("pass_at_k") * 100, 6).alias("pass_at_1"))
    return EV.leaderboard(spark, p1)
