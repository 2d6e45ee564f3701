"""Remaining driver queries: keyed last-wins, first-N subset, unions,
pass-ratio, next-token shift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import keyed_unit, sql_unit
from tessera.operators import evalmetrics as EV
from tessera.operators import sequences as SEQ
from tessera.operators import teacher as TE
from tessera.plans.adapters import SQL_PAIRS, prompt_response_pairs, table, verdicts
from tessera.plans.registry import register
from tessera.sources import files
from tessera.streaming.monitor import scratch


@register("s4_keyed_last_wins", """
SELECT source, max_by(doc_id, doc_id) AS doc_id, max_by(n_chars, doc_id) AS n_chars FROM documents GROUP BY source""")
def q_s4(spark, sf):
    """Documents written as JSON lines in id order and read back: the last line of a key wins."""
    d = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    path = scratch(spark, "s4-lines")
    d.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.json(path)
    return files.keyed_last_wins(spark, path, "source", "source string, doc_id long, n_chars long")


@register("w12_first_n_problems", """
SELECT item_id, length(text) AS n_chars FROM benchmark ORDER BY item_id LIMIT 25""")
def q_w12(spark, sf):
    """The quick subset: first N problems in id order (the limit is the feature)."""
    b = table(spark, sf, "benchmark")
    return b.orderBy("item_id").limit(25).select("item_id", F.length("text").alias("n_chars"))


@register("u2_union_datasets", f"""
WITH p AS ({SQL_PAIRS})
SELECT conv_id, turn, 'original' AS origin, length(prompt) AS n_chars FROM p
UNION ALL
SELECT conv_id, turn, 'augmented' AS origin, length('[aug] ' || prompt) AS n_chars FROM p WHERE {sql_unit('augment', 'conv_id', 'turn')} < 0.1""")
def q_u2(spark, sf):
    """Original + augmented rows (keyed 10%; the augmentation here is a marker
    prefix — case mapping is locale-dependent) with an origin column."""
    p = prompt_response_pairs(spark, sf)
    orig = p.select("conv_id", "turn", F.lit("original").alias("origin"), F.length("prompt").alias("n_chars"))
    aug = (p.where(keyed_unit("augment", "conv_id", "turn") < 0.1)
           .select("conv_id", "turn", F.lit("augmented").alias("origin"), F.length(F.concat(F.lit("[aug] "), "prompt")).alias("n_chars")))
    return orig.unionByName(aug)


@register("u3_existing_plus_new", """
SELECT user_id AS task_id, event_id AS sample_id, 'existing' AS origin FROM events
UNION ALL
SELECT user_id AS task_id, cnt + s AS sample_id, 'new' AS origin
FROM (SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id) c, LATERAL (SELECT unnest(generate_series(1, 80 - cnt)) AS s) WHERE cnt < 80""")
def q_u3(spark, sf):
    """Existing samples unioned with the planned new ones (S13 work-list)."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("task_id"), F.col("event_id").alias("sample_id"))
    targets = e.select("task_id").distinct().withColumn("n_target", F.lit(80))
    new = TE.resume_worklist(e, targets).select("task_id", F.col("sample_idx").cast("bigint").alias("sample_id"))
    return e.withColumn("origin", F.lit("existing")).unionByName(new.withColumn("origin", F.lit("new")))


@register("a18_pass_ratio", """
WITH pt AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type <> 'error') AS c FROM events GROUP BY user_id),
k AS (SELECT k, avg(CASE WHEN c = 0 THEN 0.0 WHEN n - c < k THEN 1.0
        ELSE 1.0 - list_reduce(list_transform(generate_series(n - c + 1, n), lambda i: 1.0 - k / i), lambda a, b: a * b) END) AS p
      FROM pt, (VALUES (1), (10)) t(k) WHERE n >= k GROUP BY k)
SELECT round((SELECT p FROM k WHERE k = 10) / (SELECT p FROM k WHERE k = 1), 6) AS pass10_over_pass1""")
def q_a18_ratio(spark, sf):
    p = EV.pass_at_k(verdicts(spark, sf), [1, 10], digits=None)
    piv = p.groupBy().pivot("k", [1, 10]).agg(F.first("pass_at_k"))
    return piv.select(F.round(F.col("10") / F.col("1"), 6).alias("pass10_over_pass1"))


@register("t7_next_token_shift", """
WITH a AS (SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS pred FROM embeddings),
j AS (SELECT a.pred, e.label FROM a JOIN embeddings e ON e.vec_id = a.vec_id + 1)
SELECT count(*) AS n_pairs, round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM j""")
def q_t7(spark, sf):
    """Position i's prediction (argmax) against position i+1's label, joined
    on ``vec_id + 1`` (a unique key: no window over the sequence)."""
    e = table(spark, sf, "embeddings")
    pred = e.select((F.col("vec_id") + 1).alias("vec_id"),
                    (F.array_position("embedding", F.array_max("embedding")) - 1).alias("pred"))
    j = pred.join(e.select("vec_id", "label"), "vec_id")
    return j.agg(F.count("*").alias("n_pairs"),
                 F.round(F.avg((F.col("pred") == F.col("label")).cast("double")), 6).alias("accuracy"))


@register("t7_shifted_pairs", """
WITH t AS (SELECT doc_id, list_transform(string_split(substring(text, 1, 100), ''), lambda c: unicode(c) % 1000) AS ids FROM documents WHERE length(text) > 0)
SELECT doc_id, len(ids) - 1 AS n_pairs,
       CAST(coalesce(list_sum(list_transform(range(1, len(ids)), lambda i: CAST(ids[i] AS BIGINT) * ids[i + 1])), 0) AS BIGINT) AS product_sum FROM t""")
def q_t7_pairs(spark, sf):
    """Inputs against the labels one place on, over the toy tokenizer's ids."""
    d = table(spark, sf, "documents").where(F.length("text") > 0).select("doc_id", SEQ.codepoint_ids(F.col("text")).alias("ids"))
    z = d.select("doc_id", SEQ.shifted_pairs("ids", "ids").alias("z"))
    total = F.aggregate("z", F.lit(0).cast("bigint"), lambda s, p: s + p["x"].cast("bigint") * p["y"].cast("bigint"))
    return z.select("doc_id", F.size("z").cast("bigint").alias("n_pairs"), total.alias("product_sum"))


@register("t7_shifted_pairs_whole", """
WITH t AS (SELECT doc_id, CASE WHEN length(text) > 0 THEN list_transform(string_split(text, ''), lambda c: unicode(c) % 1000) ELSE [] END AS ids FROM documents)
SELECT doc_id, greatest(len(ids) - 1, 0) AS n_pairs,
       CAST(coalesce(list_sum(list_transform(range(1, len(ids)), lambda i: CAST(ids[i] AS BIGINT) * ids[i + 1])), 0) AS BIGINT) AS product_sum FROM t""")
def q_t7_pairs_whole(spark, sf):
    """As ``t7_shifted_pairs`` over whole texts; an empty text has no pair."""
    d = table(spark, sf, "documents").select("doc_id", SEQ.codepoint_ids(F.coalesce("text", F.lit("")), None).alias("ids"))
    z = d.select("doc_id", F.when(F.size("ids") > 0, SEQ.shifted_pairs("ids", "ids")).alias("z"))
    total = F.aggregate("z", F.lit(0).cast("bigint"), lambda s, p: s + p["x"].cast("bigint") * p["y"].cast("bigint"))
    return z.select("doc_id", F.when(F.col("z").isNull(), 0).otherwise(F.size("z")).cast("bigint").alias("n_pairs"), F.coalesce(total, F.lit(0)).alias("product_sum"))
