"""Teacher request planning and response accounting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import keyed_pick, keyed_unit, sql_u32, sql_unit
from tessera.operators import teacher as TE
from tessera.plans.adapters import SQL_PAIRS, prompt_response_pairs, table
from tessera.plans.registry import register

PYS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
_PROVIDERS = ["openai", "anthropic", "local"]
_MODELS = {
    "openai": ["gpt-4", "gpt-4-turbo", "gpt-3.5-turbo", "gpt-4o-preview"],
    "anthropic": ["claude-3-opus-20240229", "claude-3-sonnet-20240229", "claude-3-haiku-20240307", "unlisted-model"],
    "local": ["local-coder"],
}


def _requests(spark, sf):
    """Pairs with a keyed provider/model choice and char-count token proxies."""
    p = prompt_response_pairs(spark, sf)
    prov = F.element_at(F.array(*[F.lit(x) for x in _PROVIDERS]),
                        (keyed_pick("provider", len(_PROVIDERS), "conv_id", "turn") + 1).cast("int"))
    p = p.withColumn("provider", prov)
    model = None
    for pv, ms in _MODELS.items():
        pick = F.element_at(F.array(*[F.lit(m) for m in ms]), (keyed_pick("model", len(ms), "conv_id", "turn") + 1).cast("int"))
        model = F.when(F.col("provider") == pv, pick) if model is None else model.when(F.col("provider") == pv, pick)
    return (p.withColumn("model", model)
            .withColumn("input_tokens", F.length("prompt").cast("bigint"))
            .withColumn("output_tokens", F.length("response").cast("bigint")))


def _sql_requests() -> str:
    prov = "[" + ", ".join(f"'{x}'" for x in _PROVIDERS) + f"][{sql_u32('provider', 'conv_id', 'turn')} % {len(_PROVIDERS)} + 1]"
    cases = " ".join(
        f"WHEN '{pv}' THEN [" + ", ".join(f"'{m}'" for m in ms) + f"][{sql_u32('model', 'conv_id', 'turn')} % {len(ms)} + 1]"
        for pv, ms in _MODELS.items())
    return f"""
p0 AS ({SQL_PAIRS}),
p1 AS (SELECT *, {prov} AS provider FROM p0),
req AS (SELECT *, CASE provider {cases} END AS model, CAST(length(prompt) AS BIGINT) AS input_tokens,
               CAST(length(response) AS BIGINT) AS output_tokens FROM p1)"""


# FIXED VALUES: published prices per 1,000 tokens, as in functions/constants.py
_PRICES_SQL = """
prices AS (SELECT * FROM (VALUES ('openai', 'gpt-4', 0.03, 0.06), ('openai', 'gpt-4-turbo', 0.01, 0.03),
   ('openai', 'gpt-3.5-turbo', 0.0005, 0.0015), ('anthropic', 'claude-3-opus-20240229', 0.015, 0.075),
   ('anthropic', 'claude-3-sonnet-20240229', 0.003, 0.015), ('anthropic', 'claude-3-haiku-20240307', 0.00025, 0.00125))
   v(provider, model, price_in, price_out)),
defaults AS (SELECT * FROM (VALUES ('openai', 0.01, 0.03), ('anthropic', 0.003, 0.015)) v(provider, default_in, default_out)),
costed AS (SELECT req.*, input_tokens * CAST(round(coalesce(price_in, default_in, 0.0) * 100000) AS BIGINT)
                         + output_tokens * CAST(round(coalesce(price_out, default_out, 0.0) * 100000) AS BIGINT) AS cost_units
           FROM req LEFT JOIN prices USING (provider, model) LEFT JOIN defaults USING (provider))"""


# --- P24 ------------------------------------------------------------------------------------

@register("p24_cache_key", f"""
WITH {_sql_requests()[1:]}
SELECT conv_id, turn, substr(sha256(prompt || '{{"max_tokens": 1024, "model": "' || model || '", "temperature": 0.7}}'), 1, 16) AS cache_key
FROM req""")
def q_p24(spark, sf):
    r = _requests(spark, sf)
    params = TE.canonical_params(F.col("model"), F.lit(0.7), F.lit(1024))
    return r.select("conv_id", "turn", TE.cache_key(F.col("prompt"), params).alias("cache_key"))


# --- P25 ------------------------------------------------------------------------------------

@register("p25_request_payload", f"""
WITH {_sql_requests()[1:]},
s AS (SELECT *, CASE WHEN turn = 0 THEN NULL ELSE category END AS sys FROM req)
SELECT conv_id, turn, provider, md5(CASE
  WHEN provider = 'anthropic' AND sys IS NULL THEN to_json({{'model': model, 'max_tokens': 1024, 'temperature': 0.7::DOUBLE, 'messages': [{{'role': 'user', 'content': prompt}}]}})
  WHEN provider = 'anthropic' THEN to_json({{'model': model, 'max_tokens': 1024, 'temperature': 0.7::DOUBLE, 'messages': [{{'role': 'user', 'content': prompt}}], 'system': sys}})
  WHEN sys IS NULL THEN to_json({{'model': model, 'messages': [{{'role': 'user', 'content': prompt}}], 'temperature': 0.7::DOUBLE, 'max_tokens': 1024}})
  ELSE to_json({{'model': model, 'messages': [{{'role': 'system', 'content': sys}}, {{'role': 'user', 'content': prompt}}], 'temperature': 0.7::DOUBLE, 'max_tokens': 1024}})
END) AS payload_md5 FROM s""")
def q_p25(spark, sf):
    r = _requests(spark, sf).withColumn("sys", F.when(F.col("turn") == 0, F.lit(None)).otherwise(F.col("category")))
    body = TE.request_payload(F.col("provider"), F.col("model"), F.col("prompt"), F.lit(0.7), F.lit(1024), F.col("sys"))
    return r.select("conv_id", "turn", "provider", F.md5(body).alias("payload_md5"))


# --- P26: provider payloads derived from the pairs, then normalised ---------------------------

def _payloads(spark, sf):
    r = _requests(spark, sf)
    chat = F.to_json(F.struct(
        F.array(F.struct(F.struct(F.col("response").alias("content")).alias("message"))).alias("choices"),
        F.struct((F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
                 F.col("input_tokens").alias("prompt_tokens"), F.col("output_tokens").alias("completion_tokens")).alias("usage")))
    local = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("response").alias("content")).alias("message"))).alias("choices")))
    anth = F.to_json(F.struct(F.array(F.struct(F.col("response").alias("text"))).alias("content"),
                              F.struct(F.col("input_tokens").alias("input_tokens"),
                                       F.col("output_tokens").alias("output_tokens")).alias("usage")))
    raw = F.when(F.col("provider") == "anthropic", anth).when(F.col("provider") == "local", local).otherwise(chat)
    # a keyed 5% of conversations get a truncated payload: malformed input must surface as parse_error
    raw = F.when(keyed_unit("malformed", "conv_id") < 0.05, F.substring(raw, 1, 20)).otherwise(raw)
    return r.withColumn("raw", raw)


@register("p26_normalize_response", f"""
WITH {_sql_requests()[1:]},
m AS (SELECT *, {sql_unit('malformed', 'conv_id')} < 0.05 AS bad FROM req)
SELECT conv_id, turn, provider, CASE WHEN bad THEN NULL ELSE md5(response) END AS content_md5,
  CASE WHEN bad OR provider = 'local' THEN 0 ELSE input_tokens + output_tokens END AS tokens_used,
  CASE WHEN bad OR provider = 'local' THEN 0 ELSE input_tokens END AS input_tokens,
  CASE WHEN bad OR provider = 'local' THEN 0 ELSE output_tokens END AS output_tokens,
  bad AS parse_error
FROM m""")
def q_p26(spark, sf):
    n = TE.normalize_response(_payloads(spark, sf).select("conv_id", "turn", "provider", "raw"))
    return n.select("conv_id", "turn", "provider", F.md5("content").alias("content_md5"), "tokens_used",
                    "input_tokens", "output_tokens", "parse_error")


# --- P27 / J7 --------------------------------------------------------------------------------

@register("p27_cost_estimate", f"""
WITH {_sql_requests()[1:]}, {_PRICES_SQL[1:]}
SELECT conv_id, turn, provider, model, cost_units, cost_units / 100000000.0 AS cost_estimate FROM costed""")
def q_p27(spark, sf):
    c = TE.estimate_cost(_requests(spark, sf))
    return c.select("conv_id", "turn", "provider", "model", "cost_units", "cost_estimate")


@register("s9_metadata_sidecar", f"""
WITH {_sql_requests()[1:]}, {_PRICES_SQL[1:]}
SELECT count(*) AS num_examples, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS total_tokens, sum(cost_units) / 100000000.0 AS estimated_cost,
       'mixed' AS teacher_model, 'mixed' AS teacher_provider FROM costed""")
def q_s9(spark, sf):
    c = TE.estimate_cost(_requests(spark, sf)).withColumn("tokens_used", F.col("input_tokens") + F.col("output_tokens"))
    return TE.dataset_metadata(c, "mixed", "mixed")


@register("a20_cost_projection", f"""
WITH {_sql_requests()[1:]}
SELECT provider, count(*) AS n_examples, CAST(round(count(*) * 0.05, 6) AS DOUBLE) AS cost_low, CAST(round(count(*) * 0.15, 6) AS DOUBLE) AS cost_high,
  CASE WHEN count(*) >= 50000 THEN 'Large' WHEN count(*) >= 10000 THEN 'Medium' WHEN count(*) >= 1000 THEN 'Small' ELSE 'Tiny' END AS size_tier
FROM req GROUP BY provider""")
def q_a20(spark, sf):
    counts = _requests(spark, sf).groupBy("provider").agg(F.count("*").alias("n_examples"))
    return TE.cost_projection(counts)


# --- W2 / J5 ----------------------------------------------------------------------------------

@register("w2_request_batches", f"""
WITH p AS ({SQL_PAIRS}), r AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM p)
SELECT conv_id, turn, (rn - 1) // 10 AS batch_id, CAST((rn - 1) % 10 AS INTEGER) AS position FROM r""")
def q_w2(spark, sf):
    return TE.batches(prompt_response_pairs(spark, sf).select("conv_id", "turn"), ["conv_id", "turn"])


@register("j5_positional_zip", """
WITH u AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations WHERE role = 'assistant')
SELECT u.conv_id AS prompt_conv, u.turn AS prompt_turn, a.conv_id AS response_conv, a.turn AS response_turn,
       (u.rn - 1) // 10 AS batch_id FROM u JOIN a ON u.rn = a.rn""")
def q_j5(spark, sf):
    c = table(spark, sf, "conversations")
    u = TE.batches(c.where("role = 'user'").select("conv_id", "turn"), ["conv_id", "turn"])
    a = TE.batches(c.where("role = 'assistant'").select("conv_id", "turn"), ["conv_id", "turn"])
    return (u.select(F.col("conv_id").alias("prompt_conv"), F.col("turn").alias("prompt_turn"), "batch_id", "position")
            .join(a.select(F.col("conv_id").alias("response_conv"), F.col("turn").alias("response_turn"), "batch_id", "position"),
                  ["batch_id", "position"]).drop("position"))


@register("j5_exchange_zip", """
WITH u AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations WHERE role = 'user')
SELECT u.conv_id AS prompt_conv, u.turn AS prompt_turn, a.conv_id AS response_conv, a.turn AS response_turn, (u.rn - 1) // 10 AS batch_id
FROM u LEFT JOIN (SELECT conv_id, turn FROM conversations WHERE role = 'assistant') a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1""")
def q_j5_exchange(spark, sf):
    """Every prompt with the response of its own exchange, null where none came."""
    c = table(spark, sf, "conversations")
    u = TE.batches(c.where("role = 'user'").select("conv_id", "turn"), ["conv_id", "turn"])
    a = c.where("role = 'assistant'").select(F.col("conv_id").alias("response_conv"), F.col("turn").alias("response_turn"))
    u = u.select(F.col("conv_id").alias("prompt_conv"), F.col("turn").alias("prompt_turn"), "batch_id")
    return (u.join(a, (F.col("response_conv") == F.col("prompt_conv")) & (F.col("response_turn") == F.col("prompt_turn") + 1), "left")
            .select("prompt_conv", "prompt_turn", "response_conv", "response_turn", "batch_id"))


# --- J6 / F14 -----------------------------------------------------------------------------------

_CACHE_SQL_KEY = "substr(sha256(prompt || '{\"max_tokens\": 1024, \"model\": \"' || model || '\", \"temperature\": 0.7}'), 1, 16)"


def _keyed(spark, sf):
    r = _requests(spark, sf)
    return r.withColumn("cache_key", TE.cache_key(F.col("prompt"), TE.canonical_params(F.col("model"), F.lit(0.7), F.lit(1024))))


@register("j6_cache_lookup", f"""
WITH {_sql_requests()[1:]},
k AS (SELECT *, {_CACHE_SQL_KEY} AS cache_key FROM req),
cache AS (SELECT cache_key, response AS cached FROM k WHERE {sql_unit('cached', 'conv_id', 'turn')} < 0.3)
SELECT k.conv_id, k.turn, cache.cache_key IS NOT NULL AS hit FROM k LEFT JOIN cache ON k.cache_key = cache.cache_key""")
def q_j6(spark, sf):
    k = _keyed(spark, sf)
    cache = k.where(keyed_unit("cached", "conv_id", "turn") < 0.3).select("cache_key", F.col("response").alias("cached"))
    hits, misses = TE.cache_lookup(k.select("conv_id", "turn", "cache_key"), cache)
    return (hits.select("conv_id", "turn", F.lit(True).alias("hit"))
            .unionByName(misses.select("conv_id", "turn", F.lit(False).alias("hit"))))


@register("f14_prefilter_requests", f"""
WITH {_sql_requests()[1:]},
k AS (SELECT *, {_CACHE_SQL_KEY} AS cache_key,
        regexp_replace(lower(regexp_replace(prompt, '^[{PYS} ]+|[{PYS} ]+$', '', 'g')), '[{PYS}]+', ' ', 'g') AS norm,
        row(conv_id, turn) AS id FROM req WHERE length(prompt) >= 20),
cache AS (SELECT cache_key FROM k WHERE {sql_unit('cached', 'conv_id', 'turn')} < 0.3),
d AS (SELECT * FROM k WHERE id = (SELECT min(id) FROM k k2 WHERE k2.norm = k.norm))
SELECT conv_id, turn FROM d WHERE cache_key NOT IN (SELECT cache_key FROM cache)""")
def q_f14(spark, sf):
    k = _keyed(spark, sf).withColumn("id", F.struct("conv_id", "turn"))
    cache = k.where(keyed_unit("cached", "conv_id", "turn") < 0.3).select("cache_key")
    return TE.prefilter_requests(k, cache).select("conv_id", "turn")


# --- J12 / P28 -------------------------------------------------------------------------------------

@register("j12_route_teacher", f"""
WITH p AS ({SQL_PAIRS})
SELECT conv_id, turn, length(prompt) AS complexity,
  CASE WHEN length(prompt) >= 800 THEN 'gpt-4' WHEN length(prompt) >= 200 THEN 'gpt-4-turbo' ELSE 'gpt-3.5-turbo' END AS teacher FROM p""")
def q_j12(spark, sf):
    p = prompt_response_pairs(spark, sf).withColumn("complexity", F.length("prompt"))
    return p.select("conv_id", "turn", "complexity", TE.route_by_complexity(F.col("complexity")).alias("teacher"))


@register("p28_score_band", """
WITH s AS (SELECT user_id AS task_id, 100.0 * count(*) FILTER (WHERE event_type = 'purchase') / count(*) AS score FROM events GROUP BY user_id)
SELECT task_id, round(score, 6) AS score, CASE WHEN score >= 50 THEN 'SOTA' WHEN score >= 45 THEN 'Excellent' WHEN score >= 35 THEN 'Strong'
  WHEN score >= 28 THEN 'Competitive' WHEN score >= 20 THEN 'Basic' ELSE 'Weak' END AS band FROM s""")
def q_p28(spark, sf):
    e = table(spark, sf, "events")
    s = e.groupBy(F.col("user_id").alias("task_id")).agg(
        (100.0 * F.count_if(F.col("event_type") == "purchase") / F.count("*")).alias("score"))
    return s.select("task_id", F.round("score", 6).alias("score"), TE.band(F.col("score")).alias("band"))


# --- S13 resume ------------------------------------------------------------------------------------

@register("s13_resume_worklist", """
WITH have AS (SELECT user_id AS task_id, count(DISTINCT event_id) AS n_existing FROM events GROUP BY user_id),
t AS (SELECT task_id, 80 AS n_target, n_existing FROM have)
SELECT task_id, n_existing, unnest(generate_series(n_existing + 1, n_target)) AS sample_idx FROM t WHERE n_target > n_existing""")
def q_s13(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("task_id"), F.col("event_id").alias("sample_id"))
    targets = e.select("task_id").distinct().withColumn("n_target", F.lit(80))
    return TE.resume_worklist(e, targets).select("task_id", "n_existing", F.col("sample_idx").cast("bigint"))
