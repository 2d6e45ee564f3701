"""Teacher-request planning and response accounting (P24-P27, J5-J7, J12,
F14, A4, A20, S9, S13, W2).

Calling the teacher is outside the engine (network client, not built);
these operators plan requests (keys, payloads, batches, cache anti-joins,
work-lists) and account for responses (normalisation, pricing, totals).
Price and route tables are bounded configuration: broadcast or a CASE chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.functions.text import col
from tessera.plans.prefix import row_numbers


# --- P24 -------------------------------------------------------------------------

def json_string(c) -> Column:
    """A JSON string literal in ASCII: quotes, backslashes, control characters
    and all beyond ASCII are escaped (the last as UTF-16 units)."""
    s = col(c)
    named = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}

    def escaped(ch: Column) -> Column:
        units = F.regexp_replace(F.lower(F.hex(F.encode(ch, "UTF-16BE"))), "(.{4})", r"\\u$1")
        out = F.when(ch.rlike("^[ !#-\\[\\]-~]$"), ch)
        for plain, short in named.items():
            out = out.when(ch == plain, F.lit(short))
        return out.otherwise(units)

    odd = F.array_join(F.transform(F.split(s, "", -1), escaped), "")
    return F.concat(F.lit('"'), F.when(s.rlike("[^ !#-\\[\\]-~]"), odd).otherwise(s), F.lit('"'))


def json_double(c) -> Column:
    """A double in the shortest digits that read back as itself, in fixed notation
    for exponents from -4 to 15, as Python prints it."""
    x = col(c)
    short = F.coalesce(*[F.when(F.format_string(f"%.{k}e", x).try_cast("double") == x, F.format_string(f"%.{k}e", x)) for k in range(17)])

    def printed(e: Column) -> Column:
        sign = F.when(e.startswith("-"), "-").otherwise("")
        digits = F.regexp_replace(F.regexp_extract(e, r"^-?([0-9.]+)e", 1), r"\.", "")
        digits = F.coalesce(F.nullif(F.regexp_replace(digits, "0+$", ""), F.lit("")), F.lit("0"))
        power = F.regexp_extract(e, "e(.+)$", 1).cast("int")
        n = F.length(digits)
        whole = F.concat(F.rpad(F.substring(digits, F.lit(1), F.least(n, power + 1)), power + 1, "0"), F.lit("."),
                         F.when(n > power + 1, F.substring(digits, power + 2, n)).otherwise("0"))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
        tail = F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise("")
        far = F.concat(F.substring(digits, 1, 1), tail, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
        far = F.when(F.abs(power) > 99, F.concat(F.substring(digits, 1, 1), tail, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.abs(power).cast("string"))).otherwise(far)
        return F.concat(sign, F.when(power.between(0, 15), whole).when(power.between(-4, -1), small).otherwise(far))

    # a transform over one element names the digits, which are used several times
    text = F.element_at(F.transform(F.array(short), printed), 1)
    return (F.when(F.isnan(x), "NaN").when(x == float("inf"), "Infinity").when(x == float("-inf"), "-Infinity").otherwise(text))


def canonical_json(c, kind: T.DataType) -> Column:
    """``json.dumps(value, sort_keys=True)`` of a column of ``kind``: structs and
    string-keyed maps with sorted keys, arrays, strings, numbers, booleans, nulls."""
    v = col(c)
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name.encode("utf-16-be"))
        parts = [F.concat(json_string(F.lit(f.name)), F.lit(": "), canonical_json(v[f.name], f.dataType)) for f in fields]
        out = F.concat(F.lit("{"), F.concat_ws(", ", *parts) if parts else F.lit(""), F.lit("}"))
        out = F.when(v.isNotNull(), out)
    elif isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(v), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        parts = F.transform(entries, lambda e: F.concat(json_string(e["key"]), F.lit(": "), canonical_json(e["value"], kind.valueType)))
        out = F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: canonical_json(x, kind.elementType)), ", "), F.lit("]"))
    elif isinstance(kind, T.StringType):
        out = json_string(v)
    elif isinstance(kind, T.DoubleType):
        out = json_double(v)
    elif isinstance(kind, (T.BooleanType, T.IntegralType)):
        out = v.cast("string")
    else:
        raise TypeError(f"no JSON form for {kind.simpleString()}")
    return F.coalesce(out, F.lit("null"))


def canonical_params(model, temperature, max_tokens) -> Column:
    """``json.dumps({...}, sort_keys=True)`` for the request parameters."""
    kind = T.StructType([T.StructField("model", T.StringType()), T.StructField("temperature", T.DoubleType()), T.StructField("max_tokens", T.LongType())])
    return canonical_json(F.struct(col(model).alias("model"), col(temperature).cast("double").alias("temperature"), col(max_tokens).cast("long").alias("max_tokens")), kind)


def cache_key(prompt, params_json) -> Column:
    """First 16 hex digits of sha256(prompt + canonical params JSON)."""
    return F.substring(F.sha2(F.concat(col(prompt), col(params_json)), 256), 1, 16)


# --- P25 -------------------------------------------------------------------------

def request_payload(provider, model, prompt, temperature, max_tokens, system=None) -> Column:
    """Provider request body as JSON: chat-style messages (system as a
    message) or a top-level ``system`` field (anthropic)."""
    sys_c = F.lit(None).cast("string") if system is None else col(system)
    user = F.struct(F.lit("user").alias("role"), col(prompt).alias("content"))
    chat_msgs = F.when(sys_c.isNotNull(), F.array(F.struct(F.lit("system").alias("role"), sys_c.alias("content")), user)
                       ).otherwise(F.array(user))
    chat = F.to_json(F.struct(col(model).alias("model"), chat_msgs.alias("messages"),
                              col(temperature).alias("temperature"), col(max_tokens).alias("max_tokens")))
    anth = F.to_json(F.struct(col(model).alias("model"), col(max_tokens).alias("max_tokens"),
                              col(temperature).alias("temperature"), F.array(user).alias("messages"),
                              sys_c.alias("system")))
    return F.when(col(provider) == "anthropic", anth).otherwise(chat)


# --- P26 -------------------------------------------------------------------------

CHAT_SCHEMA = ("choices array<struct<message:struct<content:string>>>, "
               "usage struct<total_tokens:bigint, prompt_tokens:bigint, completion_tokens:bigint>")
ANTH_SCHEMA = "content array<struct<text:string>>, usage struct<input_tokens:bigint, output_tokens:bigint>"


def normalize_response(df: DataFrame, provider: str = "provider", raw: str = "raw") -> DataFrame:
    """(content, tokens_used, input_tokens, output_tokens, parse_error) per payload.

    openai: choices[0].message.content, usage.total_tokens;
    anthropic: content[0].text, input+output tokens;
    openai-compatible (local): usage defaults to 0.  Malformed payloads keep
    ``parse_error`` true (a rejects table, never silent loss).
    """
    chat = F.from_json(F.col(raw), CHAT_SCHEMA)
    anth = F.from_json(F.col(raw), ANTH_SCHEMA)
    is_anth = F.col(provider) == "anthropic"
    content = F.when(is_anth, F.try_element_at(anth["content"], F.lit(1))["text"]).otherwise(
        F.try_element_at(chat["choices"], F.lit(1))["message"]["content"])
    in_tok = F.when(is_anth, anth["usage"]["input_tokens"]).otherwise(chat["usage"]["prompt_tokens"])
    out_tok = F.when(is_anth, anth["usage"]["output_tokens"]).otherwise(chat["usage"]["completion_tokens"])
    total = F.when(is_anth, F.coalesce(anth["usage"]["input_tokens"] + anth["usage"]["output_tokens"], F.lit(0))).otherwise(
        F.coalesce(chat["usage"]["total_tokens"], F.lit(0)))
    return df.select("*", content.alias("content"), total.alias("tokens_used"),
                     F.coalesce(in_tok, F.lit(0)).alias("input_tokens"), F.coalesce(out_tok, F.lit(0)).alias("output_tokens"),
                     (F.try_parse_json(F.col(raw)).isNull() | content.isNull()).alias("parse_error"))


# --- P27 / J7 -------------------------------------------------------------------------

def price_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.TEACHER_PRICES, "provider string, model string, price_in double, price_out double")


def default_price_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.TEACHER_DEFAULT_PRICES, "provider string, default_in double, default_out double")


def estimate_cost(df: DataFrame, provider: str = "provider", model: str = "model",
                  input_tokens: str = "input_tokens", output_tokens: str = "output_tokens") -> DataFrame:
    """tokens/1000 x price (in and out); unknown model -> provider default;
    any other provider (local / compatible) -> 0.  Both price tables are
    configuration of a few rows: broadcast left joins."""
    spark = df.sparkSession
    p = price_table(spark).withColumnRenamed("provider", "_pp").withColumnRenamed("model", "_pm")
    d = default_price_table(spark).withColumnRenamed("provider", "_dp")
    j = (df.join(F.broadcast(p), (F.col(provider) == F.col("_pp")) & (F.col(model) == F.col("_pm")), "left")
         .join(F.broadcast(d), F.col(provider) == F.col("_dp"), "left"))
    pin = F.coalesce("price_in", "default_in", F.lit(0.0))
    pout = F.coalesce("price_out", "default_out", F.lit(0.0))
    # money in exact integer units of 1e-8 (every price is a multiple of 1e-5
    # per 1k tokens): sums are exact and order-independent across engines
    units = (F.col(input_tokens) * F.round(pin * PRICE_SCALE).cast("bigint")
             + F.col(output_tokens) * F.round(pout * PRICE_SCALE).cast("bigint"))
    return (j.withColumn("cost_units", units).withColumn("cost_estimate", F.col("cost_units") / COST_UNITS)
            .drop("_pp", "_pm", "price_in", "price_out", "_dp", "default_in", "default_out"))


PRICE_SCALE = 100000      # price per 1k tokens -> integer
COST_UNITS = 100000000.0  # tokens x scaled price -> currency (1000 x 1e5)


# --- J12 routing -------------------------------------------------------------------------

DEFAULT_ROUTES = [(0, "gpt-3.5-turbo"), (200, "gpt-4-turbo"), (800, "gpt-4")]


def route_by_complexity(score, routes=DEFAULT_ROUTES) -> Column:
    """Band (lower bound inclusive) -> teacher; a CASE chain over the bounded
    route list, no range join."""
    expr = None
    for lo, model in sorted(routes, reverse=True):
        cond = col(score) >= lo
        expr = F.when(cond, F.lit(model)) if expr is None else expr.when(cond, F.lit(model))
    return expr


def band(value, bands=K.SCORE_BANDS) -> Column:
    """Label of the highest lower bound <= value."""
    return route_by_complexity(value, bands)


# --- J5 / W2 batches -------------------------------------------------------------------------

def batches(df: DataFrame, order_cols, size: int = 10) -> DataFrame:
    """Fixed-size request batches: ``batch_id``, ``position`` (0-based)."""
    rn = row_numbers(df, [], order_cols, "_rn")
    return (rn.withColumn("batch_id", F.floor((F.col("_rn") - 1) / size).cast("bigint"))
            .withColumn("position", F.pmod(F.col("_rn") - 1, F.lit(size)).cast("int")).drop("_rn"))


# --- J6 / F14 cache and pre-filter ------------------------------------------------------------

def cache_lookup(requests: DataFrame, cache: DataFrame, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """(hits with cached response, misses to send)."""
    hits = requests.join(cache, key, "inner")
    misses = requests.join(cache.select(key), key, "left_anti")
    return hits, misses


def prefilter_requests(requests: DataFrame, cache: DataFrame, prompt: str = "prompt", id_col: str = "id",
                       min_length: int = 20, key: str = "cache_key") -> DataFrame:
    """drop trivial prompts, duplicates (first kept) and cache hits."""
    from tessera.operators.dedup import exact_dedup, normalized_prompt
    r = requests.where(F.length(F.col(prompt)) >= min_length).withColumn("_norm", normalized_prompt(F.col(prompt)))
    r = exact_dedup(r, "_norm", id_col).drop("_norm", "content_hash")
    return r.join(cache.select(key), key, "left_anti")


# --- S13 resume work-list -------------------------------------------------------------------------

def resume_worklist(existing: DataFrame, targets: DataFrame, task: str = "task_id", sample: str = "sample_id",
                    target_col: str = "n_target") -> DataFrame:
    """Missing sample indices per task: ``existing+1 .. target`` (distinct
    sample ids count as existing; over-full tasks produce nothing)."""
    have = existing.groupBy(task).agg(F.count_distinct(sample).alias("n_existing"))
    j = targets.join(have, task, "left").withColumn("n_existing", F.coalesce("n_existing", F.lit(0)))
    return (j.where(F.col(target_col) > F.col("n_existing"))
            .select(task, "n_existing", F.explode(F.sequence(F.col("n_existing") + 1, F.col(target_col))).alias("sample_idx")))


# --- S9 / A20 ---------------------------------------------------------------------------------------

def dataset_metadata(df: DataFrame, teacher_model: str, teacher_provider: str,
                     tokens: str = "tokens_used", cost_units: str = "cost_units") -> DataFrame:
    """One-row sidecar: count, total tokens, cost (exact unit sum), teacher."""
    return df.agg(F.count("*").alias("num_examples"), F.sum(tokens).alias("total_tokens"),
                  (F.sum(cost_units) / COST_UNITS).alias("estimated_cost")).select(
        "*", F.lit(teacher_model).alias("teacher_model"), F.lit(teacher_provider).alias("teacher_provider"))


# FIXED VALUES: lower bounds and names of the size tiers
SIZE_TIERS = [(0, "Tiny"), (1000, "Small"), (10000, "Medium"), (50000, "Large")]


def cost_projection(counts: DataFrame, n: str = "n_examples", low_per: float = 0.05, high_per: float = 0.15) -> DataFrame:
    """low/high projected cost and the dataset-size tier."""
    return counts.select("*", F.round(F.col(n) * low_per, 6).alias("cost_low"), F.round(F.col(n) * high_per, 6).alias("cost_high"),
                         band(F.col(n), SIZE_TIERS).alias("size_tier"))
