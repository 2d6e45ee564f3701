"""Queries over files: rows of the given tables are rendered to files in the
shared scratch folder and read back by the library's sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.hashing import keyed_pick, keyed_u32, keyed_unit, sql_u32, sql_unit
from tessera.operators import bpe, evalmetrics, prompts, quality, sampling
from tessera.operators import teacher as TE
from tessera.plans import tidy
from tessera.plans.adapters import SQL_PAIRS, prompt_response_pairs, table
from tessera.plans.reg_dedup import PYS
from tessera.plans.registry import register
from tessera.sources import files
from tessera.streaming.monitor import scratch

FIELD_LIMIT = 200
PACKS = "*.json"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{PYS} ]+|[{PYS} ]+$', '', 'g')"


# --- S1: broken lines, blank lines, values that are no strings -------------------------

def _rendered_lines(spark, sf, name):
    p = prompt_response_pairs(spark, sf)
    u = keyed_unit("line", "conv_id", "turn")
    line = (F.when(u < 0.1, "").when(u < 0.2, F.concat(F.lit('{"prompt": '), F.col("turn").cast("string")))
            .when(u < 0.3, F.to_json(F.struct("prompt", F.col("turn").alias("response")))).otherwise(F.to_json(F.struct("prompt", "response"))))
    path = scratch(spark, name)
    # files in the order of the pairs: the source reads them by path
    p.repartitionByRange(4, "conv_id", "turn").sortWithinPartitions("conv_id", "turn").select(line.alias("value")).write.text(path)
    return path


_S1_SQL = f"""WITH p AS ({SQL_PAIRS}), u AS (SELECT *, {sql_unit('line', 'conv_id', 'turn')} AS u FROM p),
v AS (SELECT conv_id, turn, 0 AS f, prompt AS text FROM u WHERE u >= 0.2 UNION ALL SELECT conv_id, turn, 1, response FROM u WHERE u >= 0.3)
SELECT f AS field_idx, md5(text) AS text_md5 FROM v"""


@register("s1_jsonl_texts", _S1_SQL)
def q_s1(spark, sf):
    """String fields of JSON lines; blank and broken lines are skipped."""
    t = files.tolerant_jsonl_texts(spark, _rendered_lines(spark, sf, "s1"))
    return t.select("field_idx", F.md5("text").alias("text_md5"))


@register("s1_jsonl_field_limit", _S1_SQL + f" ORDER BY conv_id, turn, f LIMIT {FIELD_LIMIT}")
def q_s1_limit(spark, sf):
    """The first 200 fields in file order (the limit is the feature)."""
    t = files.tolerant_jsonl_texts(spark, _rendered_lines(spark, sf, "s1-limit"), limit=FIELD_LIMIT)
    return t.select("field_idx", F.md5("text").alias("text_md5"))


# --- S2 / S8 / S15 / S3 -----------------------------------------------------------------

_DOC_SCHEMA = "doc_id long, lang string, source string, text string"
_DOC_SQL = "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents"


@register("s2_s8_strict_jsonl", _DOC_SQL)
def q_s2(spark, sf):
    """Whole documents to JSON lines and back."""
    path = scratch(spark, "s2")
    files.write_jsonl(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"), path)
    return files.strict_jsonl(spark, path, _DOC_SCHEMA).select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@register("s15_gz_jsonl", _DOC_SQL)
def q_s15(spark, sf):
    """As ``s2_s8_strict_jsonl``, compressed."""
    path = scratch(spark, "s15")
    table(spark, sf, "documents").select("doc_id", "lang", "source", "text").write.option("compression", "gzip").json(path)
    return files.gz_jsonl(spark, path, _DOC_SCHEMA).select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@register("s3_json_array", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_s3(spark, sf):
    """One JSON array per file: a dimension table's rows by region."""
    path = scratch(spark, "s3")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    n.groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey"))).alias("value")).select("value").write.text(path)
    schema = "n_nationkey int, n_name string, n_regionkey int"
    arrays = spark.read.text(path).where("value <> ''")  # a part file may hold several arrays, one a line
    one = scratch(spark, "s3-array")
    arrays.select(F.explode(F.from_json("value", f"array<struct<{schema.replace(' int', ': int').replace(' string', ': string')}>>")).alias("r")).agg(
        F.to_json(F.array_sort(F.collect_list("r"))).alias("value")).write.text(one)  # one row a nation
    return files.json_array_document(spark, one, schema).select("n_nationkey", "n_name", "n_regionkey")


# --- S10 / S11 -----------------------------------------------------------------------------

@register("s10_prompt_files", f"""
SELECT category, printf('%03d_%s', row_number() OVER (PARTITION BY category ORDER BY conv_id, turn), language) AS file_name, md5(prompt) AS prompt_md5
FROM ({SQL_PAIRS})""")
def q_s10(spark, sf):
    """Prompts numbered per category, written by category and read back; a second write is refused."""
    path = scratch(spark, "s10")
    named = files.with_prompt_file_names(prompt_response_pairs(spark, sf), order_cols=("conv_id", "turn"))
    named = named.select("category", "file_name", "prompt")
    files.write_prompts_by_category(named, path)
    try:
        files.write_prompts_by_category(named, path)
    except Exception as e:
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise
    else:
        raise AssertionError("an existing target was overwritten")
    back = spark.read.schema("file_name string, prompt string, category string").json(path)
    return back.select("category", "file_name", F.md5("prompt").alias("prompt_md5"))


# --- S5 / P1 / P2 / P4 / J1 / A3 ------------------------------------------------------------

_SNIPPETS = [("python", "def f(x):\n    return x"), ("java", "public class A {}"), ("rust", "fn main() {}"), ("unknown", "plain words")]


def _pair_files(spark, sf, name):
    """Two text trees in packs, a folder a pair: prompts with headers, and the answers of nine pairs in ten."""
    p = prompt_response_pairs(spark, sf).withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    snippets = F.array(*[F.lit(s) for _, s in _SNIPPETS])
    snippet = F.element_at(snippets, (keyed_pick("snippet", len(_SNIPPETS), "conv_id", "turn") + 1).cast("int"))
    body = F.when(F.col("category") == "explanation", F.concat("prompt", F.lit("\nExplain this code:\n"), snippet)).otherwise(F.col("prompt"))
    content = F.concat(F.lit("Category: "), "category", F.lit("\nLanguage: "), "language", F.lit("\n\n" + prompts.RULE * 5 + "\n\n"), body, F.lit("\n"))
    base = scratch(spark, name)

    def tree(rows, value, root):
        # a folder holds a file per task that has rows of its key, as a partitioned write makes them; all travel in packs
        line = F.concat(F.coalesce(value, F.lit("")), F.lit("\n"))
        dealt = rows.select("key", line.alias("line"), F.spark_partition_id().alias("part"))
        held = dealt.groupBy("key", "part").agg(F.array_join(F.array_sort(F.collect_list("line")), "").alias("content"))
        path = F.concat(F.lit("key="), "key", F.lit("/part-"), F.col("part").cast("string"), F.lit(".txt"))
        files.write_packed_tree(held.select(path.alias("rel_path"), "content"), root)
        return root

    kept = p.where(keyed_unit("answered", "conv_id", "turn") >= 0.1)
    return tree(p, content, f"{base}/prompts"), tree(kept, F.concat(F.lit("  "), "response", F.lit(" \n")), f"{base}/answers")


def _folder(path):
    """The key of a pair: its folder."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


_TIDY_SQL = f"""WITH p AS ({SQL_PAIRS}),
s AS (SELECT *, {sql_u32('snippet', 'conv_id', 'turn')} % {len(_SNIPPETS)} AS k, {sql_unit('answered', 'conv_id', 'turn')} >= 0.1 AS answered FROM p),
t AS (SELECT *, category = 'explanation' AND k IN (1, 2) AS was_fixed, CASE k {' '.join(f"WHEN {i} THEN '{s.replace(chr(10), chr(10))}'" for i, (_, s) in enumerate(_SNIPPETS))} END AS snippet FROM s),
x AS (SELECT 'key=' || conv_id || '-' || turn AS rel_path, category, CASE WHEN was_fixed THEN CASE k WHEN 1 THEN 'java' ELSE 'rust' END ELSE language END AS language,
        md5({_strip("CASE WHEN category = 'explanation' THEN prompt || chr(10) || 'Explain this code:' || chr(10) || snippet ELSE prompt END")}) AS prompt_md5,
        md5({_strip('response')}) AS response_md5, was_fixed, answered FROM t)"""


@register("j1_tidy_pairs", _TIDY_SQL + " SELECT rel_path, category, language, prompt_md5, response_md5, was_fixed FROM x WHERE answered")
def q_j1(spark, sf):
    """Prompt and answer files joined on their path, parsed and relabelled."""
    examples, _ = tidy.tidy_pairs(spark, *_pair_files(spark, sf, "j1"), key=_folder, packs=PACKS)
    return examples.select("rel_path", "category", "language", F.md5("prompt").alias("prompt_md5"), F.md5("response").alias("response_md5"), "was_fixed")


@register("a3_tidy_stats", _TIDY_SQL + """ SELECT count(*) AS total, count(*) FILTER (WHERE answered) AS valid, count(*) FILTER (WHERE NOT answered) AS missing_answer,
       count(*) FILTER (WHERE answered AND was_fixed) AS language_mismatch, count(*) FILTER (WHERE answered AND was_fixed) AS fixed FROM x""")
def q_a3_tidy(spark, sf):
    """Counts of the tidying stage."""
    where = _pair_files(spark, sf, "a3")
    examples, _ = tidy.tidy_pairs(spark, *where, key=_folder, packs=PACKS)
    return tidy.tidy_stats(files.text_tree(spark, where[0], packs=PACKS), examples)


# --- P20, P22, F13, M8, T4, P18 ------------------------------------------------------------------

@register("p20_import_header", r"""
WITH d AS (SELECT doc_id, concat('import ', source, chr(10), '# note', chr(10), '   from ', lang, ' import x  ', chr(10), chr(10), text) AS content FROM documents),
l AS (SELECT doc_id, list_transform(string_split(content, chr(10)), lambda x: regexp_replace(x, '^[""" + PYS + r""" ]+|[""" + PYS + r""" ]+$', '', 'g')) AS ls FROM d),
s AS (SELECT doc_id, ls, coalesce(list_position(list_transform(ls, lambda x: NOT (starts_with(x, 'import ') OR starts_with(x, 'from ') OR x = '' OR starts_with(x, '#'))), TRUE), 0) AS stop FROM l)
SELECT doc_id, array_to_string(list_filter(CASE WHEN stop > 0 THEN ls[1:stop-1] ELSE ls END, lambda x: starts_with(x, 'import ') OR starts_with(x, 'from ')), '|') AS header FROM s""")
def q_p20(spark, sf):
    """Import lines at the head of each document, which gets two of its own."""
    d = table(spark, sf, "documents")
    content = F.concat(F.lit("import "), F.coalesce("source", F.lit("")), F.lit("\n# note\n   from "), F.coalesce("lang", F.lit("")), F.lit(" import x  \n\n"), F.coalesce("text", F.lit("")))
    return d.select("doc_id", F.array_join(prompts.import_header(content), "|").alias("header"))


_STEMS = ["main", "utils", "helpers", "config", "model", "api", "base", "io"]
_PATH_SQL = f"""SELECT DISTINCT source AS project, 'd' || ({sql_u32('dir', 'doc_id')} % 6) || '/' || ['main','utils','helpers','config','model','api','base','io'][{sql_u32('stem', 'doc_id')} % 8 + 1]
         || CASE WHEN {sql_u32('stem', 'doc_id')} % 8 IN (0, 4, 5, 7) THEN '_' || doc_id ELSE '' END || '.py' AS path FROM documents WHERE source IS NOT NULL"""


@register("p22_related_files", f"""
WITH f AS ({_PATH_SQL}),
x AS (SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(path, '([^/]*)\\.py$', 1) AS stem FROM f),
c AS (SELECT a.project, a.path AS current, b.path AS cand, min(CASE WHEN a.dir = b.dir AND a.path <> b.path THEN 0 ELSE 1 END) AS tier
      FROM x a JOIN x b ON a.project = b.project AND ((a.dir = b.dir AND a.path <> b.path) OR b.stem IN ('utils', 'helpers', 'config', 'base')) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY project, current ORDER BY tier, cand) AS rank FROM c)
SELECT project, current, cand, CAST(rank AS INTEGER) AS rank, rank <= 3 AS used FROM r WHERE rank <= 5""")
def q_p22(spark, sf):
    """Related files of every file of a project (paths are derived from the documents)."""
    d = table(spark, sf, "documents").where(F.col("source").isNotNull())
    stem = keyed_pick("stem", 8, "doc_id")
    name = F.concat(F.element_at(F.array(*[F.lit(s) for s in _STEMS]), (stem + 1).cast("int")),
                    F.when(stem.isin(0, 4, 5, 7), F.concat(F.lit("_"), F.col("doc_id").cast("string"))).otherwise(""))
    path = F.concat(F.lit("d"), keyed_pick("dir", 6, "doc_id").cast("string"), F.lit("/"), name, F.lit(".py"))
    f = d.select(F.col("source").alias("project"), path.alias("path")).distinct()
    return prompts.related_files(f, f).select("project", "current", "cand", F.col("rank").cast("int").alias("rank"), "used")


@register("f13_skip_placeholders", f"""
SELECT conv_id, turn FROM ({SQL_PAIRS}) WHERE NOT ({sql_unit('placeholder', 'conv_id', 'turn')} < 0.2)""")
def q_f13(spark, sf):
    """Prompts without the placeholder, which a fifth of them get in mixed case."""
    p = prompt_response_pairs(spark, sf)
    marked = F.when(keyed_unit("placeholder", "conv_id", "turn") < 0.2, F.concat("prompt", F.lit("\n# Code Snippet HERE\n"))).otherwise(F.col("prompt"))
    return quality.skip_placeholders(p.withColumn("prompt", marked)).select("conv_id", "turn")


@register("m8_shuffled_files", f"""
WITH k AS (SELECT doc_id, {sql_u32('buffer', 'doc_id')} AS k FROM documents)
SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, 0 AS n_out_of_order, TRUE AS spread, CAST(sum(k) AS BIGINT) AS key_sum FROM k""")
def q_m8(spark, sf):
    """Documents written in keyed order within 8 files and read back: every row once, each file in key order."""
    from pyspark.sql import Window
    path = scratch(spark, "m8")
    sampling.shuffle_for_write(table(spark, sf, "documents").select("doc_id", "text"), 8, "doc_id").write.parquet(path)
    back = spark.read.parquet(path).select("doc_id", keyed_u32("buffer", "doc_id").alias("k"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    prev = F.lag("k").over(Window.partitionBy("file").orderBy("at"))  # one written file
    return back.withColumn("prev", prev).agg(
        F.count("*").alias("n_rows"), F.countDistinct("doc_id").alias("n_ids"), F.count_if(F.col("prev") > F.col("k")).cast("int").alias("n_out_of_order"),
        (F.countDistinct("file") == 8).alias("spread"), F.sum("k").alias("key_sum"))


_SPECIALS = {"trainer": K.SPECIAL_TOKENS_TRAINER, "guide": K.SPECIAL_TOKENS_GUIDE}


@register("t4_special_tokens", "WITH t(profile, token, id) AS (VALUES " + ", ".join(
    f"('{p}', '{t}', {i})" for p, ts in _SPECIALS.items() for i, t in enumerate(ts)) + """)
SELECT profile, token, id, count(d.doc_id) AS n_docs FROM t LEFT JOIN documents d ON contains(d.text, t.token) GROUP BY profile, token, id""")
def q_t4(spark, sf):
    """Special tokens of both profiles, and the documents that hold each."""
    out = None
    for profile in _SPECIALS:
        t = bpe.special_token_table(spark, profile).withColumn("profile", F.lit(profile))
        out = t if out is None else out.unionByName(t)
    tokens = sorted({t for ts in _SPECIALS.values() for t in ts})
    held = F.array_compact(F.array(*[F.when(F.col("text").contains(t), F.lit(t)) for t in tokens]))
    n = table(spark, sf, "documents").select(F.explode(held).alias("token")).groupBy("token").agg(F.count("*").alias("n_docs"))
    return out.join(n, "token", "left").select("profile", "token", "id", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


@register("p18_code_blocks", f"""
WITH p AS (SELECT conv_id, turn, response || chr(10) || '```python' || chr(10) || 'x = ' || turn || chr(10) || '```' || chr(10) || '<pre class="a"> <code>y' || conv_id || '</code> </pre>' AS t FROM ({SQL_PAIRS}))
SELECT conv_id, turn, len(b) AS n_blocks, array_to_string(b, '|') AS blocks FROM (
  SELECT conv_id, turn, list_concat(regexp_extract_all(t, '(?s)```[^\\n]*\\n(.*?)```', 1), regexp_extract_all(t, '(?is)<pre[^>]*>\\s*<code[^>]*>(.*?)</code>\\s*</pre>', 1)) AS b FROM p)""")
def q_p18_code(spark, sf):
    """Code blocks of every response, which gets one fenced and one marked-up of its own."""
    p = prompt_response_pairs(spark, sf)
    t = F.concat("response", F.lit("\n```python\nx = "), F.col("turn").cast("string"), F.lit('\n```\n<pre class="a"> <code>y'), F.col("conv_id").cast("string"), F.lit("</code> </pre>"))
    b = prompts.code_blocks(t)
    return p.select("conv_id", "turn", F.size(b).alias("n_blocks"), F.array_join(b, "|").alias("blocks"))


# --- P24, A10 -------------------------------------------------------------------------------

_JSON_CHAR = ("CASE WHEN c = chr(34) THEN chr(92) || chr(34) WHEN c = chr(92) THEN chr(92) || chr(92) WHEN c = chr(10) THEN chr(92) || 'n' WHEN c = chr(13) THEN chr(92) || 'r' "
              "WHEN c = chr(9) THEN chr(92) || 't' WHEN unicode(c) BETWEEN 32 AND 126 THEN c WHEN unicode(c) < 65536 THEN chr(92) || 'u' || printf('%04x', unicode(c)) "
              "ELSE chr(92) || 'u' || printf('%04x', 55296 + (unicode(c) - 65536) // 1024) || chr(92) || 'u' || printf('%04x', 56320 + (unicode(c) - 65536) % 1024) END")


@register("p24_canonical_request", f"""
WITH c AS (SELECT conv_id, turn, role, text, chr(34) || array_to_string(list_transform(string_split(text, ''), lambda c: {_JSON_CHAR}), '') || chr(34) AS q FROM conversations WHERE text IS NOT NULL AND text <> '')
SELECT conv_id, turn, substr(sha256(text || '{{"messages": [{{"content": ' || q || ', "role": "' || role || '"}}], "meta": {{"conv": ' || conv_id || ', "turn": ' || turn || '}}, "stop": null, "temperature": '
       || CAST(turn / 8.0 AS VARCHAR) || '}}'), 1, 16) AS cache_key FROM c""")
def q_p24_nested(spark, sf):
    """Cache keys of nested request parameters: sorted keys, ASCII escapes, shortest floats."""
    c = table(spark, sf, "conversations").where("text IS NOT NULL AND text <> ''")
    message = F.struct("role", F.col("text").alias("content"))
    params = F.struct((F.col("turn") / 8.0).alias("temperature"), F.array(message).alias("messages"), F.lit(None).cast("string").alias("stop"),
                      F.create_map(F.lit("turn"), F.col("turn").cast("long"), F.lit("conv"), F.col("conv_id").cast("long")).alias("meta"))
    kind = c.select(params.alias("p")).schema["p"].dataType
    return c.select("conv_id", "turn", TE.cache_key("text", TE.canonical_json(params, kind)).alias("cache_key"))


@register("a10_edit_distance_folded", f"""
WITH d AS (SELECT doc_id, string_split(regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g'), chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, ls, unnest(generate_series(0, len(ls) - 2)) AS i FROM d)
SELECT count(*) AS n_scored, round(avg(levenshtein(ls[i + 1], ls[i + 2])), 6) AS avg_edit_distance FROM x""")
def q_a10_folded(spark, sf):
    """Each line against the next, characters beyond ASCII folded to one (the SQL engine counts bytes)."""
    d = table(spark, sf, "documents").select(F.split(F.regexp_replace("text", "[^\\x00-\\x7F]", "?"), "\n", -1).alias("ls"))
    pairs = d.where(F.size("ls") > 1).select(F.explode(F.arrays_zip(F.slice("ls", F.lit(1), F.size("ls") - 1).alias("a"), F.slice("ls", F.lit(2), F.size("ls")).alias("b"))).alias("p"))
    return evalmetrics.edit_distance(pairs.select("p.a", "p.b"), "a", "b")
