"""Prompt / pair path queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.hashing import sql_u32
from tessera.operators import prompts as P
from tessera.plans.adapters import SQL_PAIRS, prompt_response_pairs, table
from tessera.plans.registry import register

PYS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "text")


# --- P3: reference cascade on the corpus -------------------------------------------

def _p3_sql() -> str:
    whens = []
    for lang, pats in K.CODE_LANGUAGE_PATTERNS:
        cond = " OR ".join(f"regexp_matches(text, '(?m){p}')" for p in pats)
        whens.append(f"WHEN {cond} THEN '{lang}'")
    return f"SELECT doc_id, CASE {' '.join(whens)} ELSE 'unknown' END AS detected FROM documents"


@register("p3_detect_code_language", _p3_sql())
def q_p3(spark, sf):
    return _docs(spark, sf).select("doc_id", P.detect_code_language(F.col("text")).alias("detected"))


# --- P5: ordered case-sensitive mention; names that occur in the driver prose ----
_P5_NAMES = ["Python", "Die ", "Les ", "The ", "Los ", "Go"]


@register("p5_language_mention", "SELECT doc_id, CASE " + " ".join(
    f"WHEN contains(text, '{n}') THEN '{n.lower()}'" for n in _P5_NAMES) + " ELSE 'unknown' END AS mentioned FROM documents")
def q_p5(spark, sf):
    return _docs(spark, sf).select("doc_id", P.language_mention(F.col("text"), _P5_NAMES).alias("mentioned"))


# --- P7 / P10 ---------------------------------------------------------------------

@register("p7_training_text", f"""
WITH p AS ({SQL_PAIRS})
SELECT conv_id, turn, md5(prompt || chr(10) || chr(10) || response) AS text_md5,
       length(prompt || chr(10) || chr(10) || response) AS n_chars FROM p""")
def q_p7(spark, sf):
    t = P.training_text(F.col("prompt"), F.col("response"))
    return prompt_response_pairs(spark, sf).select("conv_id", "turn", F.md5(t).alias("text_md5"), F.length(t).alias("n_chars"))


@register("p10_instruction_example", f"""
WITH p AS ({SQL_PAIRS})
SELECT conv_id, turn, md5(printf('<|instruction|>\n%s\n<|reasoning|>\n%s\n<|code|>\n%s\n<|explanation|>\n%s',
                                 prompt, category, response, language)) AS text_md5 FROM p""")
def q_p10(spark, sf):
    t = P.instruction_example(F.col("prompt"), F.col("category"), F.col("response"), F.col("language"))
    return prompt_response_pairs(spark, sf).select("conv_id", "turn", F.md5(t).alias("text_md5"))


# --- P8 structured answer --------------------------------------------------------------

@register("p8_format_answer", f"""
WITH d AS (SELECT doc_id, lang, source, text, n_chars, string_split(text, chr(10))[1] AS first_line FROM documents),
b AS (SELECT doc_id, lower(lang) || chr(10) || '```' || CASE WHEN lower(lang) = 'plaintext' THEN '' ELSE lower(lang) END || chr(10)
        || regexp_replace(text, '^[{PYS} ]+|[{PYS} ]+$', '', 'g') || chr(10) || '```' || chr(10) || '**Explanation:** ' || first_line
        || ' **Complexity:** O(n) **Example:**' || chr(10) || 'Input: ' || source || chr(10) || 'Output: ' || CAST(n_chars AS VARCHAR)
        || chr(10) || '**Notes:** ' || array_to_string(list_transform(string_split(first_line, ' ')[1:3], lambda x: '- ' || x), chr(10)) AS body
      FROM d)
SELECT doc_id, md5(regexp_replace(regexp_replace(body, '(?m)^[ \\t]+$', '', 'g'), '^[{PYS} ]+|[{PYS} ]+$', '', 'g') || chr(10)) AS answer_md5 FROM b""")
def q_p8(spark, sf):
    d = table(spark, sf, "documents")
    first = F.element_at(F.split("text", "\n", -1), 1)
    ans = P.format_answer(F.col("lang"), F.col("text"), first, F.lit("O(n)"), F.col("source"),
                          F.col("n_chars").cast("string"), F.slice(F.split(first, " ", -1), 1, 3))
    return d.select("doc_id", F.md5(ans).alias("answer_md5"))


# --- P9 routing ------------------------------------------------------------------------
_RULES = [("en", 1, "the", "tpl_the"), ("en", 2, "and", "tpl_and"), ("de", 1, "und", "tpl_und"),
          ("de", 2, "die", "tpl_die"), ("fr", 1, "les", "tpl_les"), ("es", 1, "los", "tpl_los"),
          ("es", 2, "el", "tpl_el")]


@register("p9_route_answers", f"""
WITH r AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {p}, '{n}', '{t}')" for c, p, n, t in _RULES)}) v(category, priority, needle, template_id)),
h AS (SELECT d.doc_id, min_by(r.template_id, (r.priority, r.needle)) AS template_id
      FROM documents d JOIN r ON r.category = d.lang WHERE contains(lower(d.text), r.needle) GROUP BY d.doc_id)
SELECT d.doc_id, CASE WHEN contains(lower(d.text), '# code snippet here') THEN NULL ELSE coalesce(h.template_id, 'placeholder') END AS template_id
FROM documents d LEFT JOIN h ON d.doc_id = h.doc_id""")
def q_p9(spark, sf):
    rules = spark.createDataFrame(_RULES, "category string, priority int, needle string, template_id string")
    d = _docs(spark, sf).select(F.col("doc_id"), F.col("lang").alias("category"), F.col("text").alias("prompt"))
    return P.route_answers(d, rules, key="doc_id").select("doc_id", "template_id")


# --- P11 parse ------------------------------------------------------------------------

@register("p11_parse_structured", """
SELECT event_id, json_valid(props) AS parsed, coalesce(json_extract_string(props, '$.reasoning'), '') AS reasoning,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""")
def q_p11(spark, sf):
    e = table(spark, sf, "events").select("event_id", "props")
    c = P.parse_structured(F.col("props"))
    return e.select("event_id", c["parsed"].alias("parsed"), c["reasoning"].alias("reasoning"),
                    F.from_json("props", "k int")["k"].alias("k"))


# --- P12 / P13 ---------------------------------------------------------------------------

@register("p12_seed_tasks", "SELECT doc_id, task, md5(prefix || text) AS prompt_md5 FROM documents, (VALUES " + ", ".join(
    "('{}', '{}')".format(t, p.replace("\n", "' || chr(10) || '")) for t, p in K.SEED_TASKS) + ") v(task, prefix)")
def q_p12(spark, sf):
    return P.seed_tasks(_docs(spark, sf), "text").select("doc_id", "task", F.md5("prompt").alias("prompt_md5"))


@register("p13_completion_extract", """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10))[1] AS prompt FROM documents)
SELECT doc_id, regexp_replace(substring(text, length(prompt) + 1), '(?s)(\\nclass |\\ndef |\\n#|\\nif __name__).*$', '') AS completion FROM d""")
def q_p13(spark, sf):
    d = _docs(spark, sf).withColumn("prompt", F.element_at(F.split("text", "\n", -1), 1))
    return d.select("doc_id", P.extract_completion(F.col("prompt"), F.col("text")).alias("completion"))


# --- P18 pages -----------------------------------------------------------------------------

@register("p18_html_blocks", """
WITH c AS (SELECT page_id,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<script\\b[^>]*>.*?</script\\s*>', ' ', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', ' ', 'g'),
    '(?is)<nav\\b[^>]*>.*?</nav\\s*>', ' ', 'g'), '(?is)<footer\\b[^>]*>.*?</footer\\s*>', ' ', 'g') AS h FROM pages),
b AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(h, '(?is)<(?:p|li)\\b[^>]*>(.*?)</(?:p|li)\\s*>', 1),
        lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM c)
SELECT page_id, len(blocks) AS n_blocks, md5(array_to_string(blocks, chr(10))) AS blocks_md5 FROM b""")
def q_p18(spark, sf):
    b = P.html_blocks(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.size(b).alias("n_blocks"),
                                            F.md5(F.array_join(b, "\n")).alias("blocks_md5"))


# --- P19 repo contexts --------------------------------------------------------------------

@register("p19_repo_context", """
WITH f AS (SELECT source AS repo, CAST(doc_id AS VARCHAR) AS path,
           '<|file_separator|>' || chr(10) || '# File: ' || CAST(doc_id AS VARCHAR) || chr(10) || '<|lang_' || lang || '|>' || chr(10) || text || chr(10) AS piece
           FROM documents),
s AS (SELECT *, sum(length(piece)) OVER (PARTITION BY repo ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e FROM f),
c AS (SELECT *, CAST(floor((e - length(piece)) / 50000) AS BIGINT) AS context_id FROM s)
SELECT repo, context_id, count(*) AS n_files, md5(string_agg(piece, '' ORDER BY path)) AS context_md5 FROM c GROUP BY repo, context_id""")
def q_p19(spark, sf):
    d = _docs(spark, sf).select(F.col("source").alias("repo"), F.col("doc_id").cast("string").alias("path"),
                                F.col("lang").alias("language"), F.col("text").alias("content"))
    ctx = P.repo_contexts(d, max_chars=50_000)
    return ctx.select("repo", "context_id", "n_files", F.md5("context").alias("context_md5"))


# --- P21 summary ----------------------------------------------------------------------------

@register("p21_file_summary", f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
k AS (SELECT doc_id, list_filter(list_transform(ls, lambda x, i: CASE WHEN i < len(ls) THEN x || chr(10) ELSE x END), lambda x: x <> '')[1:50] AS head FROM l),
s AS (SELECT doc_id, head, list_transform(list_filter(head, lambda x: regexp_replace(x, '^[{PYS} ]+|[{PYS} ]+$', '', 'g') LIKE 'def %'
        OR regexp_replace(x, '^[{PYS} ]+|[{PYS} ]+$', '', 'g') LIKE 'class %'), lambda x: regexp_replace(x, '[{PYS} ]+$', '')) AS sig FROM k)
SELECT doc_id, md5(CASE WHEN len(sig) > 0 THEN array_to_string(sig, chr(10)) ELSE array_to_string(head, '') END) AS summary_md5 FROM s""")
def q_p21(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(P.file_summary(F.col("text"))).alias("summary_md5"))


# --- P23 chat prompts ---------------------------------------------------------------------------

@register("p23_chat_prompts", """
WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant'),
ex AS (SELECT u.conv_id, u.turn, u.text AS usr, a.text AS asst FROM u LEFT JOIN a USING (conv_id, turn)),
h AS (SELECT conv_id, turn, usr,
        list_filter(list('User: ' || usr || chr(10) || chr(10) || 'Assistant: ' || asst) OVER w, lambda x: x IS NOT NULL)[-5:] AS hist,
        count(asst) OVER w + 1 AS exchange FROM ex
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id, turn, exchange, md5(array_to_string(list_concat(['You are a helpful coding assistant.' || chr(10)], coalesce(hist, []),
       ['User: ' || usr, 'Assistant:']), chr(10) || chr(10))) AS prompt_md5 FROM h""")
def q_p23(spark, sf):
    c = P.chat_prompts(table(spark, sf, "conversations"))
    return c.select("conv_id", "turn", "exchange", F.md5("prompt").alias("prompt_md5"))


# --- J8 containment --------------------------------------------------------------------------------

@register("j8_benchmark_containment", """
WITH m AS (SELECT b.item_id, min(d.doc_id) AS match_doc_id FROM benchmark b JOIN documents d
             ON contains(d.text, regexp_replace(b.text, '^[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F}\\x{85}\\p{Z} ]+|[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F}\\x{85}\\p{Z} ]+$', '', 'g'))
           GROUP BY b.item_id),
j AS (SELECT b.item_id, m.match_doc_id FROM benchmark b LEFT JOIN m USING (item_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY match_doc_id IS NULL ORDER BY item_id) AS k FROM j)
SELECT item_id, coalesce(match_doc_id, -1) AS match_doc_id, CASE WHEN match_doc_id IS NOT NULL THEN 'doc_' || CAST(match_doc_id AS VARCHAR)
       ELSE printf('%03d_%s', k, 'text') END AS file_name FROM r""")
def q_j8(spark, sf):
    from tessera.plans.prefix import row_numbers
    b = table(spark, sf, "benchmark")
    d = table(spark, sf, "documents").select("doc_id", "text")
    # one row per needle, read three times below: materialise it once
    from tessera.session import cut_lineage
    m = cut_lineage(P.containment_join(b, d, "text", "text", "item_id", "doc_id").select("item_id", "match_doc_id"))
    unmatched = row_numbers(m.where(F.col("match_doc_id").isNull()), [], ["item_id"], "k")
    matched = m.where(F.col("match_doc_id").isNotNull()).withColumn("k", F.lit(None).cast("bigint"))
    allm = matched.unionByName(unmatched)
    # -1 = no haystack contains the needle (keeps the column non-null)
    return allm.select("item_id", F.coalesce("match_doc_id", F.lit(-1)).alias("match_doc_id"), F.when(F.col("match_doc_id").isNotNull(),
                       F.concat(F.lit("doc_"), F.col("match_doc_id").cast("string")))
                       .otherwise(F.format_string("%03d_%s", F.col("k"), F.lit("text"))).alias("file_name"))


# --- J9 / J10 template grid; M3 generation -------------------------------------------------------

_GRID_TEMPLATE = "Describe the {segment} market in {nation}."


@register("j9_template_grid", f"""
WITH rn AS (SELECT r.r_name, n.n_nationkey, n.n_name FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey),
seg AS (SELECT DISTINCT rn.r_name, c.c_mktsegment FROM customer c JOIN rn ON c.c_nationkey = rn.n_nationkey),
nat AS (SELECT DISTINCT r_name, n_name FROM rn)
SELECT seg.r_name, replace(replace('{_GRID_TEMPLATE}', '{{segment}}', seg.c_mktsegment), '{{nation}}', nat.n_name) AS prompt
FROM seg JOIN nat ON seg.r_name = nat.r_name""")
def q_j9(spark, sf):
    r = table(spark, sf, "region")
    n = table(spark, sf, "nation")
    c = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    rn = n.join(r, n.n_regionkey == r.r_regionkey).select("r_name", "n_nationkey", "n_name")
    seg = (c.join(rn, c.c_nationkey == rn.n_nationkey).groupBy("r_name")
           .agg(F.array_sort(F.collect_set("c_mktsegment")).alias("segment")))  # bounded: segment domain
    nat = rn.groupBy("r_name").agg(F.array_sort(F.collect_set("n_name")).alias("nation"))  # bounded: nations
    t = seg.join(nat, "r_name").select("r_name", F.lit(_GRID_TEMPLATE).alias("template"),
                                       F.create_map(F.lit("segment"), F.col("segment"), F.lit("nation"), F.col("nation")).alias("variables"))
    return P.expand_grid(t).select("r_name", "prompt")


_M3_TEMPLATES = [
    (0, "function_implementation", "In {language}, give code that {task}.",
     {"language": ["Python", "JavaScript", "Go"], "task": ["sorts a list", "parses a date", "merges two maps"]}),
    (1, "algorithm", "Implement {algorithm} in {language} with {constraint}.",
     {"algorithm": ["binary search", "quicksort", "Dijkstra"], "language": ["Python", "Rust"],
      "constraint": ["O(1) extra space", "recursion", "iteration"]}),
    (2, "explanation", "Explain how {concept} works.", {"concept": ["a hash map", "a closure", "garbage collection", "a mutex"]}),
]


def _m3_sql() -> str:
    parts = []
    for idx, cat, tpl, vars_ in _M3_TEMPLATES:
        expr = f"'{tpl}'"
        for v, opts in vars_.items():
            arr = "[" + ", ".join(f"'{o}'" for o in opts) + "]"
            pick = (f"{arr}[CAST(('0x' || substr(md5(concat_ws(':', 'prompts:option', CAST(c_custkey AS VARCHAR), '{v}')), 1, 8)) AS BIGINT)"
                    f" % {len(opts)} + 1]")
            expr = f"replace({expr}, '{{{v}}}', {pick})"
        parts.append(f"WHEN {idx} THEN {expr}")
    cats = "CASE t_idx " + " ".join(f"WHEN {i} THEN '{c}'" for i, c, _, _ in _M3_TEMPLATES) + " END"
    return (f"WITH c AS (SELECT c_custkey, {sql_u32('prompts:template', 'c_custkey')} % {len(_M3_TEMPLATES)} AS t_idx FROM customer)\n"
            f"SELECT c_custkey, t_idx, {cats} AS category, CASE t_idx {' '.join(parts)} END AS prompt FROM c")


@register("m3_seeded_prompts", _m3_sql())
def q_m3(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("t_idx", T.LongType()), T.StructField("category", T.StringType()),
                           T.StructField("template", T.StringType()),
                           T.StructField("variables", T.MapType(T.StringType(), T.ArrayType(T.StringType())))])
    templates = spark.createDataFrame(_M3_TEMPLATES, schema)
    ids = table(spark, sf, "customer").select("c_custkey")
    return P.generate_prompts(ids, templates, "c_custkey").select("c_custkey", "t_idx", "category", "prompt")
