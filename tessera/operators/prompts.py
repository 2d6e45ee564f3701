"""Prompt and pair operators.

Parsing, validation, rendering and routing are column expressions.  The
two places that need more are:

* containment join (J8): needles are found in haystacks through winnowed
  k-gram fingerprints (content-defined, exact for needles of at least
  ``window + k - 1`` characters) — an equi-join on fingerprint hash plus a
  ``contains`` verification, never a cross join;
* chat history (P23): each turn is fanned out to the next ``k`` turns and
  regrouped on ``(conversation, turn)``, so no window ever spans a whole
  conversation.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.functions.hashing import keyed_pick
from tessera.functions.constants import PY_SPACE
from tessera.functions.text import col, first_match_label, lines, py_strip

RULE = "============"


# --- P1 / P2 ---------------------------------------------------------------------

def parse_prompt_file(content) -> dict[str, Column]:
    """(category, language, prompt) from a prompt file's text."""
    c = col(content)
    ls = F.split(py_strip(c), "\n", -1)
    category = py_strip(F.replace(F.element_at(ls, 1), F.lit("Category: "), F.lit("")))
    language = py_strip(F.replace(F.try_element_at(ls, F.lit(2)), F.lit("Language: "), F.lit("")))
    pos = F.locate(RULE, c)
    after_rule = F.element_at(F.split(F.substring(c, pos, F.length(c)), "\n", 3), -1)
    no_rule = F.array_join(F.slice(ls, 3, F.greatest(F.size(ls) - 2, F.lit(0))), "\n")
    prompt = py_strip(F.when(pos > 0, after_rule).otherwise(no_rule))
    return {"category": category, "language": language, "prompt": prompt}


def normalize_answer(content) -> Column:
    """P2."""
    return py_strip(col(content))


# --- P3 / P4 / P5 ------------------------------------------------------------------

def detect_code_language(text, patterns=K.CODE_LANGUAGE_PATTERNS) -> Column:
    """Ordered cascade of multiline regexes; first language with a hit."""
    rules = [(lang, [f"(?m){p}" for p in pats]) for lang, pats in patterns]
    return first_match_label(text, rules, "unknown", regex=True)


def validate_and_fix(category, language, prompt, patterns=K.CODE_LANGUAGE_PATTERNS) -> dict[str, Column]:
    """Relabel explanation prompts whose snippet is another language."""
    pat = "(?s)" + K.EXPLANATION_SNIPPET_PATTERN
    has = col(prompt).rlike(pat)
    snippet = py_strip(F.regexp_extract(col(prompt), pat, 1))
    detected = detect_code_language(snippet, patterns)
    fix = ((col(category) == "explanation") & (col(language) != "unknown") & has
           & (detected != "unknown") & (detected != col(language)))
    return {"language": F.when(fix, detected).otherwise(col(language)), "was_fixed": fix}


def language_mention(prompt, names=K.LANGUAGE_NAMES) -> Column:
    """P5: first name (in list order) occurring case-sensitively, lower-cased."""
    return first_match_label(prompt, [(n.lower(), [n]) for n in names], "unknown")


# --- P6 / M3 / J9 / J10: templates -------------------------------------------------

def fill_template(template, chosen) -> Column:
    """Replace ``{var}`` by the chosen option, variables in map order."""
    return F.aggregate(F.map_entries(col(chosen)), col(template),
                       lambda acc, e: F.replace(acc, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))


def choose_options(variables, seed: str, key) -> Column:
    """M3: per variable, a keyed uniform choice among its options."""
    v = col(variables)
    return F.map_from_entries(F.transform(F.map_entries(v), lambda e: F.struct(
        e["key"].alias("key"),
        F.element_at(e["value"], (F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), key.cast("string"), e["key"])), 1, 8), 16, 10).cast("bigint"),
                                         F.size(e["value"])) + 1).cast("int")).alias("value"))))


def expand_grid(templates: DataFrame, template: str = "template", variables: str = "variables") -> DataFrame:
    """Every option combination of a template (chained explode of
    its variable map; the output size is the product of option counts)."""
    out = templates.withColumn("_entries", F.map_entries(variables)).withColumn("_chosen", F.create_map())
    out = out.withColumn("_n", F.size("_entries"))
    max_vars = out.agg(F.max("_n")).first()[0] or 0  # scalar: the widest template
    for i in range(1, max_vars + 1):
        e = F.element_at("_entries", i)
        out = (out.withColumn("_opt", F.explode_outer(F.when(F.col("_n") >= i, e["value"]).otherwise(F.array(F.lit(None).cast("string")))))
               .withColumn("_chosen", F.when(F.col("_n") >= i, F.map_concat("_chosen", F.create_map(e["key"], F.col("_opt"))))
                           .otherwise(F.col("_chosen"))))
    return out.withColumn("prompt", fill_template(F.col(template), F.col("_chosen"))).drop("_entries", "_n", "_opt")


# --- P7 / P8 / P10 / P12 / P13 -----------------------------------------------------

def training_text(prompt, response) -> Column:
    """P7."""
    return F.concat(col(prompt), F.lit("\n\n"), col(response))


def format_answer(language, code, explanation, complexity, example_in, example_out, notes) -> Column:
    """Language line, fenced code, explanation/complexity/example/notes."""
    lang = F.lower(col(language))
    fence_tag = F.when(lang == "plaintext", F.lit("")).otherwise(lang)
    notes_lines = F.array_join(F.transform(col(notes), lambda n: F.concat(F.lit("- "), n)), "\n")
    body = F.concat(lang, F.lit("\n```"), fence_tag, F.lit("\n"), py_strip(code), F.lit("\n```\n**Explanation:** "),
                    col(explanation), F.lit(" **Complexity:** "), col(complexity), F.lit(" **Example:**\nInput: "),
                    col(example_in), F.lit("\nOutput: "), col(example_out), F.lit("\n**Notes:** "), notes_lines)
    # textwrap.dedent empties whitespace-only lines (common margin is '')
    return F.concat(py_strip(F.regexp_replace(body, r"(?md)^[ \t]+$", "")), F.lit("\n"))


def instruction_example(instruction, reasoning, code, explanation) -> Column:
    """P10: conversation-style rendering with role markers."""
    return F.format_string("<|instruction|>\n%s\n<|reasoning|>\n%s\n<|code|>\n%s\n<|explanation|>\n%s",
                           col(instruction), col(reasoning), col(code), col(explanation))


STRUCTURED_SCHEMA = ("reasoning string, code string, explanation string, "
                     "test_cases array<struct<input:string,output:string>>")


def parse_structured(raw) -> dict[str, Column]:
    """Parsed fields with defaults; ``parsed`` false keeps the raw text."""
    parsed = F.from_json(col(raw), STRUCTURED_SCHEMA, {"mode": "PERMISSIVE"})
    ok = F.try_parse_json(col(raw)).isNotNull()
    return {
        "parsed": ok,
        "reasoning": F.when(ok, F.coalesce(parsed["reasoning"], F.lit(""))),
        "code": F.when(ok, F.coalesce(parsed["code"], F.lit(""))),
        "explanation": F.when(ok, F.coalesce(parsed["explanation"], F.lit(""))),
        "test_cases": F.when(ok, F.coalesce(parsed["test_cases"], F.array().cast("array<struct<input:string,output:string>>"))),
        "response": F.when(~ok, col(raw)),
    }


def seed_tasks(df: DataFrame, code: str = "content", tasks=K.SEED_TASKS) -> DataFrame:
    """One code row -> one row per seed task with its prompt prefix."""
    arr = F.array(*[F.struct(F.lit(t).alias("task"), F.lit(p).alias("prefix")) for t, p in tasks])
    return (df.select("*", F.explode(arr).alias("_t"))
            .withColumn("task", F.col("_t.task"))
            .withColumn("prompt", F.concat(F.col("_t.prefix"), F.col(code))).drop("_t"))


def extract_completion(prompt, full_output, stops=K.STOP_SEQUENCES) -> Column:
    """Drop the prompt by length, cut at the earliest stop sequence."""
    tail = F.substring(col(full_output), F.length(col(prompt)) + 1, 1 << 30)
    pat = "(?s)(" + "|".join(_re_escape(s) for s in stops) + ").*$"
    return F.regexp_replace(tail, pat, "")


def _re_escape(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ("\\n" if ch == "\n" else ch) for ch in s)


# --- P9 routing --------------------------------------------------------------------

def route_answers(df: DataFrame, rules: DataFrame, prompt: str = "prompt", category: str = "category",
                  key: str = "id", placeholder: str = "placeholder", skip_marker: str = "# code snippet here") -> DataFrame:
    """First rule (by priority) of the row's category whose needle occurs
    in lower(prompt); ``placeholder`` when none; null for placeholder prompts.

    ``rules(category, priority, needle, template_id)`` is configuration: it
    becomes one chain of conditions, so rows are neither joined nor moved.
    """
    low = F.lower(F.col(prompt))
    chosen = F.lit(placeholder)
    ordered = sorted((tuple(r) for r in rules.select("priority", "needle", "category", "template_id").collect()), reverse=True)
    for _, needle, rule_category, template in ordered:
        chosen = F.when((F.col(category) == rule_category) & low.contains(needle), F.lit(template)).otherwise(chosen)
    return df.withColumn("template_id", F.when(low.contains(skip_marker), F.lit(None)).otherwise(chosen))


# --- P18 markup cleaning --------------------------------------------------------------

def html_blocks(html, block_tags=("p", "li"), drop_tags=("script", "style", "nav", "footer")) -> Column:
    """Text blocks of ``block_tags`` after removing ``drop_tags`` subtrees."""
    h = col(html)
    for t in drop_tags:
        h = F.regexp_replace(h, rf"(?is)<{t}\b[^>]*>.*?</{t}\s*>", " ")
    alt = "|".join(block_tags)
    raw = F.regexp_extract_all(h, F.lit(rf"(?is)<(?:{alt})\b[^>]*>(.*?)</(?:{alt})\s*>"), 1)
    cleaned = F.transform(raw, lambda b: F.trim(F.regexp_replace(F.regexp_replace(b, "<[^>]*>", ""), r"\s+", " ")))
    return F.filter(cleaned, lambda b: b != F.lit(""))


def code_blocks(text) -> Column:
    """Fenced and ``<pre><code>`` code blocks."""
    t = col(text)
    fenced = F.regexp_extract_all(t, F.lit(r"(?s)```[^\n]*\n(.*?)```"), 1)
    pre = F.regexp_extract_all(t, F.lit(r"(?is)<pre[^>]*>\s*<code[^>]*>(.*?)</code>\s*</pre>"), 1)
    return F.concat(fenced, pre)


# --- P19 repository context --------------------------------------------------------------

def file_piece(path, language, content) -> Column:
    return F.concat(F.lit(K.FILE_SEPARATOR + "\n# File: "), col(path), F.lit("\n<|lang_"), col(language),
                    F.lit("|>\n"), col(content), F.lit("\n"))


def repo_contexts(df: DataFrame, repo: str = "repo", path: str = "path", language: str = "language",
                  content: str = "content", max_chars: int = 200_000) -> DataFrame:
    """Files of a repo in path order, concatenated into contexts of
    about ``max_chars`` (a context starts a new file while its start offset
    is inside the window; one context holds at most ``max_chars`` + one file).

    The running offset is a distributed prefix scan, so a repo holding a
    third of all files is still split over many tasks; each collect is
    bounded by the context size.
    """
    from tessera.plans.prefix import prefix_scan
    pieces = df.select(repo, path, file_piece(F.col(path), F.col(language), F.col(content)).alias("piece"))
    pieces = pieces.withColumn("_len", F.length("piece"))
    scanned = prefix_scan(pieces, [repo], [path], "_len", "_end")
    scanned = scanned.withColumn("context_id", F.floor((F.col("_end") - F.col("_len")) / max_chars).cast("bigint"))
    return (scanned.groupBy(repo, "context_id")
            .agg(F.array_sort(F.collect_list(F.struct(F.col(path).alias("p"), F.col("piece").alias("s")))).alias("parts"),
                 F.count("*").alias("n_files"))
            .select(repo, "context_id", "n_files",
                    F.array_join(F.transform("parts", lambda x: x["s"]), "").alias("context")))


# --- P20 / P21 / P22 -------------------------------------------------------------------

def import_header(content) -> Column:
    """P20: leading ``import``/``from`` lines (stripped); blank and ``#``
    lines skipped; stops at the first other line."""
    ls = F.transform(lines(content), lambda l: py_strip(l))
    is_import = lambda l: l.startswith("import ") | l.startswith("from ")
    breaking = F.transform(ls, lambda l: ~(is_import(l) | (l == "") | l.startswith("#")))
    stop = F.array_position(breaking, True)
    head = F.when(stop > 0, F.slice(ls, 1, (stop - 1).cast("int"))).otherwise(ls)
    return F.filter(head, is_import)


def file_summary(content, max_lines: int = 50, prefixes=("def ", "class ")) -> Column:
    """Signature lines (``def``/``class``) within the first ``max_lines``
    (right-stripped), else the first ``max_lines`` lines verbatim."""
    ls = lines(content)
    n = F.size(ls)
    keep_nl = F.transform(ls, lambda l, i: F.when(i < n - 1, F.concat(l, F.lit("\n"))).otherwise(l))
    keep_nl = F.filter(keep_nl, lambda l: l != F.lit(""))  # readlines(): no empty last line
    head = F.slice(keep_nl, 1, max_lines)
    sig = F.filter(head, lambda l: _starts_any(py_strip(l), prefixes))
    sig = F.transform(sig, lambda l: F.regexp_replace(l, f"[{PY_SPACE} ]+$", ""))
    return F.when(F.size(sig) > 0, F.array_join(sig, "\n")).otherwise(F.array_join(head, ""))


def _starts_any(c: Column, prefixes) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


def related_files(files: DataFrame, current: DataFrame, k: int = 5, use: int = 3,
                  stems=("utils", "helpers", "config", "base")) -> DataFrame:
    """Same-directory ``.py`` files first (path order), then files named
    ``utils/helpers/config/base.py`` anywhere in the project; cap ``k``,
    use the first ``use``.  ``files(project, path)``, ``current(project, path)``.

    No pairs inside a directory or project: only the first ``k + 1``
    candidates of each directory and the first ``k`` named files of each
    project survive (skew-safe row numbers), so every current file joins a
    bounded list.
    """
    from pyspark.sql import Window

    from tessera.plans.prefix import row_numbers
    f = (files.select("project", F.col("path").alias("cand"))
         .withColumn("cand_dir", F.regexp_extract("cand", r"^(.*)/[^/]*$", 1))
         .withColumn("cand_stem", F.regexp_extract("cand", r"([^/]*)\.py$", 1)))
    cur = current.select("project", F.col("path").alias("current")).withColumn(
        "cur_dir", F.regexp_extract("current", r"^(.*)/[^/]*$", 1))
    first_in_dir = row_numbers(f.where(F.col("cand").endswith(".py")), ["project", "cand_dir"], ["cand"], "_r")
    first_in_dir = first_in_dir.where(F.col("_r") <= k + 1)  # k others even when current is among them
    same = (cur.join(first_in_dir, (cur.project == first_in_dir.project) & (cur.cur_dir == first_in_dir.cand_dir))
            .where(F.col("cand") != F.col("current"))
            .select(cur.project, "current", "cand", F.lit(0).alias("tier")))
    named_ranked = row_numbers(f.where(F.col("cand_stem").isin(list(stems))), ["project"], ["cand"], "_r")
    named = (cur.join(named_ranked.where(F.col("_r") <= k + 1), "project")
             .select("project", "current", "cand", F.lit(1).alias("tier")))
    both = same.unionByName(named).groupBy("project", "current", "cand").agg(F.min("tier").alias("tier"))
    # at most 2(k+1) rows per current file: this window is bounded
    w = Window.partitionBy("project", "current").orderBy("tier", "cand")
    ranked = both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.withColumn("used", F.col("rank") <= use)


# --- P23 chat history ---------------------------------------------------------------------

def chat_prompts(conv: DataFrame, history: int = 5, system: str = "You are a helpful coding assistant.\n") -> DataFrame:
    """For every user turn, answered or pending, the prompt built from the
    previous ``history`` completed exchanges and the current input.

    ``conv(conv_id, turn, role, text)``; an exchange is a user row followed
    by an assistant row.  Exchanges fan out to the next ``history`` user
    turns they precede (bounded copies) and regroup on ``(conv_id, turn)``.
    """
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("user"))
    a = conv.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                           F.col("text").alias("assistant"))
    asked = u.join(a, ["conv_id", "turn"], "left").withColumn("done", F.col("assistant").isNotNull().cast("int"))
    # a turn's target: one more than the exchanges completed before it
    from tessera.plans.prefix import prefix_scan
    asked = prefix_scan(asked, ["conv_id"], ["turn"], "done", "so_far").withColumn("target", F.col("so_far") - F.col("done") + 1)
    ex = asked.where("done = 1").withColumnRenamed("target", "ex_idx")
    hist = ex.select("conv_id", F.col("ex_idx").alias("src"), "user", "assistant",
                     F.explode(F.sequence(F.col("ex_idx") + 1, F.col("ex_idx") + history)).alias("target"))
    grouped = hist.groupBy("conv_id", "target").agg(
        F.array_sort(F.collect_list(F.struct("src", "user", "assistant"))).alias("h"))
    cur = asked.select("conv_id", "turn", "target", F.col("user").alias("current"))
    j = cur.join(grouped, ["conv_id", "target"], "left")
    parts = F.transform(F.coalesce(F.col("h"), F.array()), lambda x: F.concat(
        F.lit("User: "), x["user"], F.lit("\n\nAssistant: "), x["assistant"]))
    prompt = F.array_join(F.concat(F.array(F.lit(system)), parts,
                                   F.array(F.concat(F.lit("User: "), F.col("current")), F.lit("Assistant:"))), "\n\n")
    return j.select("conv_id", "turn", F.col("target").alias("exchange"), prompt.alias("prompt"))


# --- J8 containment join --------------------------------------------------------------------

def _winnow(k: int, window: int, first_only: bool):
    base = np.uint64(1000003)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def fp(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            if t is None:
                out.append([])
                continue
            cp = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
            n = len(cp) - k + 1
            if n <= 0:
                out.append([])
                continue
            h = np.zeros(n, dtype=np.uint64)
            with np.errstate(over="ignore"):
                for j in range(k):
                    h = h * base + cp[j:j + n] + np.uint64(1)
                h ^= h >> np.uint64(29)
                h *= np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(32)
            h = (h >> np.uint64(1)).astype(np.int64)
            if n < window:
                out.append([] if first_only else [])
                continue
            wins = np.lib.stride_tricks.sliding_window_view(h, window)
            if first_only:
                out.append([int(wins[0].min())])
                continue
            # rightmost minimum of each window
            arg = window - 1 - np.argmin(wins[:, ::-1], axis=1)
            pos = np.unique(np.arange(len(wins)) + arg)
            out.append(np.unique(h[pos]).tolist())
        return pd.Series(out)
    return fp


NEEDLE_BYTES = 4 << 20  # of short needles that one pass over the haystacks looks for
FIRST_CANDIDATES = 8    # texts a needle is looked up in at first; four times as many each further round


def containment_join(needles: DataFrame, haystacks: DataFrame, needle_text: str, hay_text: str,
                     needle_key: str, hay_key: str, scope=(), k: int = 16, window: int = 32) -> DataFrame:
    """For each needle, the smallest haystack key whose text contains the
    (stripped) needle, within ``scope``; null when none.

    Needles of at least ``k + window - 1`` characters: winnowing guarantees that
    every window of ``window`` consecutive k-grams of a needle lies inside each
    occurrence, and the haystack selects that window's minimum too, so any
    fingerprint that the needle selects is an exact join key (the rarest one in
    the haystack index is used).  Texts are looked up in ascending key order, a
    few a needle and round, until one holds the needle: a common anchor
    brings no more texts than that.  Shorter needles are searched for directly:
    each pass over the haystacks carries an automaton of at most ``NEEDLE_BYTES``
    of them, so one very short needle changes nothing for the others.  Empty
    needles match everything; null ones, and null scopes, nothing.
    """
    from tessera.session import stage
    scope = list(scope)
    added = not scope
    if added:  # one constant scope keeps every join an equi-join
        needles, haystacks, scope = needles.withColumn("_scope", F.lit(0)), haystacks.withColumn("_scope", F.lit(0)), ["_scope"]
    nd = needles.select(needle_key, *scope, py_strip(F.col(needle_text)).alias("_needle")).dropna(subset=scope)
    hay = haystacks.select(hay_key, *scope, F.col(hay_text).alias("_hay")).dropna(subset=scope)
    limit = k + window - 1
    long_n = nd.where(F.length("_needle") >= limit)
    pairs = stage(_candidates(long_n, hay, needle_key, hay_key, scope, k, window).distinct(), "j8-candidates")
    first = _first_holder(pairs, long_n, hay, needle_key, hay_key)
    first = first.unionByName(_search_short(nd.where((F.length("_needle") < limit) & (F.length("_needle") > 0)), hay, needle_key, hay_key, scope))
    empty = nd.where(F.length("_needle") == 0)
    if not empty.isEmpty():  # '' is contained in every haystack of its scope
        first_in_scope = hay.where(F.col("_hay").isNotNull()).groupBy(*scope).agg(F.min(hay_key).alias("match_" + hay_key))
        first = first.unionByName(empty.join(first_in_scope, scope).select(needle_key, "match_" + hay_key))
    out = needles.join(first, needle_key, "left")
    return out.drop("_scope") if added else out


def _first_holder(pairs: DataFrame, nd: DataFrame, hay: DataFrame, needle_key: str, hay_key: str) -> DataFrame:
    """The least candidate of each needle that holds it, in rounds of ever more candidates."""
    from tessera.session import stage
    found, width = [], FIRST_CANDIDATES
    order = Window.partitionBy(needle_key).orderBy(hay_key)  # the planner limits it before the shuffle
    while not pairs.isEmpty():
        now = stage(pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= width).drop("_r"), "j8-round")
        held = now.join(nd.select(needle_key, "_needle"), needle_key).join(hay.select(hay_key, "_hay"), hay_key).where(F.col("_hay").contains(F.col("_needle")))
        found.append(stage(held.groupBy(needle_key).agg(F.min(hay_key).alias("match_" + hay_key)), "j8-found"))
        seen = now.groupBy(needle_key).agg(F.max(hay_key).alias("_last"))
        rest = pairs.join(found[-1].select(needle_key), needle_key, "left_anti").join(seen, needle_key).where(F.col(hay_key) > F.col("_last"))
        pairs, width = stage(rest.drop("_last"), "j8-rest"), width * 4
    if not found:
        return pairs.select(needle_key, F.col(hay_key).alias("match_" + hay_key))
    return functools.reduce(DataFrame.unionByName, found)


def _search_short(nd: DataFrame, hay: DataFrame, needle_key: str, hay_key: str, scope) -> DataFrame:
    """Least haystack key for each short needle, by one pass a chunk of needles."""
    from tessera.plans.prefix import prefix_scan
    spark = nd.sparkSession
    named = nd.groupBy(*scope, "_needle").agg(F.count("*").alias("_n"))
    size = (F.length(F.encode("_needle", "utf-8")) + 16).cast("long")
    placed = prefix_scan(named.withColumn("_size", size), [], [*scope, "_needle"], "_size", "_until")
    chunked = placed.withColumn("_chunk", F.floor((F.col("_until") - F.col("_size")) / NEEDLE_BYTES)).select("_chunk", *scope, "_needle")
    chunks = chunked.agg(F.max("_chunk")).first()[0]
    out = spark.createDataFrame([], T.StructType([*[nd.schema[c] for c in scope], nd.schema["_needle"], T.StructField("_key", hay.schema[hay_key].dataType)]))
    for chunk in range(0 if chunks is None else chunks + 1):
        rows = chunked.where(F.col("_chunk") == chunk).collect()  # NEEDLE_BYTES at most
        wanted = spark.sparkContext.broadcast([(tuple(r[c] for c in scope), r["_needle"]) for r in rows])

        def search(batches):
            import ahocorasick
            automata, tiny, best = {}, {}, {}
            for s, needle in wanted.value:
                if len(needle) < 4:  # these would match almost everywhere
                    tiny.setdefault(s, []).append(needle)
                else:
                    automata.setdefault(s, ahocorasick.Automaton()).add_word(needle, needle)
            for a in automata.values():
                a.make_automaton()
            for pdf in batches:
                pdf = pdf.sort_values(hay_key)
                for s, key, text in zip(zip(*[pdf[c] for c in scope]), pdf[hay_key].tolist(), pdf["_hay"]):
                    held = {x for _, x in automata[s].iter(text)} if s in automata else set()
                    held.update(x for x in tiny.get(s, ()) if ((s, x) not in best or key < best[s, x]) and x in text)
                    for x in held:
                        if (s, x) not in best or key < best[s, x]:
                            best[s, x] = key
            yield pd.DataFrame([(*s, x, key) for (s, x), key in best.items()], columns=[*scope, "_needle", "_key"])

        texts = hay.where(F.col("_hay").isNotNull() & F.col(hay_key).isNotNull()).select(*scope, hay_key, "_hay")
        out = out.unionByName(texts.mapInPandas(search, out.schema))
    least = out.groupBy(*scope, "_needle").agg(F.min("_key").alias("match_" + hay_key))
    return nd.join(least, [*scope, "_needle"]).select(needle_key, "match_" + hay_key)


def _candidates(nd, hay, needle_key, hay_key, scope, k, window):
    """Candidate (needle, haystack) pairs through one anchor per needle.

    Every fingerprint the needle's own winnowing selects lies in a window
    fully inside the needle, so each one is an exact anchor; the rarest in
    the haystack index is chosen (a boilerplate k-gram would otherwise pull
    in every document that shares it).  Counting fingerprints is a partial
    aggregate; the anchor choice is a ``min_by`` per needle."""
    from tessera.session import cut_lineage
    needle_fp = cut_lineage(nd.select(needle_key, *scope, F.explode(_winnow(k, window, False)(F.col("_needle"))).alias("fp")))
    hay_all = hay.select(hay_key, *scope, F.explode(_winnow(k, window, False)(F.col("_hay"))).alias("fp"))
    # only haystack fingerprints some needle has: materialised once, so the
    # haystack UDF runs a single time for both the counts and the join
    hay_fp = cut_lineage(hay_all.join(needle_fp.select("fp", *scope).distinct(), ["fp", *scope], "left_semi")
                         .dropDuplicates([hay_key, *scope, "fp"]))
    counts = hay_fp.groupBy("fp", *scope).agg(F.count("*").alias("df"))
    scored = needle_fp.join(counts, ["fp", *scope], "left").withColumn("df", F.coalesce("df", F.lit(0)))
    anchors = scored.groupBy(needle_key, *scope).agg(F.min_by("fp", F.struct("df", "fp")).alias("fp"))
    return anchors.join(hay_fp, ["fp", *scope]).select(needle_key, hay_key)


# --- M3 seeded generation ---------------------------------------------------------------------

def generate_prompts(ids: DataFrame, templates: DataFrame, id_col: str = "id", seed: str = "prompts") -> DataFrame:
    """M3: per id, a keyed uniform template (by index) and keyed option per
    variable.  ``templates(t_idx, category, template, variables)`` is
    configuration."""
    n_t = templates.count()
    picked = ids.withColumn("t_idx", keyed_pick(seed + ":template", n_t, id_col))
    j = picked.join(templates, "t_idx")
    chosen = choose_options(F.col("variables"), seed + ":option", F.col(id_col))
    return j.withColumn("prompt", fill_template(F.col("template"), chosen))
