"""Evaluation aggregates.

All metrics are two-level aggregations (per task / pair, then overall)
composed from built-ins; no UDAF.  Per-group "best" rows use ``max_by`` /
``min_by`` aggregates (partial aggregation; no window over a hot group).
"""

from __future__ import annotations

from collections import Counter
from itertools import zip_longest

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.text import col, py_strip


# --- A5 / A6 pass@k ---------------------------------------------------------------

def pass_at_k_column(n, c, k) -> Column:
    """Unbiased estimator 1 - C(n-c, k)/C(n, k) as a product of ``k`` doubles,
    prod_{i<k} (n-c-i)/(n-i), whatever n and c are; 1 when n-c < k; 0 when c = 0."""
    n, c, k = col(n), col(c), col(k)
    prod = F.aggregate(F.sequence(F.lit(0).cast("long"), k.cast("long") - 1), F.lit(1.0), lambda a, i: a * ((n - c - i) / (n - i)))
    return F.when(c == 0, F.lit(0.0)).when(n - c < k, F.lit(1.0)).otherwise(F.lit(1.0) - prod)


def pass_at_k(verdicts: DataFrame, ks=K.PASS_AT_K, task: str = "task_id", passed: str = "passed",
              group_cols=(), digits: int | None = 6) -> DataFrame:
    """Macro mean over tasks with n >= k; 0 when none.  All k in one pass:
    each per-task row is exploded over the (literal) k list — no join."""
    group_cols = list(group_cols)
    per_task = verdicts.groupBy(*group_cols, task).agg(F.count("*").alias("n"), F.count_if(F.col(passed)).alias("c"))
    kk = per_task.select("*", F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k")).where(F.col("n") >= F.col("k"))
    scored = kk.withColumn("p", pass_at_k_column("n", "c", "k"))
    agg = scored.groupBy(*group_cols, "k").agg(F.avg("p").alias("pass_at_k"), F.count("*").alias("n_tasks"))
    # ks with no eligible task still report 0 (reference: 0.0 when total == 0)
    all_k = per_task.select(*group_cols).distinct().select(*group_cols, F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k"))
    out = all_k.join(agg, [*group_cols, "k"], "left")
    val = F.coalesce("pass_at_k", F.lit(0.0))
    return out.select(*group_cols, "k", (F.round(val, digits) if digits is not None else val).alias("pass_at_k"),
                      F.coalesce("n_tasks", F.lit(0)).cast("bigint").alias("n_tasks"))


# --- A7 / A13 ------------------------------------------------------------------------

def task_accuracy(tests: DataFrame, task: str = "task_id", passed: str = "passed", group_cols=(),
                  task_groups: DataFrame | None = None) -> DataFrame:
    """A task passes iff all its tests pass; mean per group.

    Groups that are a property of the task (``task_groups``: task -> group
    columns) are joined *after* the per-task aggregate, so the join sees one
    row per task instead of one per test."""
    per_task = tests.groupBy(*([] if task_groups is not None else group_cols), task).agg(
        F.bool_and(passed).alias("task_passed"))
    if task_groups is not None:
        per_task = per_task.join(task_groups, task)
    return per_task.groupBy(*group_cols).agg(F.count("*").alias("n_tasks"),
                                             F.round(F.avg(F.col("task_passed").cast("double")), 6).alias("accuracy"))


def zero_pass_tasks(tests: DataFrame, task: str = "task_id", passed: str = "passed") -> DataFrame:
    return tests.groupBy(task).agg(F.count("*").alias("n"), F.count_if(F.col(passed)).alias("c")).where("c = 0")


# --- A8 ------------------------------------------------------------------------------

def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    t, p = F.col(truth), F.col(predicted)
    c = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
               F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    c = c.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return c.withColumn("f1", F.round(f1, 6)).withColumn("precision", F.round("precision", 6)).withColumn("recall", F.round("recall", 6))


def mentions_any(text, word_list=K.BUG_WORDS) -> Column:
    lo = F.lower(col(text))
    out = F.lit(False)
    for w in word_list:
        out = out | lo.contains(w)
    return out


# --- A9 ------------------------------------------------------------------------------

def judge_scores(df: DataFrame, text: str, group_cols=()) -> DataFrame:
    s = F.trim(F.col(text)).try_cast("double")
    return df.groupBy(*group_cols).agg(F.round(F.avg(s), 6).alias("mean_score"), F.count(s).alias("n_numeric"),
                                       F.count_if(s.isNull()).alias("n_non_numeric"))


# --- A10 ----------------------------------------------------------------------------

def completion_match(df: DataFrame, prediction: str, target: str, group_cols=()) -> DataFrame:
    """Exact (stripped) match and prefix match of the prediction's first line
    (an empty prediction is not a prefix match); the denominator is the
    number of scored rows."""
    pred, tgt = F.col(prediction), F.col(target)
    first = F.element_at(F.split(pred, "\n", -1), 1)
    exact = py_strip(pred) == py_strip(tgt)
    prefix = (F.length(first) > 0) & tgt.startswith(first)
    return df.groupBy(*group_cols).agg(
        F.count("*").alias("n_scored"),
        F.round(F.avg(exact.cast("double")), 6).alias("exact_match"),
        F.round(F.avg(prefix.cast("double")), 6).alias("prefix_match"))


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """The shorter and the longer text without the head and the tail they share."""
    if len(a) > len(b):
        a, b = b, a
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    a, b = a[start:], b[start:]
    end = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), len(a))
    return a[:len(a) - end], b[:len(b) - end]


def levenshtein_distance(a: str, b: str, limit: int | None = None) -> int:
    """Edit distance in code points, a whole column of the matrix at a time as the
    bits of one integer.  Beyond ``limit`` the result is ``limit + 1``, found
    without finishing."""
    a, b = _trimmed(a, b)
    if limit is not None and len(b) - len(a) > limit:
        return limit + 1
    if not a:
        return len(b)
    here: dict[str, int] = {}
    for i, ch in enumerate(a):
        here[ch] = here.get(ch, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = every, 0, len(a)  # bits: the column rises or falls by one at this row
    for j, ch in enumerate(b):
        same = here.get(ch, 0)
        flat = same | down
        diagonal = (((same & up) + up) ^ up) | same
        right = down | ~(diagonal | up) & every
        left = up & diagonal
        if right & last:
            score += 1
        elif left & last:
            score -= 1
        if limit is not None and score - (len(b) - 1 - j) > limit:
            return limit + 1
        right = (right << 1 | 1) & every
        up = (left << 1) & every | ~(flat | right) & every
        down = right & flat
    return score if limit is None else min(score, limit + 1)


LANE_BITS = 24576  # bits of the pairs that share a step: few enough for the nearest cache


def _lanes(pairs: list[tuple[str, str]]) -> list[int]:
    """Edit distances of pairs (first texts not empty), a lane of bits for each: one
    step adds a column to the matrices of all.  A lane's spare top bit takes what
    an addition or a shift carries out of it."""
    tables, blanks, at, ones, every = [], [], [], 0, 0
    for a, _ in pairs:
        size = len(a) // 8 + 1
        here: dict[str, int] = {}
        for i, ch in enumerate(a):
            here[ch] = here.get(ch, 0) | 1 << i
        tables.append({ch: bits.to_bytes(size, "little") for ch, bits in here.items()})
        at.append(sum(map(len, blanks)))
        blanks.append(bytes(size))
        ones |= 1 << 8 * at[-1]
        every |= ((1 << len(a)) - 1) << 8 * at[-1]
    ending: dict[int, list[int]] = {}
    for i, (_, b) in enumerate(pairs):
        ending.setdefault(len(b), []).append(i)
    out, up, down, total = [0] * len(pairs), every, 0, sum(map(len, blanks))
    for j, column in enumerate(zip_longest(*[b for _, b in pairs]), 1):
        same = int.from_bytes(b"".join([t.get(ch, none) for t, ch, none in zip(tables, column, blanks)]), "little")
        diagonal = ((((same & up) + up) ^ up) | same | down) & every
        right = (((down | (diagonal | up) ^ every) << 1) & every) | ones
        left = ((diagonal & up) << 1) & every
        up, down = left | (diagonal | right) ^ every, diagonal & right
        if j in ending:  # the last column holds the distance as its rises less its falls
            rise, fall = up.to_bytes(total, "little"), down.to_bytes(total, "little")
            for i in ending[j]:
                lane = slice(at[i], at[i] + len(blanks[i]))
                out[i] = j + int.from_bytes(rise[lane], "little").bit_count() - int.from_bytes(fall[lane], "little").bit_count()
    return out


def levenshtein_distances(a: list[str], b: list[str], limit: int | None = None) -> list[int]:
    """``levenshtein_distance`` of many pairs; those whose longer texts are of like
    length share their steps."""
    if limit is not None:
        return [levenshtein_distance(x, y, limit) for x, y in zip(a, b)]
    pairs = [_trimmed(x, y) for x, y in zip(a, b)]
    out = [len(y) for _, y in pairs]  # of those whose first text is empty
    todo = sorted((i for i, (x, _) in enumerate(pairs) if x), key=lambda i: -len(pairs[i][1]))
    start = 0
    while start < len(todo):
        longest, bits, end = len(pairs[todo[start]][1]), 0, start
        while end < len(todo) and bits < LANE_BITS and 4 * len(pairs[todo[end]][1]) >= 3 * longest:
            bits += len(pairs[todo[end]][0])
            end += 1
        own, start = todo[start:end], end
        found = _lanes([pairs[i] for i in own]) if len(own) > 2 else [levenshtein_distance(*pairs[i]) for i in own]
        for i, d in zip(own, found):
            out[i] = d
    return out


def edit_distance(df: DataFrame, prediction: str, target: str, group_cols=(), limit: int | None = None) -> DataFrame:
    """Mean Levenshtein distance in code points; a pair further apart than
    ``limit`` counts ``limit + 1``.  Pairs with a null side are not scored."""
    @F.pandas_udf("long")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        out: list[int | None] = [None] * len(a)
        both = [(i, x, y) for i, (x, y) in enumerate(zip(a, b)) if x is not None and y is not None]
        for (i, _, _), d in zip(both, levenshtein_distances([x for _, x, _ in both], [y for _, _, y in both], limit)):
            out[i] = d
        return pd.Series(out, dtype="Int64")

    scored = df.select(*group_cols, distance(F.col(prediction), F.col(target)).alias("__distance"))
    return scored.groupBy(*group_cols).agg(F.count("*").alias("n_scored"), F.round(F.avg("__distance"), 6).alias("avg_edit_distance"))


def completion_quality(df: DataFrame, prediction: str, target: str, group_cols=()) -> DataFrame:
    """A10: match rates and mean edit distance together."""
    m = completion_match(df, prediction, target, group_cols)
    e = edit_distance(df, prediction, target, group_cols).drop("n_scored")
    if group_cols:
        return m.join(e, list(group_cols))
    return m.withColumn("_k", F.lit(1)).join(e.withColumn("_k", F.lit(1)), "_k").drop("_k")


# --- A11 corpus BLEU --------------------------------------------------------------------

def _bleu_counts(max_n: int):
    """Task: per n the clipped matches and the n-grams of the predictions, and (n = 0) both sides' lengths."""
    def run(batches):
        for pdf in batches:
            sums = [[0, 0] for _ in range(max_n + 1)]
            for prediction, reference in zip(pdf["c"], pdf["r"]):
                c, r = (prediction or "").split(), (reference or "").split()
                sums[0][0] += len(c)
                sums[0][1] += len(r)
                for n in range(1, min(max_n, len(c)) + 1):
                    own = Counter(zip(*[c[i:] for i in range(n)]))
                    other = Counter(zip(*[r[i:] for i in range(n)]))
                    sums[n][0] += sum(min(k, other[g]) for g, k in own.items())
                    sums[n][1] += len(c) - n + 1
            yield pd.DataFrame([(n, a, b) for n, (a, b) in enumerate(sums)], columns=["n", "matches", "total"])
    return run


def corpus_bleu(df: DataFrame, key: str, prediction: str, reference: str, max_n: int = 4) -> DataFrame:
    """Corpus BLEU over whitespace tokens: clipped n-gram counts summed over
    the corpus, brevity penalty, geometric mean of n=1..max_n precisions.
    A row holds both texts, so its n-grams are counted where it is; only
    ``max_n + 1`` sums a batch leave a task.  Null texts have no tokens."""
    sums = (df.select(F.col(prediction).alias("c"), F.col(reference).alias("r"))
            .mapInPandas(_bleu_counts(max_n), "n int, matches long, total long").groupBy("n").agg(F.sum("matches").alias("matches"), F.sum("total").alias("total")))
    gram = F.col("n") > 0
    j = sums.agg(F.sum(F.when(gram, F.log(F.col("matches") / F.col("total")))).alias("log_sum"),
                 F.count_if(gram & (F.col("matches") == 0)).alias("zero_n"),
                 F.max(F.when(~gram, F.col("matches"))).alias("c"), F.max(F.when(~gram, F.col("total"))).alias("r"),
                 F.count_if(gram).alias("seen"))
    bp = F.when(F.col("c") >= F.col("r"), F.lit(1.0)).when(F.col("c") == 0, F.lit(0.0)).otherwise(F.exp(1 - F.col("r") / F.col("c")))
    bleu = F.when((F.col("zero_n") > 0) | (F.col("seen") < max_n), F.lit(0.0)).otherwise(bp * F.exp(F.col("log_sum") / max_n))
    return j.select(F.round(bleu, 6).alias("bleu"), F.round(bp, 6).alias("brevity_penalty"),
                    F.col("c").alias("candidate_length"), F.col("r").alias("reference_length"))


# --- A12 --------------------------------------------------------------------------------

def rating_means(df: DataFrame, ratings: str, metrics) -> DataFrame:
    """Mean of each metric over samples with non-empty ratings; missing
    metric keys are nulls (skipped), not errors."""
    non_empty = df.where(F.size(F.col(ratings)) > 0)
    aggs = []
    for m in metrics:
        v = F.try_element_at(F.col(ratings), F.lit(m))
        aggs += [F.round(F.avg(v), 6).alias(f"mean_{m}"), F.count(v).alias(f"n_{m}")]
    return non_empty.agg(F.count("*").alias("n_rated"), *aggs)


# --- A14 / A15 ------------------------------------------------------------------------------

def validation_loss(df: DataFrame, loss: str, batch: str, group_cols=()) -> DataFrame:
    """Mean of batch means (reference) and the row-weighted mean; perplexity
    = exp(mean loss)."""
    per_batch = df.groupBy(*group_cols, batch).agg(F.avg(loss).alias("bm"), F.sum(loss).alias("bs"), F.count("*").alias("bn"))
    return per_batch.groupBy(*group_cols).agg(
        F.round(F.avg("bm"), 6).alias("loss_batch_mean"),
        F.round(F.sum("bs") / F.sum("bn"), 6).alias("loss_token_mean"),
        F.round(F.exp(F.avg("bm")), 6).alias("perplexity"))


# --- A17 / A18 / W5 / W7 ---------------------------------------------------------------------

def consensus(df: DataFrame, key: str, solution: str) -> DataFrame:
    """Most common normalised solution per key; ties -> smallest solution."""
    norm = F.regexp_replace(py_strip(F.col(solution)), r"\s+", " ")
    counts = df.select(key, norm.alias("sol")).groupBy(key, "sol").agg(F.count("*").alias("votes"))
    # highest votes, then smallest solution
    best = counts.groupBy(key).agg(F.min_by(F.struct(F.col("sol"), F.col("votes")),
                                            F.struct(-F.col("votes"), F.col("sol"))).alias("b"))
    return best.select(key, F.col("b.sol").alias("consensus"), F.col("b.votes").alias("votes"))


def distinct_solutions(df: DataFrame, key: str, solution: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(solution).alias("n_distinct"), F.count("*").alias("n_samples"))


def solution_score(syntax_ok, tests_pass, code, documented) -> Column:
    """+1 syntax, +2 tests, +0.5 when 50 < len < 500, +0.5 documented."""
    n = F.length(col(code))
    return (F.when(col(syntax_ok), 1.0).otherwise(0.0) + F.when(col(tests_pass), 2.0).otherwise(0.0)
            + F.when((n > 50) & (n < 500), 0.5).otherwise(0.0) + F.when(col(documented), 0.5).otherwise(0.0))


def best_per_key(df: DataFrame, key: str, score: str, tie: str, value_cols) -> DataFrame:
    """The top row per key by (score desc, tie asc), as an aggregate."""
    vals = F.struct(*[F.col(c) for c in [score, tie, *value_cols]])
    order = F.struct(-F.col(score), F.col(tie))
    b = df.groupBy(key).agg(F.min_by(vals, order).alias("b"))
    return b.select(key, *[F.col(f"b.{c}").alias(c) for c in [score, tie, *value_cols]])


# --- A19 ------------------------------------------------------------------------------

def allocate_prompts(groups: DataFrame, group: str, metric: str, target: float, total: int) -> DataFrame:
    """Weak areas (metric < target) get new prompts proportional to their
    deficit, rounded by largest remainder.  ``groups`` is one row per group
    (a bounded domain such as categories): the window is over that table."""
    from pyspark.sql import Window
    weak = groups.where(F.col(metric) < target).withColumn("deficit", F.lit(target) - F.col(metric))
    w_all = Window.partitionBy()
    share = F.col("deficit") / F.sum("deficit").over(w_all) * total
    g = weak.withColumn("exact", share).withColumn("base", F.floor("exact").cast("bigint"))
    g = g.withColumn("rem", F.col("exact") - F.col("base"))
    left = F.lit(total) - F.sum("base").over(w_all)
    rk = F.row_number().over(Window.orderBy(F.desc("rem"), F.col(group)))
    g = g.withColumn("_left", left).withColumn("_rk", rk)
    return g.select(group, F.round(F.col(metric), 6).alias(metric), F.round("deficit", 6).alias("deficit"),
                    (F.col("base") + F.when(F.col("_rk") <= F.col("_left"), 1).otherwise(0)).alias("new_prompts"))


# --- J13 ---------------------------------------------------------------------------------

# FIXED VALUES: published comparison rows (model, size, pass@1 percent)
BASELINE_LEADERBOARD = [
    ("CodeGen-Mono", "16B", 29.3),
    ("StarCoder", "15B", 33.6),
    ("Code Llama", "13B", 36.0),
    ("GPT-3.5-turbo", "?", 48.1),
]


def leaderboard(spark: SparkSession, own: DataFrame) -> DataFrame:
    """Own score rows ``(model, size, pass_at_1)`` unioned with the baselines."""
    base = spark.createDataFrame(BASELINE_LEADERBOARD, "model string, size string, pass_at_1 double")
    return base.unionByName(own.select("model", "size", "pass_at_1"))
