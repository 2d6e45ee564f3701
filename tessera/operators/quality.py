"""Quality filters (F1-F15) with an auditable reject reason.

Every filter is expressed as boolean / reason *columns* over one pass of the
input: no UDF except the optional Python syntax audit (F4), which runs on
the survivors of the cheap built-in predicates only.  ``keep`` operators
return ``reject_reason`` (null = kept) so a rejects table is one ``where``
away and nothing is silently lost.
"""

from __future__ import annotations

import ast
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.functions.constants import PY_SPACE
from tessera.functions.hashing import keyed_unit
from tessera.functions.text import alnum_or_space_count, contains_any, line_count, lines


def _reason(*pairs: tuple[Column, str]) -> Column:
    """First failing check wins (short-circuit order of the reference)."""
    expr = None
    for failed, label in pairs:
        expr = F.when(failed, F.lit(label)) if expr is None else expr.when(failed, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


# --- F1 / F2: response quality --------------------------------------------

@dataclass(frozen=True)
class ResponseQuality:
    min_length: int = K.RESPONSE_MIN_LENGTH
    refusals: list[str] = field(default_factory=lambda: list(K.REFUSAL_PHRASES))
    fence: str = K.CODE_FENCE
    # rows whose category is in this set need no fence (F1: everything but explanation needs one)
    fence_exempt: list[str] = field(default_factory=lambda: ["explanation"])
    # F2 (guide) instead requires a fence only for these task types; None = F1 behaviour
    fence_required_for: list[str] | None = None


def response_reject_reason(df: DataFrame, response: str = "response", category: str = "category",
                           params: ResponseQuality = ResponseQuality(), parsed: str | None = None) -> DataFrame:
    """F1 (script) / F2 (guide, with ``parsed`` flag and ``fence_required_for``)."""
    r = F.col(response)
    if params.fence_required_for is not None:
        needs_fence = F.col(category).isin(params.fence_required_for)
    else:
        needs_fence = ~F.col(category).isin(params.fence_exempt)
    checks = []
    if parsed is not None:
        checks.append((~F.col(parsed), "unparsed"))
    checks += [
        (F.length(r) < params.min_length, "too_short"),
        (contains_any(r, params.refusals), "refusal"),
        (needs_fence & ~r.contains(params.fence), "no_code"),
    ]
    return df.withColumn("reject_reason", _reason(*checks))


# --- F3: basic code checks -------------------------------------------------

@dataclass(frozen=True)
class BasicChecks:
    min_chars: int = K.MIN_CODE_CHARS
    max_chars: int = K.MAX_CODE_CHARS
    min_lines: int = K.MIN_CODE_LINES
    max_mean_line: int = K.MAX_MEAN_LINE_LENGTH
    min_alnum_ratio: float = K.MIN_ALNUM_RATIO


def basic_check_columns(text: Column, p: BasicChecks = BasicChecks()) -> dict[str, Column]:
    n = F.length(text)
    n_lines = line_count(text)
    return {
        "too_short": n < p.min_chars,
        "too_long": n > p.max_chars,
        "too_few_lines": n_lines < p.min_lines,
        # mean line length > max  <=>  n > max * lines  (exact, no float)
        "minified": n > F.lit(p.max_mean_line) * n_lines,
        "low_alnum": alnum_or_space_count(text) < F.lit(p.min_alnum_ratio) * n,
    }


def basic_reject_reason(text: Column, p: BasicChecks = BasicChecks()) -> Column:
    return _reason(*[(c, name) for name, c in basic_check_columns(text, p).items()])


def basic_checks(df: DataFrame, text: str = "content", p: BasicChecks = BasicChecks()) -> DataFrame:
    """adds ``reject_reason`` (null when all checks pass)."""
    return df.withColumn("reject_reason", basic_reject_reason(F.col(text), p))


# --- F4 / F12: syntax audit ------------------------------------------------

def _parses(src: str | None) -> bool | None:
    if src is None:
        return None
    try:
        ast.parse(src)
        return True
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False


@F.pandas_udf(T.BooleanType())
def python_parses(code: pd.Series) -> pd.Series:
    """Arrow-batched ``ast.parse`` check (the only per-row Python in filters)."""
    return code.map(_parses).astype("boolean")


def syntax_valid(df: DataFrame, text: str = "content", language: str = "language",
                 checked_languages=("python",)) -> DataFrame:
    """``syntax_ok`` true/false for checked languages, null = not checked.

    The UDF is evaluated only on rows of a checked language (the CASE guard
    keeps other rows out of the Arrow batches).
    """
    is_checked = F.lower(F.col(language)).isin(list(checked_languages))
    return df.withColumn("syntax_ok", F.when(is_checked, python_parses(F.col(text))))


def syntax_rate(df: DataFrame, group_cols=("language",)) -> DataFrame:
    """F4 report: valid rate per group among checked rows."""
    return (df.groupBy(*group_cols)
            .agg(F.count("*").alias("n_rows"),
                 F.count("syntax_ok").alias("n_checked"),
                 F.count_if(F.col("syntax_ok")).alias("n_valid"))
            .withColumn("valid_rate", F.round(F.try_divide(F.col("n_valid"), F.col("n_checked")), 6)))


def completion_filter(df: DataFrame, completion: str = "completion", min_length: int = 20) -> DataFrame:
    """keep completions of at least ``min_length`` characters that compile."""
    ok = (F.length(F.col(completion)) >= min_length)
    return df.where(ok).where(python_parses(F.col(completion)))


# --- F5-F8: content and repository quality --------------------------------

@dataclass(frozen=True)
class ContentQuality:
    max_comment_ratio: float = K.MAX_COMMENT_RATIO
    comment_prefixes: list[str] = field(default_factory=lambda: ["#", "//"])
    autogen_markers: list[str] = field(default_factory=lambda: list(K.AUTOGEN_MARKERS))
    test_markers: list[str] = field(default_factory=lambda: list(K.TEST_MARKERS))
    test_keep_rate: float = K.TEST_KEEP_RATE
    star_tiers: list[tuple[int, float]] = field(default_factory=lambda: list(K.STAR_TIERS))
    star_default_rate: float = K.STAR_DEFAULT_RATE
    salt: str = "quality"


def comment_lines(text: Column, prefixes) -> Column:
    alt = "|".join(_re_escape(p) for p in prefixes)
    return F.size(F.filter(lines(text), lambda l: l.rlike(f"^[{PY_SPACE}]*({alt})")))


def _re_escape(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()/" else ch for ch in s)


def star_keep_rate(stars: Column, p: ContentQuality = ContentQuality()) -> Column:
    expr = None
    for floor, rate in p.star_tiers:
        expr = F.when(stars > floor, F.lit(rate)) if expr is None else expr.when(stars > floor, F.lit(rate))
    return expr.otherwise(F.lit(p.star_default_rate))


def content_check_columns(text: Column, key: Column, stars: Column | None,
                          p: ContentQuality = ContentQuality()) -> dict[str, Column]:
    n_lines = line_count(text)
    out = {
        # comment_ratio > max  <=>  comments > max * lines
        "too_many_comments": comment_lines(text, p.comment_prefixes) > F.lit(p.max_comment_ratio) * n_lines,
        "auto_generated": contains_any(text, p.autogen_markers, lower=True),
        # reference: test file dropped when random() > rate
        "test_file_sampled_out": contains_any(text, p.test_markers) & (keyed_unit(p.salt + ":test", key) > p.test_keep_rate),
    }
    if stars is not None:
        out["repo_tier_sampled_out"] = keyed_unit(p.salt + ":tier", key) >= star_keep_rate(stars, p)
    return out


def high_quality(df: DataFrame, text: str = "content", key: str = "id", stars: str | None = "stars",
                 basic: BasicChecks = BasicChecks(), content: ContentQuality = ContentQuality(),
                 syntax_col: str | None = None) -> DataFrame:
    """composite F3 -> F4 -> F5..F7 -> F8 in one pass, first reason wins."""
    t = F.col(text)
    checks = [(c, name) for name, c in basic_check_columns(t, basic).items()]
    if syntax_col is not None:
        checks.append((F.col(syntax_col) == F.lit(False), "syntax_error"))
    cq = content_check_columns(t, F.col(key), F.col(stars) if stars else None, content)
    checks += [(c, name) for name, c in cq.items()]
    return df.withColumn("reject_reason", _reason(*checks))


# --- F10, F11, F13-F15 -------------------------------------------------------

def category_subset(df: DataFrame, categories, n: int, order_cols=("id",), category: str = "category") -> DataFrame:
    """rows of the chosen categories, first ``n`` in a stable order."""
    return df.where(F.col(category).isin(list(categories))).orderBy(*order_cols).limit(n)


def language_subset(df: DataFrame, languages, language: str = "language") -> DataFrame:
    """F11."""
    return df.where(F.col(language).isin(list(languages)))


PLACEHOLDER_MARKER = "# code snippet here"


def skip_placeholders(df: DataFrame, prompt: str = "prompt", marker: str = PLACEHOLDER_MARKER) -> DataFrame:
    """drop prompts whose lower-cased text contains the placeholder."""
    return df.where(~F.lower(F.col(prompt)).contains(marker))


# Licence families: (label, permissive?, pattern) — detection is case-insensitive.
LICENSE_RULES = [
    ("mit", True, r"(?i)\bMIT License\b"),
    ("apache-2.0", True, r"(?i)\bApache License\b"),
    ("bsd", True, r"(?i)\bBSD\b.{0,20}\bLicense\b"),
    ("gpl", False, r"(?i)\b(GNU )?(Lesser |Affero )?General Public License\b"),
]


def license_label(text: Column, rules=LICENSE_RULES) -> Column:
    expr = None
    for label, _, pat in rules:
        hit = text.rlike(pat)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return expr.otherwise(F.lit("none"))


def license_policy(df: DataFrame, text: str = "content", rules=LICENSE_RULES, allow_unlicensed: bool = True) -> DataFrame:
    """keep permissive (and optionally unlicensed) rows; adds ``license``."""
    allowed = [label for label, ok, _ in rules if ok] + (["none"] if allow_unlicensed else [])
    out = df.withColumn("license", license_label(F.col(text), rules))
    return out.withColumn("license_ok", F.col("license").isin(allowed))


# --- user hooks (the reference lets users swap a completion filter) -----------

def custom_reject_reason(df: DataFrame, rules, base_reason: str | None = "reject_reason") -> DataFrame:
    """Append user rules — ``[(name, failed: Column), ...]`` checked in order —
    after the reasons already in ``base_reason`` (first reason wins)."""
    checks = [(F.col(base_reason).isNotNull(), None)] if base_reason and base_reason in df.columns else []
    expr = None
    for failed, name in checks + [(c, n) for n, c in rules]:
        label = F.col(base_reason) if name is None else F.lit(name)
        expr = F.when(failed, label) if expr is None else expr.when(failed, label)
    out = expr.otherwise(F.lit(None).cast("string")) if expr is not None else F.lit(None).cast("string")
    return df.withColumn(base_reason or "reject_reason", out)


def split_rejects(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejects table with their reason) — nothing is dropped silently."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())
