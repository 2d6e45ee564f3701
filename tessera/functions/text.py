"""Text measures as JVM-side Column expressions (whole-stage codegen).

Python's ``str.split('\\n')``, ``str.split()``, ``str.strip()``,
``isalnum``/``isspace`` are re-expressed with explicit character classes so
that Spark (Java regex) and an RE2-based SQL oracle agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.constants import PY_SPACE

WS_RUN = f"[{PY_SPACE}]+"
NOT_ALNUM_OR_SPACE = rf"[^\p{{L}}\p{{N}}{PY_SPACE}]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lines(text) -> Column:
    """``text.split('\\n')`` — keeps empty trailing lines."""
    return F.split(col(text), "\n", -1)


def line_count(text) -> Column:
    return F.size(lines(text))


def words(text) -> Column:
    """``text.split()`` — whitespace runs, no empty tokens."""
    return F.filter(F.split(col(text), WS_RUN, -1), lambda x: x != F.lit(""))


def py_strip(text) -> Column:
    """``str.strip()`` (Spark's ``trim`` only removes spaces)."""
    return F.regexp_replace(col(text), rf"^[{PY_SPACE} ]+|[{PY_SPACE} ]+$", "")


def alnum_or_space_count(text) -> Column:
    return F.length(F.regexp_replace(col(text), NOT_ALNUM_OR_SPACE, ""))


def contains_any(text, needles, lower: bool = False) -> Column:
    """OR of substring tests; an empty list is false."""
    t = F.lower(col(text)) if lower else col(text)
    out = F.lit(False)
    for n in needles:
        out = out | t.contains(n.lower() if lower else n)
    return out


def first_match_label(text, rules, default: str = "unknown", regex: bool = False) -> Column:
    """Ordered cascade: label of the first rule whose needle/pattern hits."""
    t = col(text)
    expr = None
    for label, needles in rules:
        hit = F.lit(False)
        for n in needles:
            hit = hit | (t.rlike(n) if regex else t.contains(n))
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
