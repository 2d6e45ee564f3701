"""Registry of driver queries: name -> (callable(spark, sf_dir), oracle SQL | None).

Queries are grouped by area in ``reg_*`` modules; importing ``all_queries``
loads them all.  Oracle SQL is DuckDB dialect over the pre-registered
driver views; ``None`` marks an iterative/non-SQL operator (rows-only check
plus a brute-force pytest).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load() -> None:
    import importlib
    for mod in ("reg_corpus", "reg_dedup", "reg_sequences", "reg_prompts", "reg_teacher",
                "reg_eval", "reg_runs", "reg_stream", "reg_misc", "reg_bytebpe", "reg_files"):
        try:
            importlib.import_module(f"tessera.plans.{mod}")
        except ModuleNotFoundError as e:  # module not written yet
            if e.name != f"tessera.plans.{mod}":
                raise


def all_queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}
