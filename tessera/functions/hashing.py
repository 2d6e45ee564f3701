"""Deterministic keyed hashing — the sampling contract of the engine.

All randomness is a pure function of (salt, key columns):

    u32  = first 8 hex digits of md5(salt ':' key ...) as an unsigned int
    unit = u32 / 2**32                      in [0, 1)
    pick = pmod(u32, m)                     in [0, m)

Results therefore do not depend on partitioning, task retries, executor
loss or the order rows arrive in, and a SQL engine with ``md5`` can
reproduce them (see ``sql_u32``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(salt: str, cols) -> Column:
    parts = [F.lit(str(salt))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.concat_ws(":", *parts)


def keyed_u32(salt: str, *cols) -> Column:
    """Unsigned 32-bit keyed hash as bigint."""
    return F.conv(F.substring(F.md5(_key(salt, cols)), 1, 8), 16, 10).cast("bigint")


def keyed_unit(salt: str, *cols) -> Column:
    """Keyed uniform value in [0, 1)."""
    return keyed_u32(salt, *cols) / F.lit(TWO_32)


def keyed_pick(salt: str, m, *cols) -> Column:
    """Keyed integer in [0, m); ``m`` may be a Column."""
    mm = m if isinstance(m, Column) else F.lit(int(m))
    return F.pmod(keyed_u32(salt, *cols), mm)


def token_u32(col: Column) -> Column:
    """Unsalted 32-bit hash of a token (MinHash base hash)."""
    return F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("bigint")


# --- SQL twins (DuckDB dialect) used by the oracle strings -----------------

def sql_u32(salt: str, *exprs: str) -> str:
    parts = ", ".join([f"'{salt}'"] + [f"CAST({e} AS VARCHAR)" for e in exprs])
    return f"CAST(('0x' || substr(md5(concat_ws(':', {parts})), 1, 8)) AS BIGINT)"


def sql_unit(salt: str, *exprs: str) -> str:
    return f"({sql_u32(salt, *exprs)} / 4294967296.0)"
