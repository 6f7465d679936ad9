"""Deterministic pseudo-random numbers from keys (independent of partitioning,
unlike ``rand(seed)``), with the same definition in SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_u32(*parts) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of md5('p1:p2:...')."""
    txt = F.concat_ws(":", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    """Uniform in [0, 1) from ``hash_u32``."""
    return hash_u32(*parts) / F.lit(4294967296.0)


def sql_hash_u32(*parts: str) -> str:
    """DuckDB twin of ``hash_u32`` (parts are SQL expressions)."""
    txt = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({txt}), 1, 8)) AS BIGINT)"
