"""Registry of named queries over the driver tables.

Each query is a ``(spark, sf_dir) -> DataFrame`` callable, registered with
its DuckDB SQL twin when an exact answer exists (``sql=None`` means the
result is learned or random and only its rows can be checked).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
SQLS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQLS[name] = sql.strip()
        return fn
    return deco


def r6(c) -> Column:
    """Float outputs are compared after rounding to 6 places on both engines."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)
