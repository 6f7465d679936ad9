"""Projection, filtering, filling and value mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this many entries a mapping is joined as a table instead of inlined.
INLINE_MAP_LIMIT = 1000


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C1 (pruned from the scan by Catalyst)."""
    return df.drop(*cols)


def keep_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep listed columns, drop the rest."""
    return df.select(*cols)


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection."""
    return df.withColumns(dict(exprs))


def apply_to_all(frames: Sequence[DataFrame], fn) -> list[DataFrame]:
    """C4: the same transformation for train and test alike."""
    return [f.transform(fn) for f in frames]


def filter_length(df: DataFrame, col: str, min_len: int | None = None,
                  max_len: int | None = None) -> DataFrame:
    """Keep values longer than ``min_len`` and/or shorter than ``max_len``."""
    cond = F.lit(True)
    if min_len is not None:
        cond = cond & (F.length(col) > min_len)
    if max_len is not None:
        cond = cond & (F.length(col) < max_len)
    return df.where(cond)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any listed column (all if None)."""
    cols = list(subset) if subset else df.columns
    return df.na.drop("any", subset=cols)


def finite_only(c) -> Column:
    """Value if finite, else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Map NaN to NULL on entry so one missing marker flows through."""
    num = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    cols = [c for c in (cols or df.columns) if c in num]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in cols})


def patch_by_key(df: DataFrame, patches: DataFrame, id_col: str, col: str,
                 patch_col: str = "value") -> DataFrame:
    """Override values of chosen rows from a ``(id, value)`` patch table."""
    p = patches.select(F.col(id_col).alias("__pid"), F.col(patch_col).alias("__pv"))
    out = df.join(p, df[id_col] == p["__pid"], "left")
    return out.withColumn(col, F.when(F.col("__pid").isNotNull(), F.col("__pv")).otherwise(F.col(col))) \
        .drop("__pid", "__pv")


def map_values(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Exact-match dictionary mapping; unmapped values unchanged.

    Small mappings are an inline ``map`` literal (no join); large ones are a
    table joined on the value, which AQE broadcasts when it is small enough.
    """
    out = out or col
    if len(mapping) <= INLINE_MAP_LIMIT:
        m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
        return df.withColumn(out, F.coalesce(F.try_element_at(m, F.col(col)), F.col(col)))
    spark = df.sparkSession
    table = spark.createDataFrame(list(mapping.items()), ["__k", "__v"])
    j = df.join(table, df[col] == table["__k"], "left")
    return j.withColumn(out, F.coalesce(F.col("__v"), F.col(col))).drop("__k", "__v")


def fill_constant(df: DataFrame, values: Mapping[str, object], empty_as_null: bool = True) -> DataFrame:
    """NULL or NaN (and, for strings, "") -> a constant, per column."""
    exprs = {}
    for c, v in values.items():
        x = F.col(c)
        if empty_as_null and df.schema[c].dataType.typeName() == "string":
            x = F.nullif(x, F.lit(""))
        elif df.schema[c].dataType.typeName() in ("double", "float"):
            x = F.nanvl(x, F.lit(None).cast(df.schema[c].dataType))
        exprs[c] = F.coalesce(x, F.lit(v).cast(df.schema[c].dataType))
    return df.withColumns(exprs)


def safe_cast(c, to: str) -> Column:
    """C17: cast that yields NULL instead of raising (ANSI on)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(to)


def rows_with_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows that are NULL (or NaN) in any listed column."""
    return df.where(any_null(df, cols))


def any_null(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    cols = list(cols or df.columns)
    cond = F.lit(False)
    for c in cols:
        t = df.schema[c].dataType.typeName()
        isn = F.col(c).isNull()
        if t in ("double", "float"):
            isn = isn | F.isnan(c)
        cond = cond | isn
    return cond


def slice_by_split(df: DataFrame, split_col: str, value: str) -> DataFrame:
    """C18 re-aimed: positional slices become a filter on a split tag."""
    return df.where(F.col(split_col) == value)
