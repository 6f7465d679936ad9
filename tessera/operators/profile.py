"""Schema and column profiling (B1-B8), one distributed pass per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.operators.clean import any_null


def schema_table(df: DataFrame) -> DataFrame:
    """B1: ``(position, column, type, nullable)`` as a DataFrame."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def shape(df: DataFrame) -> DataFrame:
    """B2: one row ``(n_rows, n_cols)``; the row count is a distributed count."""
    return df.select(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric columns, other columns) from the schema."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return num, [c for c in df.columns if c not in num]


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column ``(column, n_distinct, n_null, has_null)``.

    ``n_distinct`` counts NULL as one more value when present.  Columns are
    unpivoted to ``(column, value)`` and counted with a two-level group-by,
    so a wide table is one shuffle keyed by (column, value) rather than one
    job per column, and a hot value is combined map-side.
    ``approx=True`` swaps the exact distinct count for HyperLogLog.
    """
    cols = list(cols or df.columns)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.when(~any_null(df, [c]), F.col(c).cast("string")).alias("value")) for c in cols
    ])).alias("kv")).select("kv.column", "kv.value")
    if approx:
        res = long.groupBy("column").agg(
            F.approx_count_distinct("value").alias("__d"),
            F.count_if(F.col("value").isNull()).alias("n_null"))
    else:
        per_value = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("__n"))
        res = per_value.groupBy("column").agg(
            F.count("value").alias("__d"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("__n"))), F.lit(0)).alias("n_null"))
    return res.select(
        "column",
        (F.col("__d") + F.when(F.col("n_null") > 0, 1).otherwise(0)).cast("bigint").alias("n_distinct"),
        F.col("n_null").cast("bigint"),
        (F.col("n_null") > 0).cast("int").alias("has_null"),
    )


def profile_numeric(df: DataFrame, approx: bool = False) -> DataFrame:
    num, _ = split_by_type(df)
    return column_profile(df, num, approx)


def profile_non_numeric(df: DataFrame, approx: bool = False) -> DataFrame:
    _, other = split_by_type(df)
    return column_profile(df, other, approx)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values, kept distributed."""
    return df.select(col).distinct()


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns holding a single value (NULL counted as a value)."""
    return column_profile(df, cols).where(F.col("n_distinct") == 1).select("column")


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """B6 apply: drop the constant columns (the list itself is tiny)."""
    names = [r[0] for r in constant_columns(df).collect()]
    return df.drop(*names)


def has_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row, one 0/1 flag per column; NaN is missing too."""
    cols = list(cols or df.columns)
    return df.select(*[F.max(any_null(df, [c]).cast("int")).alias(c) for c in cols])


def expect_null_count(df: DataFrame, col: str, expected: int) -> int:
    """Count NULLs and fail loudly if the count is not what was expected."""
    got = df.select(F.count_if(any_null(df, [col]))).first()[0]
    if got != expected:
        raise AssertionError(f"{col}: {got} NULL values, expected {expected}")
    return got
