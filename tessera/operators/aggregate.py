"""Aggregations (E1-E12).  Totals are scalar subqueries, never an
unpartitioned window over data-sized input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.quantiles import exact_median
from tessera.session import cut_lineage


def value_counts(df: DataFrame, col: str, ascending: bool = False) -> DataFrame:
    """``(value, n)`` with NULL dropped, ordered by count then value."""
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    order = F.asc("n") if ascending else F.desc("n")
    return vc.orderBy(order, F.asc(col))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """``(value, n, share)``; share of the non-NULL rows."""
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # one scan: the total is the sum of the (checkpointed) counts
    vc = cut_lineage(vc)
    return vc.withColumn("share", F.col("n") / vc.select(F.sum("n")).scalar())


def describe(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Per column ``n, mean, median, std (sample), std_pop, min, max``.

    Long output ``(column, ...)``; the median is the exact, skew-safe one.
    """
    g = list(group_cols)
    long = df.select(*g, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("kv")).select(*g, "kv.column", "kv.v")
    long = long.withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    stats = long.groupBy(*g, "column").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.stddev_pop("v").alias("std_pop"), F.min("v").alias("min"), F.max("v").alias("max"))
    med = exact_median(long, [*g, "column"], "v", "median")
    # a NULL group is a group
    on = F.col("column") == F.col("__m_column")
    for c in g:
        on = on & F.col(c).eqNullSafe(F.col(f"__m_{c}"))
    med = med.select("median", *[F.col(c).alias(f"__m_{c}") for c in [*g, "column"]])
    return stats.join(med, on, "left").drop(*[f"__m_{c}" for c in [*g, "column"]])


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form ``(a, b, n)``; rows with a NULL excluded."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, a: str, b: str, levels: Sequence | None = None) -> DataFrame:
    """E9 display form via ``pivot`` (pass ``levels`` to skip the distinct pass)."""
    ct = crosstab_long(df, a, b)
    return ct.groupBy(a).pivot(b, list(levels) if levels is not None else None).agg(F.first("n")).na.fill(0)


def crosstab_margins(ct: DataFrame, a: str, b: str) -> DataFrame:
    """Total, number of rows and columns of a long crosstab."""
    return ct.agg(F.sum("n").alias("total"), F.count_distinct(a).alias("n_rows"),
                  F.count_distinct(b).alias("n_cols"))


def compare_distribution(before: DataFrame, after: DataFrame, key: str, n_col: str = "n") -> DataFrame:
    """Two count tables side by side on their bin / value."""
    bb = before.select(F.col(key), F.col(n_col).alias("n_before"))
    aa = after.select(F.col(key), F.col(n_col).alias("n_after"))
    j = bb.join(aa, key, "full_outer")
    return j.select(key, F.coalesce("n_before", F.lit(0)).alias("n_before"),
                    F.coalesce("n_after", F.lit(0)).alias("n_after"))
