"""Exact medians, modes and prefix counts that survive a hot group.

Spark's built-in ``median`` / ``mode`` keep a value->count map per group and
merge it in one task, so one group holding a third of the rows with many
distinct values lands in a single buffer.  The versions here pre-aggregate to
``(group, value, n)`` first (map-side combine, shuffle on the *pair*), and
count the rows below a value by ranges of the real values: a range partitioner
cuts the sorted ``(group, value)`` rows into pieces of bounded size, a small
table of the pieces' totals gives each its offset, and a window per piece adds
the running count inside it.  So neither a hot group nor values with a long
common prefix are ranked by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ONE = "__g"


def _groups(group_cols: Sequence[str]) -> list[str]:
    return list(group_cols) if group_cols else [_ONE]


def _attach(df: DataFrame, small: DataFrame, g: list[str]) -> DataFrame:
    """Join per-group values onto rows; for the single whole-column group the
    one row is read as a scalar subquery instead of a (nested-loop) join."""
    if g != [_ONE]:
        on, renamed = F.lit(True), small
        for c in g:  # a NULL group is a group
            renamed = renamed.withColumnRenamed(c, f"__a_{c}")
            on = on & F.col(c).eqNullSafe(F.col(f"__a_{c}"))
        return df.join(renamed, on).drop(*[f"__a_{c}" for c in g])
    cols = [c for c in small.columns if c != _ONE]
    row = small.select(F.struct(*cols).alias("s")).scalar()
    return df.withColumns({c: row[c] for c in cols})


def value_counts_by_group(df: DataFrame, group_cols: Sequence[str], value_col: str,
                          weight_col: str | None = None) -> DataFrame:
    """``(group..., value, n)`` with NULL and NaN values dropped (pandas semantics).

    With ``weight_col`` a row stands for that many (a pre-aggregated input).
    """
    g = _groups(group_cols)
    src = df if group_cols else df.withColumn(_ONE, F.lit(0))
    if src.schema[value_col].dataType.typeName() in ("double", "float"):
        src = src.withColumn(value_col, F.nanvl(value_col, F.lit(None).cast(src.schema[value_col].dataType)))
    return (src.where(F.col(value_col).isNotNull())
            .groupBy(*g, value_col).agg((F.sum(weight_col) if weight_col else F.count(F.lit(1))).alias("__n")))


# Distinct values of one group that a single task may rank in one window.
MAX_DISTINCT_PER_TASK = 1_000_000


def exact_median(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 out: str = "median", max_per_task: int = MAX_DISTINCT_PER_TASK,
                 weight_col: str | None = None) -> DataFrame:
    """Exact median (mean of the two middle values) per group, NULLs and NaN skipped.

    ``(group, value, n)`` pre-aggregation, then the rows below each value
    (``rows_before``); the values that cover the middle ranks
    ``floor((N-1)/2)`` and ``floor(N/2)`` are read off.  Groups whose values are
    all missing are absent from the result; a NULL group is a group.
    """
    g = _groups(group_cols)
    vc = value_counts_by_group(df, group_cols, value_col, weight_col).withColumn(value_col, F.col(value_col).cast("double"))
    tot = vc.groupBy(*g).agg(F.sum("__n").alias("__tot"))
    ranks = tot.select(*g, F.floor((F.col("__tot") - 1) / 2).alias("__lo"), F.floor(F.col("__tot") / 2).alias("__hi"))
    pos = rows_before(vc, [] if g == [_ONE] else g, value_col, "__n", out="__start", max_per_task=max_per_task)
    cur = _attach(pos, ranks, g).withColumn("__end", F.col("__start") + F.col("__n"))
    lo = F.when((F.col("__lo") >= F.col("__start")) & (F.col("__lo") < F.col("__end")), F.col(value_col))
    hi = F.when((F.col("__hi") >= F.col("__start")) & (F.col("__hi") < F.col("__end")), F.col(value_col))
    res = cur.groupBy(*g).agg(((F.max(lo) + F.max(hi)) / 2).alias(out))
    return res if group_cols else res.drop(_ONE)


def group_median(df: DataFrame, group_cols: Sequence[str], value_col: str, out: str = "median",
                 approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """E4 entry point: exact (default) or sketch-based median per group.

    ``approx=True`` uses ``percentile_approx`` (bounded memory per group, one
    shuffle; rank error about 1/accuracy) for very large tables where an
    exact answer is not needed.
    """
    if not approx:
        return exact_median(df, group_cols, value_col, out)
    v = F.nanvl(F.col(value_col).cast("double"), F.lit(None).cast("double"))
    src = df.where(v.isNotNull())
    agg = F.percentile_approx(v, 0.5, accuracy).alias(out)
    return src.groupBy(*group_cols).agg(agg) if group_cols else src.agg(agg)


def global_median(df: DataFrame, value_col: str, max_per_task: int = MAX_DISTINCT_PER_TASK,
                  weight_col: str | None = None) -> Column:
    """Scalar-subquery column holding the exact median of ``value_col``."""
    cols = [value_col, weight_col] if weight_col else [value_col]
    return exact_median(df.select(*cols), [], value_col, "m", max_per_task, weight_col).select("m").scalar()


def group_modes(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """All tied most-frequent values per group, one row each: ``(group..., value, n)``.

    Long form instead of an array, so a group whose values all tie cannot
    grow one cell without bound.
    """
    vc = value_counts_by_group(df, group_cols, value_col)
    g = _groups(group_cols)
    top = vc.groupBy(*g).agg(F.max("__n").alias("__top"))
    res = _attach(vc, top, g).where(F.col("__n") == F.col("__top")).drop("__top").withColumnRenamed("__n", "n")
    return res if group_cols else res.drop(_ONE)


def global_mode(df: DataFrame, value_col: str, weight_col: str | None = None) -> Column:
    """Scalar-subquery column: most frequent non-NULL value, smallest of ties."""
    n = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    vc = df.where(F.col(value_col).isNotNull()).groupBy(value_col).agg(n.alias("__n"))
    return vc.orderBy(F.desc("__n"), F.asc(value_col)).limit(1).select(value_col).scalar()


def rows_before(vc: DataFrame, group_cols: Sequence[str], value_col: str, n_col: str,
                out: str = "__before", max_per_task: int = MAX_DISTINCT_PER_TASK) -> DataFrame:
    """Distributed prefix count: for each distinct ``(group, value, n)`` row,
    the number of rows of its group with a smaller value.

    When every group has at most ``max_per_task`` distinct values, one
    running-count window per group does it.  Otherwise the rows are cut into
    ranges of ``(group, value)`` of about half that many rows by Spark's range
    partitioner (any number of ranges; real values, not prefixes of them) and
    checkpointed with the range's number, so a lost task reads the same cuts
    again.  Both ways give the same numbers.
    """
    from tessera.session import cut_lineage

    g = list(group_cols)
    nd_max = (vc.groupBy(*g).agg(F.count(F.lit(1)).alias("__nd")).agg(F.max("__nd")).first()[0]
              if g else vc.count()) or 0
    if nd_max <= max_per_task:
        w = Window.partitionBy(*g).orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
        return vc.withColumn(out, F.coalesce(F.sum(n_col).over(w), F.lit(0)))
    n_ranges = -(-2 * vc.count() // max_per_task)
    b = cut_lineage(vc.repartitionByRange(n_ranges, *g, value_col).withColumn("__b", F.spark_partition_id()))
    tot = b.groupBy(*g, "__b").agg(F.sum(n_col).alias("__bn"))
    wo = Window.partitionBy(*g).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*g, "__b", F.coalesce(F.sum("__bn").over(wo), F.lit(0)).alias("__off"))
    wl = Window.partitionBy(*g, "__b").orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("__loc", F.coalesce(F.sum(n_col).over(wl), F.lit(0)))
    t = tot.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(g)], F.col("__b").alias("__tb"), "__off")
    on = F.col("__b") == F.col("__tb")
    for i, c in enumerate(g):  # a NULL group is a group
        on = on & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    return (b.join(t, on).withColumn(out, F.col("__off") + F.col("__loc"))
            .drop("__b", "__tb", "__off", "__loc", *[f"__g{i}" for i in range(len(g))]))
