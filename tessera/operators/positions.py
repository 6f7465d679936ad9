"""Row numbers in a total order without a single-task window.

The rows are cut into ranges of the order by Spark's range partitioner, sorted
inside each range, and every row gets its place in its range plus the number of
rows in the ranges before it.  Only the table of range sizes is ranked by a
window: one row per range and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

ROWS_PER_RANGE = 1_000_000
_INDEX_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def row_numbers(df: DataFrame, order: Sequence[str | Column], out: str = "row", group_cols: Sequence[str] = (),
                rows_per_range: int = ROWS_PER_RANGE, count_out: str | None = None) -> DataFrame:
    """Adds ``out``: the row's number (from 1) by ``order`` within its group.

    ``order`` follows Spark's rules (ascending, nulls first, unless a column
    says otherwise); rows that tie keep the order in which the input holds
    them, so equal rows get different numbers.  A NULL group is a group.
    ``count_out`` also adds the number of rows of the group.  An empty table
    gives no rows.  Columns of ``df`` may have any names but those with the
    prefix ``__rn_``.

    The input and its cut are checkpointed, so a task that is run again reads
    the same ranges.  Rows are moved once; a hot group or a hot value of the
    order is spread over as many ranges as its rows fill.
    """
    spark, g = df.sparkSession, list(group_cols)
    keyed = cut_lineage(df.withColumn("__rn_tie", F.monotonically_increasing_id()))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keyed.count() // rows_per_range))
    keys = [*[F.col(f"`{c}`") for c in g], *order, F.col("__rn_tie")]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    cut = cut_lineage(keyed.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
                      .withColumns({"__rn_range": F.spark_partition_id(), "__rn_place": place}))
    by = [F.col(f"`{c}`").alias(f"__rn_g{i}") for i, c in enumerate(g)]
    names = [f"__rn_g{i}" for i in range(len(g))]
    sizes = cut.groupBy(F.col("__rn_range").alias("__rn_of"), *by).agg(
        F.min("__rn_place").alias("__rn_first"), F.count(F.lit(1)).alias("__rn_n"))
    whole = Window.partitionBy(*names)
    before = whole.orderBy("__rn_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__rn_of", *names, "__rn_first", F.coalesce(F.sum("__rn_n").over(before), F.lit(0)).alias("__rn_before"),
                           F.sum("__rn_n").over(whole).alias("__rn_all"))
    on = F.col("__rn_range") == F.col("__rn_of")
    for i, c in enumerate(g):
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(f"__rn_g{i}"))
    number = F.col("__rn_place") - F.col("__rn_first") + F.col("__rn_before") + 1
    # without groups there is one row per range; with groups AQE goes by the measured size
    joined = cut.join(offsets if g else F.broadcast(offsets), on)
    extra = [F.col("__rn_all").alias(count_out)] if count_out else []
    keep = [F.col(f"`{c}`") for c in df.columns if c not in (out, count_out)]
    return joined.select(*keep, number.alias(out), *extra)


def slice_rows(df: DataFrame, order: Sequence[str | Column], start: int = 0, stop: int | None = None) -> DataFrame:
    """The rows from place ``start`` (from 0) up to ``stop`` (not included; None: the last) of ``order``."""
    numbered = row_numbers(df, order, "__rn_row")
    keep = F.col("__rn_row") > start
    return numbered.where(keep if stop is None else keep & (F.col("__rn_row") <= stop)).select(*[F.col(f"`{c}`") for c in df.columns])


def contiguous_folds(df: DataFrame, order: Sequence[str | Column], n_folds: int = 5, out: str = "fold") -> DataFrame:
    """Fold 0..n-1 by place in ``order``: neighbours share a fold, and the first folds hold one row more where it doesn't come out even."""
    numbered = row_numbers(df, order, "__rn_row", count_out="__rn_size")
    i, n = F.col("__rn_row") - 1, F.col("__rn_size")
    small, more = F.floor(n / n_folds), n % n_folds
    cut = more * (small + 1)  # rows in the larger folds
    fold = F.when(i < cut, F.floor(i / (small + 1))).otherwise(more + F.floor((i - cut) / F.greatest(small, F.lit(1))))
    return numbered.withColumn(out, fold.cast("int")).select(*[F.col(f"`{c}`") for c in df.columns if c != out], out)


def inject_missing_exactly(df: DataFrame, id_col: str, cols: Sequence[str], frac: float = 0.5, seed: int = 42) -> DataFrame:
    """Blank one feature in exactly ``floor(frac * n)`` rows.

    The rows are the first by md5 of ``(seed, id)`` (ties by id), the feature comes from a second hash,
    so the draw is the same under any partitioning.  Adds ``injected``: the column's name or NULL.
    """
    from tessera.functions.hashing import hash_u32

    numbered = row_numbers(df, [hash_u32(F.lit(seed), F.col(f"`{id_col}`")), F.col(f"`{id_col}`")], "__rn_row", count_out="__rn_size")
    names = F.array(*[F.lit(c) for c in cols])
    which = F.element_at(names, (hash_u32(F.lit(seed), F.lit("col"), F.col(f"`{id_col}`")) % len(cols) + 1).cast("int"))
    drawn = numbered.withColumn("injected", F.when(F.col("__rn_row") <= F.floor(F.col("__rn_size") * F.lit(frac)), which))
    kept = [F.when(F.col("injected") == c, F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`")
            for c in df.columns if c != "injected"]
    return drawn.select(*kept, "injected")
