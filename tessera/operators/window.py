"""Ranks, per-group caps, ordered limits and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.quantiles import rows_before


def hash_order(id_col: str):
    """Deterministic pseudo-random order that does not depend on partitioning."""
    return F.md5(F.col(id_col).cast("string"))


def cap_per_class(df: DataFrame, class_col: str, id_col: str, n: int) -> DataFrame:
    """At most ``n`` rows per class without replacement.

    Rows are drawn in md5(id) order, so the draw is reproducible under any
    repartitioning.  A count of rows per class and md5 prefix (three digits, so
    at most 4,096 rows per class) finds the prefix in which the ``n``-th row of
    a class lies.  Rows before that prefix stay, rows after it go, and only
    the rows of that one prefix are ranked: a window holds about a 4,096th of a
    class, whatever ``n`` and the size of the class are.
    """
    prefix = F.substring(hash_order(id_col), 1, 3)
    counts = df.groupBy(F.col(class_col).alias("__cls"), prefix.alias("__pre")).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy("__cls").orderBy("__pre")
    upto = counts.withColumn("__upto", F.sum("__c").over(w))
    # the first prefix that fills the quota, or none: then all rows stay
    cut = upto.where(F.col("__upto") >= n).groupBy("__cls").agg(
        F.min(F.struct("__pre", (n - F.col("__upto") + F.col("__c")).alias("__left"))).alias("__cut"))
    j = df.withColumn("__pre", prefix).join(cut, F.col(class_col).eqNullSafe(F.col("__cls")), "left")
    whole = j.where(F.col("__cut").isNull() | (F.col("__pre") < F.col("__cut.__pre")))
    edge = j.where(F.col("__pre") == F.col("__cut.__pre"))
    we = Window.partitionBy(class_col, "__pre").orderBy(hash_order(id_col), F.col(id_col))
    edge = edge.withColumn("__rn", F.row_number().over(we)).where(F.col("__rn") <= F.col("__cut.__left"))
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))


def top_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """First ``n`` rows by an explicit key (a top-k, planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def union_tagged(frames: dict[str, DataFrame], tag_col: str = "split") -> DataFrame:
    """Rows of several frames with a tag; missing columns become NULL."""
    out = None
    for tag, f in frames.items():
        f = f.withColumn(tag_col, F.lit(tag))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def average_rank(df: DataFrame, col: str, out: str = "rank", group_cols: Sequence[str] = ()) -> DataFrame:
    """Average rank of ``col`` (ties share the mean of their positions).

    Ranks are computed on the *distinct values* with their counts by a
    bucketed prefix count (``rows_before``), then joined back, so neither
    duplicates nor one whole group ever sit in a single window task.
    NULL and NaN values get a NULL rank.
    """
    g = list(group_cols)
    if df.schema[col].dataType.typeName() in ("double", "float"):
        missing = F.col(col).isNull() | F.isnan(col)
    else:
        missing = F.col(col).isNull()
    vc = df.where(~missing).groupBy(*g, col).agg(F.count(F.lit(1)).alias("__n"))
    keys = [F.col(c).alias(f"__k{i}") for i, c in enumerate([*g, col])]
    ranks = rows_before(vc, g, col, "__n").select(*keys, (F.col("__before") + (F.col("__n") + 1) / 2.0).alias(out))
    on = F.col(col) == F.col(f"__k{len(g)}")
    for i, c in enumerate(g):  # a NULL group is a group
        on = on & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    return df.join(ranks, on, "left").drop(*[f"__k{i}" for i in range(len(keys))])
