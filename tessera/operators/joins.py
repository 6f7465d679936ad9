"""Joins that the reference performs implicitly (dict lookups, positional zips,
first-match scans).  Small fitted tables are left to AQE, which broadcasts
them when their *measured* size is under ``spark.sql.autoBroadcastJoinThreshold``
and keeps a shuffle join otherwise; nothing here hard-codes ``broadcast()``
on a side whose size is unknown.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, value: str,
                out: str | None = None, default=None) -> DataFrame:
    """Equi lookup ``key -> value`` with a default where absent."""
    out = out or value
    lk = lookup.select(F.col(key).alias("__lk"), F.col(value).alias("__lv"))
    joined = df.join(lk, df[key].eqNullSafe(lk["__lk"]) & lk["__lk"].isNotNull(), "left")
    dflt = default if isinstance(default, Column) else F.lit(default)
    return joined.withColumn(out, F.coalesce(F.col("__lv"), dflt)).drop("__lk", "__lv")


def class_prevalence(df: DataFrame, class_col: str, out: str = "prevalence") -> DataFrame:
    """Share of each class, attached to every row.

    Pre-aggregated counts joined back (not ``count() over (partition by
    class)``, which would put a hot class into one window task).
    """
    counts = df.where(F.col(class_col).isNotNull()).groupBy(class_col).agg(F.count(F.lit(1)).alias("__cn"))
    total = df.where(F.col(class_col).isNotNull()).select(F.count(F.lit(1))).scalar()
    shares = counts.select(class_col, (F.col("__cn") / total).alias(out))
    return df.join(shares, class_col, "left")


def _log_bucket(x: Column, width: float) -> Column:
    return F.floor(F.log(x) / F.lit(width))


def tolerance_match(probe: DataFrame, lookup: DataFrame, value_col: str,
                    lookup_key: str, lookup_value: str, tol: float = 0.04,
                    pick: str = "first", out: str = "match") -> DataFrame:
    """D3: relative-tolerance theta join, one answer per probe row.

    A lookup row matches when ``abs(p - m) / p <= tol`` (p = probe value,
    m = lookup value).  ``pick="first"`` returns the smallest matching key
    (the reference's first match in key order), ``"nearest"`` the key with
    the smallest gap (ties to the smaller key).

    Plan: the *distinct* probe values are matched and joined back, so equal
    probe rows stay separate rows.  The match is an equi-join on a log-scale
    bucket.  With bucket width ``W = -ln(1 - tol)`` every match of a positive p
    lies in the bucket of p or a neighbour, so each lookup row is replicated to
    its own bucket and both neighbours and the exact test stays as a residual
    filter.  Negative p makes the ratio negative, so every lookup row with a
    value matches: ``first`` is then one scalar; ``nearest`` only looks at the
    lookup rows at or below zero and the smallest one above.  p = 0, NaN or NULL
    matches nothing.

    Returns ``probe`` with one extra column ``out`` (NULL when no match).
    """
    if pick not in ("first", "nearest"):
        raise ValueError("pick must be 'first' or 'nearest'")
    width = -math.log1p(-tol) * (1 + 1e-6)
    p = F.nanvl(F.col(value_col).cast("double"), F.lit(None).cast("double"))
    lk = lookup.select(F.col(lookup_key).alias("__k"), F.nanvl(F.col(lookup_value).cast("double"), F.lit(None).cast("double"))
                       .alias("__m")).where(F.col("__m").isNotNull() & F.col("__k").isNotNull())
    values = probe.select(p.alias("__p")).where(F.col("__p").isNotNull() & (F.col("__p") != 0)).distinct()
    up, down = values.where("__p > 0"), values.where("__p < 0")
    gap = F.struct(F.abs(F.col("__p") - F.col("__m")), F.col("__k"))
    agg = F.min("__k") if pick == "first" else F.min_by("__k", gap)
    near = lk.where("__m > 0").select("__k", "__m", F.explode(
        F.array(*[_log_bucket(F.col("__m"), width) + d for d in (-1, 0, 1)])).alias("__b"))
    found = (up.withColumn("__b", _log_bucket(F.col("__p"), width)).join(near, "__b")
             .where(F.abs(F.col("__p") - F.col("__m")) / F.col("__p") <= tol)
             .groupBy("__p").agg(agg.alias(out)))
    if pick == "first":
        below = down.select("__p", lk.select(F.min("__k")).scalar().alias(out))
    else:
        least = lk.where("__m > 0").select(F.min("__m")).scalar()
        few = lk.where((F.col("__m") <= 0) | (F.col("__m") == least)).withColumn("__b", F.lit(0))
        below = down.withColumn("__b", F.lit(0)).join(few, "__b").groupBy("__p").agg(agg.alias(out))
    found = found.unionByName(below)
    return probe.withColumn("__v", p).join(found, F.col("__v") == F.col("__p"), "left").drop("__v", "__p")


def zip_by_id(left: DataFrame, right: DataFrame, id_col: str) -> DataFrame:
    """Side-by-side columns of two frames, aligned on the key (never by position)."""
    return left.join(right, id_col, "inner")


def semi_join_sample(df: DataFrame, sample_ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose key was drawn into a sample."""
    return df.join(sample_ids.select(id_col), id_col, "left_semi")
