"""Scaling, log transforms and histograms.

Fitted parameters are a one-row DataFrame read through a scalar subquery
(computed once, reused by every reference), so applying a fit never joins
or shuffles the data it scales.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.quantiles import exact_median
from tessera.operators.clean import finite_only


def fit_standard(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """G1/G2 fit: one row ``mean_<c>, scale_<c>`` per column.

    Population std (ddof 0), NULL/NaN skipped; zero or undefined spread
    gives scale 1 (a constant column maps to 0).
    """
    aggs = []
    for c in cols:
        v = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        sd = F.stddev_pop(v)
        aggs += [F.avg(v).alias(f"mean_{c}"),
                 F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd).alias(f"scale_{c}")]
    return df.agg(*aggs)


def _params(params: DataFrame) -> Column:
    return params.select(F.struct(*params.columns).alias("p")).scalar()


def apply_standard(df: DataFrame, params: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """G1 apply: ``(x - mean) / scale``; NULL stays NULL."""
    p = _params(params)
    return df.withColumns({
        f"{c}{suffix}": (F.col(c).cast("double") - p[f"mean_{c}"]) / p[f"scale_{c}"] for c in cols})


def z_score(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """G1: fit on ``fit_on`` (default: the frame itself) and apply."""
    return apply_standard(df, fit_standard(fit_on if fit_on is not None else df, cols), cols, suffix)


def inverse_standard(df: DataFrame, params: DataFrame, col: str, fitted_col: str, out: str) -> DataFrame:
    """Back to original units: ``z * scale + mean``."""
    p = _params(params)
    return df.withColumn(out, F.col(col) * p[f"scale_{fitted_col}"] + p[f"mean_{fitted_col}"])


def log_scaled(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """``log1p`` then z-score (NULL where x <= -1)."""
    def logs(f):
        return f.withColumns({c: F.log1p(finite_only(F.col(c).cast("double"))) for c in cols})
    base = logs(df)
    return z_score(base, cols, logs(fit_on) if fit_on is not None else base)


def distribution_stages(df: DataFrame, col: str) -> DataFrame:
    """Mean, median, std of a column raw, after log1p, after log1p + z-score.

    Output ``(stage, mean, median, std)``; std is the sample std.  Missing and
    infinite values are left out.
    """
    v = finite_only(F.col(col).cast("double"))
    staged = log_scaled(df.select(v.alias("__raw"), v.alias("__log")), ["__log"])
    staged = staged.select(
        F.explode(F.array(
            F.struct(F.lit("raw").alias("stage"), F.col("__raw").alias("v")),
            F.struct(F.lit("log1p").alias("stage"), F.log1p("__raw").alias("v")),
            F.struct(F.lit("log1p_z").alias("stage"), F.col("__log").alias("v")),
        )).alias("s")).select("s.stage", "s.v")
    stats = staged.groupBy("stage").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    return stats.join(exact_median(staged, ["stage"], "v", "median"), "stage")


def histogram(df: DataFrame, col: str, n_bins: int = 20) -> DataFrame:
    """Equal-width bins over ``[min, max]`` (max falls in the last bin).

    Output ``(bin, bin_lo, bin_hi, n)`` for non-empty bins.  Missing and
    infinite values are left out.
    """
    v = finite_only(F.col(col).cast("double"))
    rng = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    p = rng.select(F.struct("lo", "hi").alias("p")).scalar()
    lo, hi = p["lo"], p["hi"]
    width = F.when(hi > lo, (hi - lo) / n_bins).otherwise(F.lit(1.0))
    b = F.least(F.floor((v - lo) / width), F.lit(n_bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                         (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "n")


def histogram_markers(df: DataFrame, col: str, n_bins: int = 20) -> DataFrame:
    """Histogram bins flagged with the bin holding the mean, the median
    and mean +/- one (sample) std."""
    h = histogram(df, col, n_bins)
    v = finite_only(F.col(col).cast("double"))
    st = df.agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
    med = exact_median(df.select(v.alias("v")), [], "v", "median")
    s = st.select(F.struct("mean", "std").alias("s")).scalar()
    m = med.select("median").scalar()

    def inside(x):
        return ((x >= F.col("bin_lo")) & ((x < F.col("bin_hi")) | (F.col("bin") == n_bins - 1))).cast("int")

    return h.select("bin", "bin_lo", "bin_hi", "n",
                    inside(s["mean"]).alias("has_mean"), inside(m).alias("has_median"),
                    inside(s["mean"] - s["std"]).alias("has_mean_minus_std"),
                    inside(s["mean"] + s["std"]).alias("has_mean_plus_std"))
