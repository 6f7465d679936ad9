"""Bins by rule and density curves.

Both read the column once for its range, spread and count and once for bin counts.  The
curve is the bin counts convolved with a Gaussian, so its cost depends on the number of bins
and points, not on the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.selection import exact_quantiles
from tessera.operators.clean import finite_only


def bin_rule(df: DataFrame, col: str) -> int:
    """Number of equal bins: the narrower width of Freedman-Diaconis' and Sturges' rule.

    The former's width is at least half of the square root rule's, so far outliers ask for
    twice the root of the count at most.  Missing and infinite values are left out; without
    values or without spread there is one bin.
    """
    v = finite_only(F.col(f"`{col}`").cast("double"))
    rows = df.select(v.alias("v")).where("v is not null")
    lo, hi, n = rows.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not n or hi == lo:
        return 1
    q = {r["prob"]: r["value"] for r in exact_quantiles(rows, [], ["v"], (0.25, 0.75)).collect()}
    sturges = (hi - lo) / (math.log2(n) + 1)
    diaconis = 2 * (q[0.75] - q[0.25]) / n ** (1 / 3)
    return math.ceil((hi - lo) / min(max(diaconis, (hi - lo) / math.sqrt(n) / 2), sturges))


def density(df: DataFrame, col: str, points: int = 200, fine_bins: int = 1024, bandwidth: float | None = None) -> DataFrame:
    """``(point, x, density)`` at ``points`` places from the least to the largest value.

    The column is counted in ``fine_bins`` equal bins; a bin's rows stand at its middle.  The
    default bandwidth is Scott's: the sample's standard deviation by the fifth root of the
    count.  Missing and infinite values are left out; without spread there are no rows.
    """
    v = finite_only(F.col(f"`{col}`").cast("double"))
    rows = df.select(v.alias("v")).where("v is not null")
    p = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("sd"), F.count("v").alias("n"))
    p = p.select(F.struct("*").alias("p")).scalar()
    width = (p["hi"] - p["lo"]) / fine_bins
    h = F.lit(float(bandwidth)) if bandwidth else p["sd"] / F.pow(p["n"].cast("double"), F.lit(0.2))
    place = F.least(F.floor((F.col("v") - p["lo"]) / width), F.lit(fine_bins - 1))
    counts = rows.where(p["hi"] > p["lo"]).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    each = counts.select("n", (p["lo"] + (F.col("bin") + 0.5) * width).alias("middle"),
                         F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = p["lo"] + F.col("point") * (p["hi"] - p["lo"]) / (points - 1)
    z = (x - F.col("middle")) / h
    share = F.col("n") * F.exp(-z * z / 2) / (math.sqrt(2 * math.pi) * h * p["n"])
    return each.groupBy("point").agg(F.sum(share).alias("density")).select("point", x.alias("x"), "density")
