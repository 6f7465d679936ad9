"""Association statistics over all column pairs in one job.

Pairs of *columns* are generated per row with ``explode`` (bounded by the
number of columns, no join), so every pair's contingency table or rank
correlation comes out of one scan and one map-side-combined shuffle.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from tessera.functions.quantiles import rows_before
from tessera.operators.clean import any_null
from tessera.session import cut_lineage


def column_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    """All unordered pairs, in list order (a driver loop over *names* only)."""
    return list(itertools.combinations(cols, 2))


def _pairs_long(df: DataFrame, pairs: Sequence[tuple[str, str]], cast: str) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                 F.col(a).cast(cast).alias("a"), F.col(b).cast(cast).alias("b"))
        for a, b in pairs])).alias("p")).select("p.*")


def crosstabs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E9 for every pair: ``(var1, var2, a, b, n)``, rows with a NULL in the pair dropped."""
    long = _pairs_long(df, column_pairs(cols), "string")
    return (long.where(F.col("a").isNotNull() & F.col("b").isNotNull())
            .groupBy("var1", "var2", "a", "b").agg(F.count(F.lit(1)).alias("n")))


def chi_square(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """chi-square statistic of independence for every pair.

    ``(var1, var2, chi2, dof, n_total, r, k)``.  Zero cells are handled through
    the marginals (their expected counts add ``n - sum(E over observed
    cells)``), so no cell grid is materialised; for 2x2 tables Yates'
    correction is applied (each |O - E| shrinks by min(0.5, |O - E|)) and
    the four cells are enumerated explicitly.
    """
    # the long crosstab feeds five aggregates/joins: compute it once
    ct = cut_lineage(crosstabs(df, cols))
    keys = ["var1", "var2"]
    rows = ct.groupBy(*keys, "a").agg(F.sum("n").alias("ra"))
    colm = ct.groupBy(*keys, "b").agg(F.sum("n").alias("cb"))
    tot = ct.groupBy(*keys).agg(F.sum("n").alias("n_total"), F.count_distinct("a").alias("r"),
                                F.count_distinct("b").alias("k"))
    cells = ct.join(rows, [*keys, "a"]).join(colm, [*keys, "b"]).join(tot, keys)
    e = F.col("ra") * F.col("cb") / F.col("n_total")
    plain = cells.where((F.col("r") - 1) * (F.col("k") - 1) != 1).groupBy(*keys).agg(
        (F.sum((F.col("n") - e) ** 2 / e) + F.first("n_total") - F.sum(e)).alias("chi2"))
    # 2x2: all four cells (rows x cols inside the pair: exactly 2 x 2)
    small = tot.where((F.col("r") == 2) & (F.col("k") == 2))
    grid = rows.join(small.select(*keys, "n_total"), keys).join(colm, keys) \
        .join(ct.select(*keys, "a", "b", F.col("n").alias("o")), [*keys, "a", "b"], "left")
    eg = F.col("ra") * F.col("cb") / F.col("n_total")
    dev = F.greatest(F.abs(F.coalesce(F.col("o"), F.lit(0)) - eg) - 0.5, F.lit(0.0))
    yates = grid.groupBy(*keys).agg(F.sum(dev * dev / eg).alias("chi2"))
    chi = plain.unionByName(yates)
    return tot.join(chi, keys).select(
        *keys, F.when((F.col("r") - 1) * (F.col("k") - 1) == 0, F.lit(0.0)).otherwise(F.col("chi2")).alias("chi2"),
        ((F.col("r") - 1) * (F.col("k") - 1)).alias("dof"), "n_total", "r", "k")


def cramers_v(df: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """bias-corrected Cramer's V for every pair, kept when >= threshold.

    phi2 = chi2/n; phi2c = max(0, phi2 - (k-1)(r-1)/(n-1));
    r~ = r - (r-1)^2/(n-1), k~ likewise; V = sqrt(phi2c / min(k~-1, r~-1));
    0 when min(k-1, r-1) = 0, phi2 = 0 or min(k~-1, r~-1) = 0.
    Sorted by V descending (then names).
    """
    chi = chi_square(df, cols)
    n, r, k = F.col("n_total"), F.col("r"), F.col("k")
    phi2 = F.col("chi2") / n
    phi2c = F.greatest(F.lit(0.0), phi2 - (k - 1) * (r - 1) / (n - 1))
    rc = r - (r - 1) * (r - 1) / (n - 1)
    kc = k - (k - 1) * (k - 1) / (n - 1)
    den = F.least(kc - 1, rc - 1)
    v = (F.when((F.least(k - 1, r - 1) == 0) | (phi2 == 0), F.lit(0.0))
         .when(den == 0, F.lit(0.0))
         .otherwise(F.sqrt(phi2c / den)))
    out = chi.select("var1", "var2", v.alias("cramers_v"))
    return out.where(F.col("cramers_v") >= threshold).orderBy(F.desc("cramers_v"), "var1", "var2")


def _rank_cells(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(var1, var2, a, b, n, ra, rb)``: distinct value pairs per column pair
    with their multiplicity and the average ranks of each side.

    The input is scanned and exploded once; everything after works on the
    pre-aggregated cells (materialized once), so repeated values never
    travel twice and no consumer re-reads the input.
    """
    keys = ["var1", "var2"]
    long = _pairs_long(df, pairs, "double").withColumns(
        {s: F.nanvl(F.col(s), F.lit(None).cast("double")) for s in ("a", "b")})
    long = long.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    cells = cut_lineage(long.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("n")))
    out = cells
    for side in ("a", "b"):
        vc = cells.where(F.col(side).isNotNull()).groupBy(*keys, side).agg(F.sum("n").alias("__n"))
        rk = rows_before(vc, keys, side, "__n").select(
            *keys, side, (F.col("__before") + (F.col("__n") + 1) / 2.0).alias(f"r{side}"))
        out = out.join(rk, [*keys, side], "left")
    return out


def spearman_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.1,
                   nulls: str = "drop", with_p: bool = True) -> DataFrame:
    """Spearman rho for every numeric pair; keep |rho| >= threshold.

    Output ``(var1, var2, sign, abs_rho, n[, p_value])`` sorted by |rho|.
    Ranks are average ranks over the rows where both values are present
    (``nulls="drop"``); ``"propagate"`` returns NULL rho for a pair with any
    missing value, as the reference's default did.  rho is the Pearson
    correlation of the ranks.

    A column without missing values has the same ranks in every pair with
    another such column: it is ranked once, and all these pairs are one
    aggregate.  Only pairs with a missing value are exploded and ranked by pair.
    """
    if nulls not in ("drop", "propagate"):
        raise ValueError("nulls must be 'drop' or 'propagate'")
    cols = list(cols)
    flags = df.select(*[F.max(any_null(df, [c]).cast("int")).alias(c) for c in cols]).first()
    whole = [c for c in cols if not flags[c]]
    pairs = column_pairs(cols)
    own = [p for p in pairs if not (p[0] in whole and p[1] in whole)]
    parts = []
    if len(whole) > 1:
        parts.append(_rho_of_ranked_columns(df, whole, [p for p in pairs if p not in own]))
    if own and nulls == "drop":
        parts.append(_rho_by_pair(df, own))
    if not parts:
        parts.append(df.sparkSession.createDataFrame([], "var1 string, var2 string, rho double, n bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.where(F.abs("rho") >= threshold)
    cols_out = ["var1", "var2", F.signum("rho").alias("sign"), F.abs("rho").alias("abs_rho"), "n"]
    if with_p:
        cols_out.append(t_test_p(F.col("rho"), F.col("n")).alias("p_value"))
    return out.select(*cols_out).orderBy(F.desc("abs_rho"), "var1", "var2")


def _rho_of_ranked_columns(df: DataFrame, cols: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(var1, var2, rho, n)`` for columns without missing values."""
    ranked = df.select(*[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)])
    at = {c: i for i, c in enumerate(cols)}
    for i in range(len(cols)):
        vc = ranked.groupBy(f"__v{i}").agg(F.count(F.lit(1)).alias("__n"))
        rank = rows_before(vc, [], f"__v{i}", "__n").select(
            F.col(f"__v{i}").alias("__k"), (F.col("__before") + (F.col("__n") + 1) / 2.0).alias(f"__r{i}"))
        ranked = ranked.join(rank, F.col(f"__v{i}") == F.col("__k")).drop("__k")
    wide = ranked.agg(F.count(F.lit(1)).alias("n"), *[
        F.corr(f"__r{at[a]}", f"__r{at[b]}").alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col(f"c{k}"))).alias("rho"),
                 F.col("n")) for k, (a, b) in enumerate(pairs)])).alias("p")).select("p.*").where(~F.isnan("rho") & F.col("rho").isNotNull())


def _rho_by_pair(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(var1, var2, rho, n)`` over the rows where both values of a pair are present, weighted by cell multiplicity."""
    rc = _rank_cells(df, pairs)
    n, ra, rb = F.col("n"), F.col("ra"), F.col("rb")
    agg = rc.groupBy("var1", "var2").agg(
        F.sum(n).alias("__w"), F.sum(n * ra).alias("__sa"), F.sum(n * rb).alias("__sb"),
        F.sum(n * ra * ra).alias("__saa"), F.sum(n * rb * rb).alias("__sbb"), F.sum(n * ra * rb).alias("__sab"))
    w = F.col("__w")
    cov = F.col("__sab") - F.col("__sa") * F.col("__sb") / w
    va = F.col("__saa") - F.col("__sa") * F.col("__sa") / w
    vb = F.col("__sbb") - F.col("__sb") * F.col("__sb") / w
    rho = F.when((va <= 0) | (vb <= 0), F.lit(None)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cov / F.sqrt(va * vb))))
    return agg.select("var1", "var2", rho.alias("rho"), w.alias("n"))


def pearson_matrix(df: DataFrame, cols: Sequence[str], lower_only: bool = True) -> DataFrame:
    """pairwise-complete Pearson correlation in long form
    ``(var1, var2, i, j, corr)``; ``lower_only`` keeps i >= j (diagonal too)."""
    cols = list(cols)
    aggs, meta = [], []

    def value(c):
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if lower_only and i < j:
                continue
            aggs.append(F.corr(value(a), value(b)).alias(f"c{i}_{j}"))
            meta.append((a, b, i, j))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.lit(i).alias("i"), F.lit(j).alias("j"),
                 F.col(f"c{i}_{j}").alias("corr")) for a, b, i, j in meta])).alias("m")).select("m.*")


# ---- Student-t tail for the Spearman p-value (runs on one row per pair) ----

def _betacf(a, b, x, iters=300):
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < 1e-300, 1e-300, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        d = 1.0 / d
        h *= d * c
    return h


def betainc(a, b, x):
    """Regularised incomplete beta I_x(a, b), vectorised (continued fraction)."""
    from math import lgamma
    a = np.asarray(a, float)
    b = np.asarray(b, float)
    x = np.clip(np.asarray(x, float), 0.0, 1.0)
    lg = np.vectorize(lgamma)
    with np.errstate(divide="ignore", invalid="ignore"):
        bt = np.exp(lg(a + b) - lg(a) - lg(b) + a * np.log(x) + b * np.log1p(-x))
        direct = bt * _betacf(a, b, x) / a
        flipped = 1.0 - bt * _betacf(b, a, 1.0 - x) / b
    res = np.where(x < (a + 1) / (a + b + 2), direct, flipped)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, res))


@pandas_udf(DoubleType())
def _t_two_sided(rho: pd.Series, n: pd.Series) -> pd.Series:
    r = rho.to_numpy(float)
    df = n.to_numpy(float) - 2
    with np.errstate(divide="ignore", invalid="ignore"):
        t2 = r * r * df / np.maximum(1 - r * r, 0.0)
        x = df / (df + t2)
        p = betainc(df / 2.0, 0.5, x)
    p = np.where(np.abs(r) >= 1.0, 0.0, p)
    p = np.where((df <= 0) | np.isnan(r), np.nan, p)
    return pd.Series(p)


def t_test_p(rho, n):
    """Two-sided p of ``t = rho * sqrt((n-2)/(1-rho^2))`` with n-2 degrees of freedom."""
    return _t_two_sided(rho, n)


__all__ = ["column_pairs", "crosstabs", "chi_square", "cramers_v", "spearman_pairs",
           "pearson_matrix", "betainc", "t_test_p"]
