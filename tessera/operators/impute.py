"""Label repair and feature imputation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.quantiles import exact_median, global_median, global_mode
from tessera.operators.clean import nan_to_null
from tessera.operators.joins import tolerance_match
from tessera.session import cut_lineage


def price_lookup(df: DataFrame, class_col: str, price_col: str, out: str = "median_price",
                 materialize: bool = False, weight_col: str | None = None) -> DataFrame:
    """E4 as a fitted table: ``(class, median price)`` over rows with a class.

    ``materialize`` writes the fitted table once to the shared checkpoint
    folder, so the several joins that read it do not recompute it.
    """
    lk = exact_median(df.where(F.col(class_col).isNotNull()), [class_col], price_col, out, weight_col=weight_col)
    return cut_lineage(lk) if materialize else lk


def repair_labels(df: DataFrame, class_col: str, price_col: str, tol: float = 0.04,
                  pick: str = "first", class_out: str | None = None,
                  price_out: str | None = None) -> DataFrame:
    """I1 + I2: fill a missing class from the price and a missing price from the class.

    * class missing, price known -> the first class (by name) whose median
      price lies within ``tol`` of the price (``abs(p - m) / p <= tol``);
      no match -> the most frequent class (smallest of ties);
    * price missing, class known -> that class's median price; a class with
      no known price -> the overall median;
    * both missing -> the two defaults.

    Both fills read the original labels, so they do not feed each other.
    Two streams over the input: rows with a class take a left join with the
    fitted median table (a few rows per class, broadcast by AQE from its
    measured size, so no shuffle of the input); rows without a class take
    the tolerance join over their distinct prices.  Equal rows stay separate
    rows.  NaN prices are missing.  The fitted table is checkpointed once and
    read by both.
    """
    class_out = class_out or class_col
    price_out = price_out or price_col
    df = nan_to_null(df, [price_col])
    c, p = F.col(class_col), F.col(price_col)
    # every statistic comes from one pre-aggregated table of (class, price, n)
    cells = cut_lineage(df.groupBy(c.alias(class_col), p.alias(price_col)).agg(F.count(F.lit(1)).alias("__cells")))
    lookup = price_lookup(cells, class_col, price_col, "__med", materialize=True, weight_col="__cells")
    # the two fitted defaults: one small job, then plain literals in both streams
    dflt = df.sparkSession.range(1).select(global_mode(cells, class_col, "__cells").alias("c"),
                                           global_median(cells, price_col, weight_col="__cells").alias("p")).first()
    dflt_class = F.lit(dflt["c"]).cast(df.schema[class_col].dataType)
    dflt_price = F.lit(dflt["p"]).cast("double")
    keep = [x for x in df.columns if x not in (class_out, price_out)]

    def finish(frame: DataFrame, cls: Column, prc: Column) -> DataFrame:
        return frame.select(*keep, cls.alias(class_out), prc.alias(price_out))

    with_class = df.where(c.isNotNull()).join(
        lookup.withColumnRenamed(class_col, "__c"), c == F.col("__c"), "left")
    with_class = finish(with_class, c, F.coalesce(p, F.col("__med"), dflt_price))
    no_class = tolerance_match(df.where(c.isNull()), lookup, price_col, class_col, "__med", tol, pick, "__match")
    no_class = finish(no_class, F.coalesce(F.col("__match"), dflt_class), F.coalesce(p, dflt_price))
    return with_class.unionByName(no_class)


def impute_class_by_price(df: DataFrame, class_col: str, price_col: str, tol: float = 0.04,
                          pick: str = "first", out: str = "class_filled") -> DataFrame:
    """I1 alone: adds ``out``; the price column is left as it is."""
    rep = repair_labels(df, class_col, price_col, tol, pick, class_out=out, price_out="__p")
    return rep.drop("__p")


def impute_price_by_class(df: DataFrame, class_col: str, price_col: str,
                          out: str = "price_filled") -> DataFrame:
    """I2 alone: adds ``out``; the class column is left as it is."""
    df = nan_to_null(df, [price_col])
    c, p = F.col(class_col), F.col(price_col)
    cells = cut_lineage(df.where(p.isNotNull()).groupBy(class_col, price_col).agg(F.count(F.lit(1)).alias("__cells")))
    lookup = price_lookup(cells, class_col, price_col, "__med", weight_col="__cells").withColumnRenamed(class_col, "__c")
    dflt = global_median(cells, price_col, weight_col="__cells")
    known = df.where(p.isNotNull() | c.isNull()).withColumn(out, F.coalesce(p, dflt))
    todo = (df.where(p.isNull() & c.isNotNull()).join(lookup, c == F.col("__c"), "left")
            .withColumn(out, F.coalesce(F.col("__med"), dflt)).drop("__c", "__med"))
    return known.unionByName(todo)


# ---- feature imputation (I3-I5) -------------------------------------------

def _indicator_cols(fit: DataFrame, cols) -> list[str]:
    """Columns that hold a NULL in the fit data (one bounded row collected)."""
    flags = fit.select(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    return [c for c in cols if flags[c]]


def simple_impute(df: DataFrame, cols, strategy: str = "mean", fit_on: DataFrame | None = None,
                  fill_value: float = 0.0, add_indicator: bool = True,
                  indicator_prefix: str = "missingindicator_") -> DataFrame:
    """Constant / mean / median fill plus missing-indicator columns.

    Statistics come from ``fit_on`` (default: ``df``); an indicator column is
    added for each column that had a NULL at fit time.  The statistics are
    one row read by a scalar subquery, so applying them never shuffles.
    """
    from tessera.functions.quantiles import exact_median

    cols = list(cols)
    df = nan_to_null(df, cols)  # NaN is missing, as in the reference's imputers
    fit = nan_to_null(fit_on, cols) if fit_on is not None else df
    if strategy == "constant":
        stats = {c: F.lit(fill_value) for c in cols}
    elif strategy == "mean":
        row = fit.select(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("s")).scalar()
        stats = {c: row[c] for c in cols}
    elif strategy == "median":
        long = fit.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("kv")
        ).select("kv.*")
        med = exact_median(long, ["column"], "v", "m")
        row = med.agg(F.map_from_entries(F.collect_list(F.struct("column", "m"))).alias("m")).scalar()
        stats = {c: row[c] for c in cols}
    else:
        raise ValueError("strategy must be constant, mean or median")
    ind = _indicator_cols(fit, cols) if add_indicator else []
    out = df.withColumns({f"{indicator_prefix}{c}": F.col(c).isNull().cast("int") for c in ind})
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), stats[c]) for c in cols})


def impute_knn(df: DataFrame, id_col: str, cols, k: int = 5, fit_on: DataFrame | None = None,
               add_indicator: bool = True, indicator_prefix: str = "missingindicator_") -> DataFrame:
    """I4: k-nearest-neighbour fill with NaN-aware Euclidean distance.

    For a row missing column ``f``: donors are fit rows with ``f`` present;
    distance uses the features both rows have, scaled by
    ``sqrt(n_features / n_shared)``; the ``k`` nearest donors (ties to the
    smaller id) are averaged.  No donor sharing a feature -> the fit mean.
    Rows with the same id, or none, are rows of their own.

    Rows are grouped by missing-value pattern, and each (receiver pattern,
    donor pattern) pair is one exact grid-blocked KNN join in the shared
    subspace (see ``neighbors.knn_join``) -- never all pairs.
    Complete rows stream through untouched.
    """
    return impute_knn_many(df, id_col, cols, [k], fit_on, add_indicator, indicator_prefix)[k]


def impute_knn_many(df: DataFrame, id_col: str, cols, ks, fit_on: DataFrame | None = None,
                    add_indicator: bool = True, indicator_prefix: str = "missingindicator_"
                    ) -> dict[int, DataFrame]:
    """I4 for several ``k`` at once: one neighbour search with the largest
    ``k`` serves every smaller one (the first k of the k_max nearest)."""
    from tessera.operators.neighbors import knn_join

    cols = list(cols)
    ks = sorted(set(int(k) for k in ks))
    kmax = ks[-1]
    def numbered(frame):
        """Every row gets a key of its own (ids may repeat or be missing), and as a donor one that ties by the id."""
        keyed = cut_lineage(nan_to_null(frame, cols).withColumn("__key", F.monotonically_increasing_id()))
        return keyed.withColumn("__tie", F.struct(F.col(id_col).alias("id"), F.col("__key").alias("n")))

    df = numbered(df)
    fit = numbered(fit_on) if fit_on is not None else df
    n_feat = len(cols)
    pat = F.array(*[F.col(c).isNotNull() for c in cols])
    # missing-value patterns: at most 2^len(cols) rows reach the driver
    fit_pats = [tuple(r[0]) for r in fit.select(pat.alias("p")).distinct().collect()]
    df_pats = [tuple(r[0]) for r in df.select(pat.alias("p")).distinct().collect()]
    means = fit.select(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("s")).scalar()
    ind = _indicator_cols(fit, cols) if add_indicator else []

    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    complete = df.where(~any_null)
    partial = df.where(any_null)

    filled = {k: partial for k in ks}
    for j, f in enumerate(cols):
        recv_pats = [p for p in df_pats if not p[j]]
        if not recv_pats:
            continue
        parts = []
        for rp in recv_pats:
            for dp in fit_pats:
                if not dp[j]:
                    continue
                shared = [c for i, c in enumerate(cols) if rp[i] and dp[i]]
                if not shared:
                    continue
                q = partial.where(pat == F.array(*[F.lit(b) for b in rp]))
                r = fit.where(pat == F.array(*[F.lit(b) for b in dp]))
                nn = knn_join(q, r, "__key", "__tie", shared, kmax, scale=math.sqrt(n_feat / len(shared)),
                              out_id="__donor", r_carry=[f])
                parts.append(nn.withColumnRenamed(f"nb_{f}", "__fv"))
        for k in ks:
            if parts:
                nn = parts[0]
                for p in parts[1:]:
                    nn = nn.unionByName(p)
                w = Window.partitionBy("__key").orderBy("dist", "__donor")
                nn = nn.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") <= k)
                est = nn.groupBy("__key").agg(F.avg("__fv").alias(f"__est_{j}"))
                filled[k] = filled[k].join(est, "__key", "left")
            else:
                filled[k] = filled[k].withColumn(f"__est_{j}", F.lit(None).cast("double"))
            filled[k] = filled[k].withColumn(f"__est_{j}", F.coalesce(F.col(f"__est_{j}"), means[f]))

    def finish(frame, has_est):
        frame = frame.withColumns({f"{indicator_prefix}{c}": F.col(c).isNull().cast("int") for c in ind})
        exprs = {}
        for j, c in enumerate(cols):
            est = F.col(f"__est_{j}") if has_est and f"__est_{j}" in frame.columns else F.lit(None)
            exprs[c] = F.coalesce(F.col(c).cast("double"), est)
        out = frame.withColumns(exprs)
        return out.drop("__key", "__tie", *[x for x in out.columns if x.startswith("__est_")])

    return {k: finish(complete, False).unionByName(finish(filled[k], True)) for k in ks}


def inject_missing(df: DataFrame, id_col: str, cols, frac: float = 0.5, seed: int = 42) -> DataFrame:
    """Blank one feature in about ``frac`` of the rows.

    Row choice and feature choice are md5 hashes of ``(seed, id)``, so the
    result is the same under any partitioning and has a SQL twin.  Adds
    ``injected`` (the blanked column name or NULL).
    """
    from tessera.functions.hashing import hash_u32

    cols = list(cols)
    pick = hash_u32(F.lit(seed), F.col(id_col))
    chosen = (pick % 1000000) < int(round(frac * 1000000))
    which = F.when(chosen, F.element_at(F.array(*[F.lit(c) for c in cols]),
                                        (hash_u32(F.lit(seed), F.lit("col"), F.col(id_col)) % len(cols) + 1).cast("int")))
    out = df.withColumn("injected", which)
    return out.withColumns({c: F.when(F.col("injected") == c, F.lit(None).cast(df.schema[c].dataType))
                            .otherwise(F.col(c)) for c in cols})
