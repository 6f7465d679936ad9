"""Imputation study (I6, I7): which fill method serves a model best.

Downstream score: k-fold random-forest MSE per method (the reference's
measure).  Direct score: the error of each fill against the value that was
masked, which has an exact answer and so an oracle.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.balance import kfold_ids
from tessera.operators.clean import drop_null_rows
from tessera.operators.forest import forest_mse
from tessera.operators.impute import impute_knn, impute_knn_many, inject_missing, simple_impute
from tessera.session import cut_lineage

METHODS = ("zero", "mean", "median", "knn5", "knn15")


def apply_method(df: DataFrame, id_col: str, cols: Sequence[str], method: str,
                 fit_on: DataFrame | None = None) -> DataFrame:
    if method == "zero":
        return simple_impute(df, cols, "constant", fit_on, fill_value=0.0)
    if method in ("mean", "median"):
        return simple_impute(df, cols, method, fit_on)
    if method.startswith("knn"):
        return impute_knn(df, id_col, cols, k=int(method[3:]), fit_on=fit_on)
    raise ValueError(method)


def _knn_fills(df: DataFrame, id_col: str, cols: Sequence[str], methods: Sequence[str],
               fit_on: DataFrame | None = None) -> dict[str, DataFrame]:
    """All ``knnK`` methods from one neighbour search (largest K)."""
    ks = [int(m[3:]) for m in methods if m.startswith("knn")]
    if not ks:
        return {}
    many = impute_knn_many(df, id_col, cols, ks, fit_on)
    return {f"knn{k}": many[k] for k in ks}


def imputation_error(df: DataFrame, id_col: str, cols: Sequence[str], methods: Sequence[str] = METHODS,
                     frac: float = 0.5, seed: int = 42) -> DataFrame:
    """Masked truth against filled value: ``(method, column, n, mae, rmse)``.

    The truth and the masked column's name ride along with the rows (the fills
    keep other columns), so a method costs its fill and one aggregate.
    """
    cols = list(cols)
    truth = drop_null_rows(df.select(id_col, *cols), cols)
    truth = truth.withColumns({f"__t_{c}": F.col(c).cast("double") for c in cols})
    inj = cut_lineage(inject_missing(truth, id_col, cols, frac, seed))
    knn = _knn_fills(inj, id_col, cols, methods)
    out = None
    for m in methods:
        filled = knn[m] if m in knn else apply_method(inj, id_col, cols, m)
        long = filled.where(F.col("injected").isNotNull()).select(
            F.lit(m).alias("method"), F.col("injected").alias("column"),
            F.coalesce(*[F.when(F.col("injected") == c, F.col(c) - F.col(f"__t_{c}")) for c in cols]).alias("err"))
        res = long.groupBy("method", "column").agg(
            F.count(F.lit(1)).alias("n"), F.avg(F.abs("err")).alias("mae"),
            F.sqrt(F.avg(F.col("err") * F.col("err"))).alias("rmse"))
        out = res if out is None else out.unionByName(res)
    return out


def imputation_study(df: DataFrame, id_col: str, features: Sequence[str], targets: Sequence[str],
                     methods: Sequence[str] = METHODS, n_folds: int = 5, seed: int = 42,
                     num_trees: int = 20) -> DataFrame:
    """``(method, n, mean_mse, std_mse)`` of a random forest under k-fold CV,
    one row per fill method plus ``full`` (no values masked); ``n`` rows were predicted.

    In every fold the fill is fitted on the training rows alone and applied to
    both parts, and the missing indicators are features next to the filled
    values.  The fills of the folds are independent jobs, submitted side by side;
    the forests of all methods, folds and targets grow in shared passes.
    A fold's score is the mean over the targets; E11 is the mean and spread over folds.
    """
    features, targets = list(features), list(targets)
    indicators = [f"missingindicator_{c}" for c in features]
    complete = drop_null_rows(df.select(id_col, *features, *targets), features + targets)
    complete = cut_lineage(kfold_ids(complete, id_col, n_folds, seed, out="fold"))
    inj = cut_lineage(inject_missing(complete, id_col, features, 0.5, seed).drop("injected"))
    names = ["full", *methods]

    def filled(fold: int) -> DataFrame:
        train = inj.where(F.col("fold") != fold)
        knn = _knn_fills(inj, id_col, features, methods, fit_on=train)
        out = []
        for i, m in enumerate(names):
            data = complete if m == "full" else knn[m] if m in knn else apply_method(inj, id_col, features, m, fit_on=train)
            x = [(F.col(c) if c in data.columns else F.lit(0)).cast("double").alias(c) for c in [*features, *indicators]]
            out.append(data.select(F.lit(i * n_folds + fold).alias("fit"), (F.col("fold") == fold).alias("test"), id_col, *x, *targets))
        return cut_lineage(reduce(DataFrame.unionByName, out))

    with ThreadPoolExecutor(max_workers=n_folds) as pool:
        parts = list(pool.map(filled, range(n_folds)))
    scores = forest_mse(reduce(DataFrame.unionByName, parts), "fit", "test", id_col, [*features, *indicators], targets,
                        num_trees=num_trees, seed=seed)
    folds = scores.groupBy("fit").agg(F.avg("mse").alias("mse"), F.max("n").alias("n"))
    method = F.element_at(F.array(*[F.lit(m) for m in names]), F.floor(F.col("fit") / n_folds).cast("int") + 1)
    return folds.groupBy(method.alias("method")).agg(F.sum("n").alias("n"), F.avg("mse").alias("mean_mse"), F.stddev_pop("mse").alias("std_mse"))


def study_bounds(study: DataFrame) -> DataFrame:
    """Plot bounds ``min(mse) - min(std)`` and ``max(mse + std)``."""
    return study.agg((F.min("mean_mse") - F.min("std_mse")).alias("lower"),
                     F.max(F.col("mean_mse") + F.col("std_mse")).alias("upper"))
