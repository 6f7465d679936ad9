"""Forests of many fits in shared passes: equal to each fit alone, near to Spark ML's forest and to a plain tree."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.forest import forest_mse
from tessera.operators.models import forest_cv_mse
from tessera.operators.study import imputation_study


def _rows(n=600):
    rng = np.random.default_rng(5)
    x, z = rng.uniform(0, 10, n), rng.integers(0, 4, n).astype(float)
    a = np.where(x > 5, 20.0, 0.0) + 3 * z + rng.normal(0, 0.5, n)
    b = x * z + rng.normal(0, 0.5, n)
    return [(int(i % 3), i, float(x[i]), float(z[i]), float(a[i]), float(b[i])) for i in range(n)]


@pytest.fixture(scope="module")
def stacked(spark):
    df = spark.createDataFrame(_rows(), "fold int, id long, x double, z double, a double, b double")
    fits = df.withColumn("fit", F.explode(F.array(F.lit(7), F.lit(0), F.lit(3))))
    fold = F.when(F.col("fit") == 7, 0).when(F.col("fit") == 0, 1).otherwise(2)
    return df, fits.withColumn("test", F.col("fold") == fold)


def _run(df, **more):
    out = forest_mse(df, "fit", "test", "id", ["x", "z"], ["a", "b"], **{"num_trees": 6, "max_depth": 4, **more})
    return {(r["fit"], r["target"]): (r["n"], r["mse"]) for r in out.collect()}


def test_fits_together_equal_fits_alone(stacked):
    _, fits = stacked
    together = _run(fits)
    assert set(together) == {(f, t) for f in (0, 3, 7) for t in "ab"}
    for f in (0, 3, 7):
        for key, (n, mse) in _run(fits.where(F.col("fit") == f)).items():
            assert together[key] == (n, pytest.approx(mse, rel=1e-9))


def test_partitions_do_not_matter(stacked):
    _, fits = stacked
    a, b = _run(fits.repartition(1)), _run(fits.repartition(7))
    assert set(a) == set(b)
    for key in a:
        assert a[key][1] == pytest.approx(b[key][1], rel=1e-9)


def test_about_as_good_as_spark_ml(stacked):
    from pyspark.ml.feature import VectorAssembler
    df, fits = stacked
    mine = _run(fits, num_trees=20, max_depth=5)
    vec = VectorAssembler(inputCols=["x", "z"], outputCol="v").transform(df)
    theirs = forest_cv_mse(vec, "v", ["a", "b"], "fold", 3, num_trees=20)
    ours = np.mean([mse for _, mse in mine.values()])
    assert ours < 1.1 * np.mean(theirs)


def test_one_split_by_hand(spark):
    # every tree finds the one step; a missing feature lies above all cuts
    rows = [(0, False, i, float(i % 2), 10.0 * (i % 2)) for i in range(200)]
    rows += [(0, True, 1000, 0.0, 0.0), (0, True, 1001, 1.0, 10.0), (0, True, 1002, None, 10.0), (0, True, 1003, math.nan, 10.0),
             (0, True, 1004, 1.0, None), (None, True, 1005, 1.0, 1.0), (9, True, 1006, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "fit int, test boolean, id long, x double, a double")
    got = forest_mse(df, "fit", "test", "id", ["x"], ["a"], num_trees=5, max_depth=3).collect()
    assert [(r["fit"], r["target"], r["n"]) for r in got] == [(0, "a", 4)]
    assert got[0]["mse"] == pytest.approx(0.0, abs=1e-18)


def test_constant_target_repeated_ids_and_no_rows(spark):
    df = spark.createDataFrame([(1, i % 4 == 0, 5, float(i), 3.0) for i in range(40)], "fit int, test boolean, id long, x double, a double")
    got = forest_mse(df, "fit", "test", "id", ["x"], ["a"], num_trees=3).first()
    assert got["n"] == 10 and got["mse"] == pytest.approx(0.0)
    assert forest_mse(df.where("false"), "fit", "test", "id", ["x"], ["a"]).collect() == []


def test_study_has_a_row_per_method(spark):
    df = spark.createDataFrame(_rows(240), "fold int, id long, x double, z double, a double, b double").drop("fold")
    out = {r["method"]: r for r in imputation_study(df, "id", ["x", "z"], ["a", "b"], n_folds=3, num_trees=5).collect()}
    assert set(out) == {"full", "zero", "mean", "median", "knn5", "knn15"}
    assert all(r["n"] == 240 and r["mean_mse"] >= out["full"]["mean_mse"] and r["std_mse"] >= 0 for r in out.values())


def test_sums_by_cell_grow_the_trees_of_the_rows(spark, monkeypatch):
    from tessera.operators import forest
    rng = np.random.default_rng(9)
    rows = [(i % 2, i % 5 == 0, i // 3, None if i % 11 == 0 else float(rng.integers(0, 6)), float(rng.integers(0, 4)), float(rng.normal()), float(i % 7))
            for i in range(1200)]
    df = spark.createDataFrame(rows, "fit int, test boolean, id long, x double, z double, a double, b double").repartition(3)
    read = []
    splits = forest._best_splits
    monkeypatch.setattr(forest, "_best_splits", lambda train, *more: (read.append(train.count()), splits(train, *more))[1])
    by_cell = _run(df)
    assert max(read) <= 2 * 12 * 7 * 4 < 960  # sums of 12 trees and up to 28 cells a fit, however many rows
    monkeypatch.setattr(forest, "ROWS_PER_CELL", 10**9)
    by_row = _run(df)
    assert set(by_cell) == set(by_row) and len(by_row) == 4
    for key in by_row:
        assert by_cell[key] == (by_row[key][0], pytest.approx(by_row[key][1], rel=1e-9))
