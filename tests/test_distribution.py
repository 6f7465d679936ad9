import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.selection import exact_quantiles, group_medians
from tessera.operators.density import bin_rule, density
from tessera.operators.positions import contiguous_folds, inject_missing_exactly, slice_rows

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("accuracy,slacks", [(10_000, (2, 64, None)), (10, (2, 64, None)), (3, (0, None)), (10, (None,))])
def test_quantiles_of_skewed_tied_and_constant_groups(spark, accuracy, slacks):
    rng = random.Random(accuracy)
    rows = [(None if i % 3 == 0 else f"g{i % 7}", rng.choice([0.0, rng.gauss(0, 10), rng.lognormvariate(0, 3)]), 5.0) for i in range(600)]
    rows += [("one", 3.0, None), ("none", None, NAN), ("ends", INF, 1.0), ("ends", -INF, 2.0), ("ends", 0.5, 3.0), ("two", INF, 1.0), ("two", INF, 2.0)]
    df = spark.createDataFrame(rows, "`prob` string, `a b` double, c double")
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {(r[0], r[1], r[2]): r[3] for r in exact_quantiles(df.withColumnRenamed("prob", "g"), ["g"], ["a b", "c"], probs, accuracy, slacks).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        for i, c in ((1, "a b"), (2, "c")):
            own = sorted(r[i] for r in rows if r[0] == g and r[i] is not None and not math.isnan(r[i]))
            for p in probs if own else ():
                at = (len(own) - 1) * p
                lo, hi = own[math.floor(at)], own[math.ceil(at)]
                want[g, c, p] = lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12, nan_ok=True) for k in want)


def test_medians_without_groups_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, NAN), (10.0, None)], "a double, b double")
    assert [tuple(r) for r in group_medians(df, [], ["a", "b"]).collect()] == [(2.0, None)]
    assert exact_quantiles(df.limit(0), [], ["a"]).count() == 0


def test_bin_rule_is_numpys(spark):
    rng = np.random.default_rng(1)
    for values in (rng.normal(size=500), rng.lognormal(0, 1, 300), np.array([0.0] * 90 + [1.0] * 10), np.arange(10) * 1.0):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (NAN,), (INF,)], "`my col` double")
        assert bin_rule(df, "my col") == len(np.histogram_bin_edges(values, "auto")) - 1
    assert bin_rule(df.limit(0), "my col") == 1 and bin_rule(spark.createDataFrame([(3,)] * 5, "v int"), "v") == 1
    far = spark.createDataFrame([(float(i),) for i in range(1000)] + [(1e12,)], "v double")
    assert bin_rule(far, "v") <= 2 * math.sqrt(1001) + 1


def test_density_is_near_the_direct_sum(spark):
    values = np.random.default_rng(2).normal(size=400)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (INF,)], "v double")
    got = density(df, "v", points=50, fine_bins=4096).orderBy("point").collect()
    h = values.std(ddof=1) * 400 ** -0.2
    x = np.linspace(values.min(), values.max(), 50)
    want = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).sum(axis=1) / (400 * h * math.sqrt(2 * math.pi))
    assert np.allclose([r.x for r in got], x) and np.allclose([r.density for r in got], want, atol=1e-3)
    assert density(df.limit(0), "v").count() == 0 and density(spark.createDataFrame([(1.0,)] * 3, "v double"), "v").count() == 0


@pytest.mark.parametrize("n,k", [(23, 5), (20, 5), (3, 5), (0, 5)])
def test_folds_are_contiguous_and_even(spark, n, k):
    df = spark.createDataFrame([(i, "x") for i in range(n)], "`row id` int, fold string")
    got = {r[0]: r[1] for r in contiguous_folds(df, [F.desc("row id")], k).collect()}
    want = {}
    for f, part in enumerate(np.array_split(np.arange(n)[::-1], k)):
        want.update({int(i): f for i in part})
    assert got == want


def test_slices_and_exact_share(spark):
    df = spark.createDataFrame([(i % 4, float(i), [i], {"a": i}) for i in range(31)], "id int, x double, `y z` array<int>, m map<string,int>")
    order = ["id", "x"]
    want = sorted((i % 4, float(i)) for i in range(31))
    assert sorted((r.id, r.x) for r in slice_rows(df, order, 5, 9).collect()) == want[5:9]
    assert sorted((r.id, r.x) for r in slice_rows(df, order, 28).collect()) == want[28:] and slice_rows(df, order, 40).count() == 0
    out = inject_missing_exactly(df, "id", ["x", "y z"], 0.5).collect()
    assert sum(r.injected is not None for r in out) == 15 and len(out) == 31
    assert all((r.x is None) == (r.injected == "x") and (r["y z"] is None) == (r.injected == "y z") for r in out)


def test_a_few_groups_are_not_a_few_tasks(spark, monkeypatch):
    # the intervals go to the rows; many groups meet theirs by a shuffle, with the same values
    from tessera.functions import selection
    from tessera.session import cut_lineage
    df = spark.createDataFrame([(None if i % 3 == 0 else i % 3, float(i * i % 101)) for i in range(300)], "g int, v double")
    rows = df.select(F.col("g").alias("__g0"), F.col("v").alias("__v0"))
    asked = cut_lineage(selection._intervals(rows, ["__g0"], 1, (0.5,), 10_000, 2, None))
    plan = selection._ranked(rows, ["__g0"], 1, asked)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    few = sorted(map(tuple, exact_quantiles(df, ["g"], ["v"], (0.1, 0.5)).collect()), key=str)
    monkeypatch.setattr(selection, "MAX_BROADCAST", 0)
    assert len(few) == 6 and few == sorted(map(tuple, exact_quantiles(df, ["g"], ["v"], (0.1, 0.5)).collect()), key=str)
