"""Cases that went wrong silently once: far and clustered points, equal rows, NaN, NULL groups, odd level names."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.functions.quantiles import exact_median, group_modes, rows_before
from tessera.operators import aggregate, association, balance, clean, encode, impute, joins, models, neighbors, profile, scale, window

NAN = float("nan")


def knn_brute(queries, refs, k):
    out = []
    for q, *x in queries:
        d = sorted((math.dist(x, y), r) for r, *y in refs)
        out += [(q, r, round(dist, 9), i + 1) for i, (dist, r) in enumerate(d[:k])]
    return sorted(out)


def knn(spark, queries, refs, k, d):
    cols = [f"f{i}" for i in range(d)]
    schema = "id long, " + ", ".join(f"{c} double" for c in cols)
    got = neighbors.knn_join(spark.createDataFrame(queries, schema), spark.createDataFrame(refs, schema), "id", "id", cols, k)
    return sorted((r.id, r.neighbor, round(r.dist, 9), r["rank"]) for r in got.collect())


def test_knn_keeps_queries_far_from_every_reference(spark):
    refs = [(i, i / 300) for i in range(300)]
    queries = [(1, 1000.0), (2, -5e6), (3, 0.5)]
    assert knn(spark, queries, refs, 3, 1) == knn_brute(queries, refs, 3)


def test_knn_of_clusters_with_an_outlier(spark):
    rng = random.Random(1)
    refs = [(i, rng.gauss(0, 1e-3), rng.gauss(0, 1e-3)) for i in range(400)] + [(9999, 1e6, 1e6)]
    queries = refs[::40]
    assert knn(spark, queries, refs, 4, 2) == knn_brute(queries, refs, 4)


def test_first_cell_width_follows_the_densest_cell(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.random() * 1e-3,) for _ in range(2000)] + [(1e3,)], "x double")
    width = neighbors._first_width(df, ["x"], [0.0], 1e3, 100, [])
    most = df.groupBy(F.floor(F.col("x") / width)).count().agg(F.max("count")).first()[0]
    assert most <= 100


def test_knn_with_many_features(spark):
    rng = random.Random(3)
    refs = [(i, *[rng.random() for _ in range(9)]) for i in range(150)]
    queries = refs[:12]
    assert knn(spark, queries, refs, 3, 9) == knn_brute(queries, refs, 3)


def test_knn_with_missing_and_infinite_features_ends(spark):
    refs = [(i, float(i)) for i in range(20)]
    bad = [(100, NAN), (101, float("inf")), (102, None)]
    assert knn(spark, [(1, 3.2), *bad], refs + bad, 2, 1) == knn_brute([(1, 3.2)], refs, 2)
    df = spark.createDataFrame([(i, float(i % 7), "a" if i % 2 else "b") for i in range(30)] + [(50, NAN, "a")], "id long, x double, label string")
    assert all(r.id != 50 for r in balance.edited_nn(df, "id", ["x"], "label").collect())


def test_knn_fill_of_an_isolated_row_uses_its_nearest_donors(spark):
    rows = [(i, float(i), float(i)) for i in range(1000)] + [(5000, None, 1e5)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    got = impute.impute_knn(df, "id", ["x", "y"], k=5, add_indicator=False).where("id = 5000").first()
    assert got.x == 997.0


def test_tolerance_match_keeps_equal_rows(spark):
    probe = spark.createDataFrame([(100.0,), (100.0,), (None,), (None,), (NAN,), (-5.0,), (-5.0,), (0.0,)], "p double")
    lookup = spark.createDataFrame([("b", 101.0), ("a", 99.0), ("c", -4.0), ("d", 7.0)], "k string, m double")
    for pick, want in (("first", ["a", "a", "a", "a", None, None, None, None]), ("nearest", ["a", "a", "c", "c", None, None, None, None])):
        got = joins.tolerance_match(probe, lookup, "p", "k", "m", pick=pick)
        assert sorted((r.match for r in got.collect()), key=str) == sorted(want, key=str)


def test_tolerance_match_equals_the_definition(spark):
    rng = random.Random(5)
    values = [rng.choice([-1, 1]) * rng.choice([0.5, 3.0, 3.1, 10.0, 99.0, 100.0, 104.0]) for _ in range(40)]
    table = [(f"k{i}", rng.choice([-1, 1, 1]) * rng.choice([0.5, 3.05, 9.7, 100.0, 102.0])) for i in range(8)]
    for pick in ("first", "nearest"):
        want = []
        for p in values:
            hits = [(abs(p - m), k) for k, m in table if abs(p - m) / p <= 0.04]
            want.append((p, (min(k for _, k in hits) if pick == "first" else min(hits)[1]) if hits else None))
        df = joins.tolerance_match(spark.createDataFrame([(v,) for v in values], "p double"),
                                   spark.createDataFrame(table, "k string, m double"), "p", "k", "m", pick=pick)
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_label_repair_keeps_every_row(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 10.0), (None, 10.1), (None, 10.1), (None, 10.1), ("a", NAN)], "c string, p double")
    got = sorted(map(tuple, impute.repair_labels(df, "c", "p").collect()))
    assert got == [("a", 10.0)] * 3 + [("a", 10.1)] * 3


def test_adasyn_serves_every_smaller_class(spark):
    rng = random.Random(7)
    rows = [(i, rng.random() * 3, rng.random() * 3, "abc"[0 if i < 60 else 1 if i < 90 else 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, x double, y double, label string")
    out = balance.adasyn(df, "id", ["x", "y"], "label", with_originals=True)
    n = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert n["a"] == 60 and abs(n["b"] - 60) <= 15 and abs(n["c"] - 60) <= 10
    by_id = {r[0]: r for r in rows}
    for r in out.where("j > 0").collect():
        assert by_id[r.src_id][3] == r.label and 0 <= r.x <= 3 and 0 <= r.y <= 3


def test_adasyn_of_well_separated_classes_adds_nothing(spark):
    rows = [(i, float(i), "a") for i in range(20)] + [(100 + i, 1e6 + i, "b") for i in range(8)]
    df = spark.createDataFrame(rows, "id long, x double, label string")
    assert {r.g for r in balance.adasyn_weights(df, "id", ["x"], "label").collect()} == {0}
    assert balance.adasyn(df, "id", ["x"], "label").count() == 0


def test_prefix_counts_cut_the_real_strings(spark):
    df = spark.createDataFrame([("g", f"Customer#{i:06d}", i % 3 + 1) for i in range(500)] + [(None, f"Customer#{i:06d}", 1) for i in range(40)],
                               "g string, v string, n long")
    direct, ranged = (sorted(map(tuple, rows_before(df, ["g"], "v", "n", max_per_task=m).select("g", "v", "__before").collect()), key=str)
                      for m in (10 ** 6, 20))
    assert direct == ranged and len(direct) == 540
    parts = rows_before(df, ["g"], "v", "n", max_per_task=20)
    assert parts.count() == 540


@pytest.mark.parametrize("cap", [5, 10 ** 6])
def test_medians_and_modes_of_a_null_group(spark, cap):
    rows = [(None, float(i)) for i in range(11)] + [("a", float(i)) for i in range(4)] + [("a", NAN), ("a", None), ("b", NAN)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert {r.g: r["median"] for r in exact_median(df, ["g"], "v", max_per_task=cap).collect()} == {None: 5.0, "a": 1.5}
    assert group_modes(df, ["g"], "v").where("g is null").count() == 11


def test_null_groups_in_describe_and_linear_fit(spark):
    rows = [(None, 1.0, 3.0), (None, 2.0, 5.0), (None, 3.0, 7.0), ("a", 1.0, 1.0), ("a", NAN, 2.0), ("a", 2.0, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    d = {(r.g, r["column"]): r for r in aggregate.describe(df, ["x", "y"], ["g"]).collect()}
    assert d[None, "y"].n == 3 and d[None, "y"]["median"] == 5.0 and d["a", "x"].n == 2
    f = {r.g: r for r in models.linear_fit(df, "x", ["y"], ["g"]).collect()}
    assert f[None].slope == pytest.approx(2) and f[None].intercept == pytest.approx(1) and f[None].rmse == pytest.approx(0, abs=1e-9)
    assert f["a"].slope == pytest.approx(2)


def test_linear_fit_error_equals_numpy(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=200), rng.normal(size=200)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x double, y double")
    b, a = np.polyfit(x, y, 1)
    r, = models.linear_fit(df, "x", ["y"]).collect()
    assert (r.slope, r.intercept) == pytest.approx((b, a)) and r.rmse == pytest.approx(np.sqrt(((y - a - b * x) ** 2).mean()))


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 4.0), (3, 4.0, 8.0), (4, NAN, 1.0), (5, None, 1.0)], "id long, x double, y double")
    assert profile.has_null(df, ["x", "y"]).first().asDict() == {"x": 1, "y": 0}
    assert profile.column_profile(df, ["x"]).first().n_null == 2
    assert sum(r.n for r in scale.histogram(df, "x", 2).collect()) == 3
    markers = scale.histogram_markers(df, "x", 2).collect()
    assert sum(r.has_mean for r in markers) == 1 and sum(r.has_median for r in markers) == 1
    assert {r.stage: round(r.mean, 6) for r in scale.distribution_stages(df, "x").collect()}["raw"] == round(7 / 3, 6)
    assert {r.id: r["rank"] for r in window.average_rank(df, "x").collect()} == {1: 1.0, 2: 2.0, 3: 3.0, 4: None, 5: None}
    assert [r.x for r in clean.fill_constant(df, {"x": 0.0}).orderBy("id").collect()] == [1.0, 2.0, 4.0, 0.0, 0.0]
    corr = {(r.var1, r.var2): r["corr"] for r in association.pearson_matrix(df, ["x", "y"]).collect()}
    assert corr["y", "x"] == pytest.approx(1.0)


def test_one_hot_of_many_and_oddly_named_levels(spark):
    from pyspark.ml.functions import vector_to_array

    levels = [f"L{i:04d}" for i in range(600)] + ["St. Louis", "Red", "red", "", "a`b"]
    df = spark.createDataFrame([(i, v, float(i)) for i, v in enumerate(levels)] + [(9000, None, 1.0)], "id long, c string, x double")
    m, names = encode.feature_matrix(df, "id", one_hot_cols=["c"], passthrough=["x"])
    at = {r.name: r.position for r in names.collect()}
    got = {r.id: r.a for r in m.select("id", vector_to_array("features").alias("a")).collect()}
    assert len(at) == 607 and all(len(a) == 607 for a in got.values())
    for i, v in enumerate(levels):
        assert got[i][at[f"c_{v}"]] == 1.0 and sum(got[i][:606]) == 1.0 and got[i][606] == float(i)
    assert got[9000][at["c___null__"]] == 1.0
    unseen = spark.createDataFrame([(1, "new", 0.0)], "id long, c string, x double")
    m2, _ = encode.feature_matrix(unseen, "id", one_hot_cols=["c"], dummy_cols=["c"], fit_on=df)
    row = m2.select(vector_to_array("features").alias("a")).first().a
    assert len(row) == 606 + 604 and sum(row) == 0
    wide = encode.one_hot(df, "c")
    assert len(wide.columns) == 2 + 606


def test_cap_per_class_beyond_a_thousand(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") < 8000, "a").when(F.col("id") < 8990, "b").alias("c"))
    got = {r.c: r["count"] for r in window.cap_per_class(df, "c", "id", 5000).groupBy("c").count().collect()}
    assert got == {"a": 5000, "b": 990, None: 10}
    few = window.cap_per_class(df, "c", "id", 7).where("c = 'a'").select("id")
    want = df.where("c = 'a'").orderBy(F.md5(F.col("id").cast("string")), "id").limit(7).select("id")
    assert {r.id for r in few.collect()} == {r.id for r in want.collect()}


def test_no_machine_local_checkpoints_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
    assert session.is_local_master("local[4]") and not session.is_local_master("local-cluster[3,2,1000]")


def test_price_head_learns_from_rows_without_a_class(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = [(float(i), "a" if i % 2 else "b", i * 0.1) if i < 20 else (float(i), None, i * 0.1) for i in range(60)]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(rows, "x double, c string, z double"))
    model = models.two_target_model(df, "c", "z")
    out = model.stages[-1].transform(df.where("x > 50")).select("z", "price_pred").collect()
    assert all(abs(r.z - r.price_pred) < 0.5 for r in out)


@pytest.mark.parametrize("size", [1000, 1001])
def test_value_maps_on_both_sides_of_inlining(spark, size):
    df = spark.createDataFrame([(i, f"k{i}") for i in range(5)] + [(9, None), (10, "other")], "id long, k string")
    out = clean.map_values(df, "k", {f"k{i}": f"v{i}" for i in range(size)})
    assert {r.id: r.k for r in out.collect()} == {**{i: f"v{i}" for i in range(5)}, 9: None, 10: "other"}


def test_spearman_of_whole_and_gappy_columns(spark):
    import pandas as pd

    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, 200).astype(float)
    data = pd.DataFrame({"a": x, "b": x * 2 + rng.normal(size=200), "c": rng.normal(size=200), "d": np.where(rng.random(200) < 0.2, np.nan, x)})
    df = spark.createDataFrame(data)
    want = data.corr(method="spearman")
    got = {(r.var1, r.var2): (r.sign * r.abs_rho, r.n) for r in association.spearman_pairs(df, list("abcd"), 0.0).collect()}
    assert len(got) == 6
    for (u, v), (rho, n) in got.items():
        assert rho == pytest.approx(want.loc[u, v], abs=1e-9) and n == data[[u, v]].dropna().shape[0]
    both = association.spearman_pairs(df, list("abcd"), 0.0, nulls="propagate").collect()
    assert {(r.var1, r.var2) for r in both} == {("a", "b"), ("a", "c"), ("b", "c")}
