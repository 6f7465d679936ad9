"""Learned operators recover planted signals; losses and fits match hand values."""

import math

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import models as K


def _frame(spark):
    rows = [(i, float(i % 20), float((i * 7) % 13), "big" if i % 20 >= 10 else "small", 2.0 * (i % 20) + 1.0)
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x double, z double, band string, y double")
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)


def test_class_model_learns_planted_split(spark):
    df = StringIndexer(inputCol="band", outputCol="label_idx", stringOrderType="alphabetAsc").fit(_frame(spark)) \
        .transform(_frame(spark))
    pred = K.class_model(reg=0.0, max_iter=200).fit(df).transform(df)
    acc = pred.where(F.col("class_pred") == F.col("label_idx")).count() / pred.count()
    assert acc > 0.95


def test_price_model_learns_planted_line(spark):
    df = _frame(spark)
    m = K.price_model(label="y", reg=0.0, max_iter=200).fit(df)
    assert m.coefficients[0] == pytest.approx(2.0, abs=1e-2)
    assert m.intercept == pytest.approx(1.0, abs=5e-2)


def test_two_target_scoring_roundtrip(spark):
    from tessera.operators.scale import apply_standard, fit_standard
    df = _frame(spark)
    params = fit_standard(df, ["y"])
    df = apply_standard(df, params, ["y"], suffix="_z")
    model = K.two_target_model(df, "band", "y_z", regs=(0.0, 0.01))
    p = params.first()
    scored = K.score_table(model, df, "id", p["mean_y"], p["scale_y"]).join(df.select("id", "band", "y"), "id")
    agree = scored.where(F.col("class_name") == F.col("band")).count() / scored.count()
    err = scored.select(F.avg(F.abs(F.col("price") - F.col("y")))).first()[0]
    assert agree > 0.95 and err < 0.5


def test_eval_losses_by_hand(spark):
    df = spark.createDataFrame([([0.5, 0.5], 0, 1.5, 1.0), ([0.25, 0.75], 1, 0.0, 3.0)],
                               "p array<double>, y int, pred double, t double")
    r = K.eval_losses(df, "p", "y", "pred", "t").first()
    assert r["ce"] == pytest.approx((-math.log(0.5) - math.log(0.75)) / 2)
    assert r["huber"] == pytest.approx((0.5 * 0.25 + (3.0 - 0.5)) / 2)
    assert r["total"] == pytest.approx(r["ce"] + r["huber"])


def test_linear_fit_and_compare(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x - 2.0, "g") for x in range(10)], "x double, y double, g string")
    r = K.linear_fit(df, "x", ["y"], ["g"]).first()
    assert r["slope"] == pytest.approx(3.0) and r["intercept"] == pytest.approx(-2.0) and r["rmse"] < 1e-9
    a = spark.createDataFrame([(1, "A", 10.0), (2, "B", 20.0)], "id int, class_name string, price double")
    b = spark.createDataFrame([(1, "A", 12.0), (2, "A", 20.0)], "id int, class_name string, price double")
    got = {(r["class_a"], r["class_b"]): (r["n"], r["mean_abs_gap"]) for r in K.compare_predictions(a, b, "id").collect()}
    assert got == {("A", "A"): (1, 2.0), ("B", "A"): (1, 0.0)}
