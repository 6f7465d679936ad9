import numpy as np
import pytest

from tessera.operators.huber import huber_fit


def loss_slope(x, y, beta, delta):
    """Slope of the sum of Huber losses: zero at the minimum."""
    r = y - x @ beta
    return x.T @ np.clip(r, -delta, delta)


@pytest.mark.parametrize("delta", [0.3, 1.0, 50.0])
def test_the_loss_is_flat_at_the_solution(spark, delta):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    y = 2 + x @ [1.5, -0.5] + rng.standard_t(1.5, size=300)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    df = spark.createDataFrame([*rows, (None, 1.0, 5.0), (1.0, float("nan"), 5.0), (1.0, 1.0, None)], "a double, b double, y double")
    fit = huber_fit(df, ["a", "b"], "y", delta)
    beta = np.array([fit.intercept, *fit.coefficients])
    assert np.abs(loss_slope(np.column_stack([np.ones(300), x]), y, beta, delta)).max() < 1e-5 and fit.n == 300
    if delta == 50.0:
        assert np.allclose(beta, np.linalg.lstsq(np.column_stack([np.ones(300), x]), y, rcond=None)[0], atol=1e-6)
    got = df.where("y is not null and a is not null and not isnan(b)").select(fit.predict().alias("p")).collect()
    assert np.allclose([r.p for r in got], np.column_stack([np.ones(300), x]) @ beta)


def test_empty_and_dependent_columns(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 3.0 * i + 1) for i in range(10)], "a double, b double, y double")
    assert huber_fit(df.limit(0), ["a"], "y").coefficients == [0.0]
    fit = huber_fit(df, ["a", "b"], "y")
    assert abs(fit.coefficients[0] + 2 * fit.coefficients[1] - 3) < 1e-6 and abs(fit.intercept - 1) < 1e-6
