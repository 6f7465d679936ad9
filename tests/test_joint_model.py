import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.functions.hashing import hash_u32
from tessera.operators.joint_model import _start, fit_joint


def table(n=60, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.normal(size=2)
        band = None if i % 9 == 0 else ["a", "b", "c"][int(x[0] > 0) + int(x[0] + x[1] > 1)]
        price = [None, float("nan")][i % 2] if i % 7 == 0 else float(x @ [1.0, -2.0] + 0.3 + (20 if i % 11 == 0 else 0))
        rows.append((i, x.tolist(), band, price))
    return rows


def frame(spark, rows):
    schema = StructType([StructField("id", LongType()), StructField("features", VectorUDT()), StructField("band", StringType()),
                         StructField("price", DoubleType())])
    return spark.createDataFrame([(i, None if x is None else Vectors.dense(x), b, p) for i, x, b, p in rows], schema)


def losses(state, shapes, x, label, price, delta=1.0):
    p, at = {}, 0
    for k, s in shapes.items():
        size = int(np.prod(s))
        p[k] = state[at:at + size].reshape(s)
        at += size
    layer = np.maximum(x @ p["hidden"] + p["hidden0"], 0) if "hidden" in p else x
    logits = layer @ p["class"] + p["class0"]
    has = label >= 0
    logp = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    entropy = -logp[np.nonzero(has)[0], label[has]].mean()
    error = (x @ p["price"] + p["price0"][0] - price)[~np.isnan(price)]
    huber = np.where(np.abs(error) <= delta, error ** 2 / 2, delta * (np.abs(error) - delta / 2)).mean()
    return entropy, huber, state[at:]


def by_differences(rows, val, hidden, rounds, rate, seed=42):
    """The same fit with slopes by central differences of the written-out loss."""
    x = np.array([r[1] for r in rows])
    label = np.array([-1 if r[2] is None else "abc".index(r[2]) for r in rows])
    price = np.array([np.nan if r[3] is None else r[3] for r in rows])
    start = _start(2, 3, hidden, seed)
    shapes = {k: v.shape for k, v in start.items()}

    def total(s):
        c, h, w = losses(s, shapes, x[~val], label[~val], price[~val])
        return h / (2 * w[1] ** 2) + c / (2 * w[0] ** 2) + np.log(w[0] * w[1])

    state = np.concatenate([*[v.ravel() for v in start.values()], np.ones(2)])
    m = v = 0.0
    course, states = [], []
    for step in range(rounds + 1):
        c, h, _ = losses(state, shapes, x[val], label[val], price[val])
        course.append(c + h)
        states.append(state)
        slope = np.array([(total(state + e) - total(state - e)) / 2e-6 for e in np.eye(len(state)) * 1e-6])
        slope *= min(1.0, 1 / np.linalg.norm(slope))
        slope += 0.001 * state
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
        state = state - rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-8)
    return course, states, shapes


@pytest.mark.parametrize("hidden", [0, 3])
def test_the_fit_is_that_of_the_written_out_loss(spark, hidden):
    rows = table()
    df = frame(spark, rows)
    model = fit_joint(df, "id", "band", "price", hidden=hidden, rounds=12, learning_rate=0.05, val_pct=30)
    val = {r.id: r.v for r in df.select("id", (hash_u32(F.lit(42), F.lit("val"), "id") % 100 < 30).alias("v")).collect()}
    course, states, _ = by_differences(rows, np.array([val[r[0]] for r in rows]), hidden, 12, 0.05)
    assert np.allclose(model.history, course, atol=1e-4) and model.best_round == int(np.argmin(course))
    got = np.concatenate([*[v.ravel() for v in model.parameters.values()], model.weights])
    assert np.allclose(got, states[model.best_round], atol=1e-3)


def test_a_worse_round_gives_back_the_earlier_state(spark):
    model = fit_joint(frame(spark, table()), "id", "band", "price", rounds=40, patience=4, learning_rate=3.0)
    assert len(model.history) < 41 and model.best_round == len(model.history) - 1 - 4
    assert model.history[model.best_round] == min(model.history) < model.history[-1]
    again = fit_joint(frame(spark, table()), "id", "band", "price", rounds=model.best_round, patience=40, learning_rate=3.0)
    assert all(np.allclose(again.parameters[k], v) for k, v in model.parameters.items())


def test_missing_targets_features_and_rows(spark):
    rows = [*table(20), (100, None, "a", 1.0), (101, [float("nan"), 1.0], "a", 1.0)]
    df = frame(spark, rows)
    model = fit_joint(df, "id", "band", "price", rounds=2)
    out = {r.id: r.s for r in df.withColumn("s", model.score()).collect()}
    assert out[100].class_name is None and out[100].price is None and out[0].class_name in "abc"
    no_class = fit_joint(df.withColumn("band", F.lit(None).cast("string")), "id", "band", "price", rounds=2)
    assert no_class.classes == [] and np.abs(no_class.parameters["price"]).max() > 0
    empty = fit_joint(df.limit(0), "id", "band", "price", rounds=2)
    assert empty.history and empty.classes == []
