"""One fit of the class and the price head with learned loss weights and patience (K1-K3, K5).

The loss is ``price / (2 wp^2) + class / (2 wc^2) + log(wc wp)`` with the mean Huber loss of the
rows that have a price, the mean cross-entropy of those that have a class, and both weights
learned.  A round is one pass over the rows: every task adds up its gradients in numpy and
sends one number per parameter; Spark sums them by parameter.  The driver holds the parameters
and takes the step (Adam, with weight decay and a cap on the gradient's length).  The same pass
measures the loss on the validation rows, and the parameters of the best round are kept.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_u32
from tessera.operators.clean import finite_only
from tessera.session import cut_lineage

_STEP = (0.9, 0.999, 1e-8)  # Adam's usual decay rates and floor


@dataclass
class JointModel:
    """Parameters and the course of the fit; ``weights`` are the learned ``(class, price)`` loss weights."""

    classes: list
    parameters: dict[str, np.ndarray]
    weights: tuple[float, float]
    best_round: int
    history: list[float] = field(default_factory=list)

    def score(self, features: str | Column = "features") -> Column:
        """A struct ``(class_name, probability, price)`` for a column of feature vectors; NULL features give NULLs."""
        p, classes = self.parameters, list(self.classes)

        @F.pandas_udf("class_idx int, probability double, price double")
        def apply(x: pd.Series) -> pd.DataFrame:
            out = pd.DataFrame({"class_idx": 0, "probability": np.nan, "price": np.nan}, index=x.index)
            given = x.notna().to_numpy()
            if given.any():
                m = np.stack(x[given].to_numpy())
                logits, _ = _logits(p, m)
                share = _softmax(logits)
                out.loc[given, "class_idx"] = share.argmax(axis=1)
                out.loc[given, "probability"] = share.max(axis=1)
                out.loc[given, "price"] = m @ p["price"] + p["price0"][0]
            return out

        s = apply(_array(features))
        name = F.get(F.array(*[F.lit(c) for c in classes]), s["class_idx"])
        return F.struct(F.when(s["probability"].isNotNull(), name).alias("class_name"),
                        s["probability"].alias("probability"), s["price"].alias("price"))


def _array(features: str | Column) -> Column:
    c = F.col(f"`{features}`") if isinstance(features, str) else features
    return F.when(c.isNotNull(), vector_to_array(c))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _logits(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class scores and the layer before them (the features, if there is no hidden layer)."""
    layer = np.maximum(x @ p["hidden"] + p["hidden0"], 0.0) if "hidden" in p else x
    return layer @ p["class"] + p["class0"], layer


def _start(d: int, n_classes: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    if hidden:
        p["hidden"], p["hidden0"] = rng.uniform(-1, 1, (d, hidden)) / np.sqrt(d), np.zeros(hidden)
        p["class"] = rng.uniform(-1, 1, (hidden, n_classes)) / np.sqrt(hidden)
    else:
        p["class"] = np.zeros((d, n_classes))
    return p | {"class0": np.zeros(n_classes), "price": np.zeros(d), "price0": np.zeros(1)}


def _sums(p: dict[str, np.ndarray], x: np.ndarray, label: np.ndarray, price: np.ndarray, val: np.ndarray, delta: float) -> np.ndarray:
    """Loss sums and counts (class, price; training, validation), then the training gradients in the order of ``p``."""
    logits, layer = _logits(p, x)
    top = logits.max(axis=1)
    has_class, has_price = label >= 0, ~np.isnan(price)
    rows = np.arange(len(x))
    entropy = np.where(has_class, top + np.log(np.exp(logits - top[:, None]).sum(axis=1)) - logits[rows, np.maximum(label, 0)], 0.0)
    error = np.where(has_price, x @ p["price"] + p["price0"][0] - price, 0.0)
    size = np.abs(error)
    huber = np.where(size <= delta, 0.5 * error * error, delta * (size - 0.5 * delta))
    head = []
    for use in (~val, val):
        head += [entropy[use].sum(), (has_class & use).sum(), huber[use].sum(), (has_price & use).sum()]
    slope = _softmax(logits)
    slope[rows, np.maximum(label, 0)] -= 1
    slope[~(has_class & ~val)] = 0
    pull = np.where(has_price & ~val, np.clip(error, -delta, delta), 0.0)
    g = {"class": layer.T @ slope, "class0": slope.sum(axis=0), "price": x.T @ pull, "price0": np.array([pull.sum()])}
    if "hidden" in p:
        back = (slope @ p["class"].T) * (layer > 0)
        g |= {"hidden": x.T @ back, "hidden0": back.sum(axis=0)}
    return np.concatenate([np.array(head, dtype=float), *[g[k].ravel() for k in p]])


def _pass(rows: DataFrame, p: dict[str, np.ndarray], delta: float) -> np.ndarray:
    width = 8 + sum(v.size for v in p.values())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                total += _sums(p, x, b.column("label").to_numpy(), b.column("price").to_numpy(),
                               b.column("val").to_numpy(zero_copy_only=False), delta)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["i", "g"])

    out = np.zeros(width)
    for r in rows.mapInArrow(add, "i bigint, g double").groupBy("i").agg(F.sum("g").alias("g")).collect():
        out[r["i"]] = r["g"]
    return out


def fit_joint(df: DataFrame, id_col: str, class_col: str, price_col: str, features: str = "features", hidden: int = 0, rounds: int = 100,
              patience: int = 30, learning_rate: float = 0.1, decay: float = 0.001, clip: float = 1.0, delta: float = 1.0,
              val_pct: int = 20, seed: int = 42) -> JointModel:
    """Fits both heads; ``hidden`` units (0: none) stand before the class head.

    ``val_pct`` percent of the rows, by md5 of the id, are for validation (all rows are, too, where that
    leaves none).  The fit ends after ``rounds`` steps or once ``patience`` rounds bring no smaller
    validation loss (mean cross-entropy plus mean Huber loss), and the best round's state is returned.
    Rows without features or with a missing or infinite one are skipped; rows with one target teach
    that head alone.  A target that no row has leaves its head at the start.  Classes are in
    ascending order.  There is no dropout: a pass over all rows needs no noise to repeat.
    """
    x = _array(features)
    ok = x.isNotNull() & F.forall(x, lambda v: finite_only(v).isNotNull())
    src = df.where(ok)
    classes = [r[0] for r in src.select(F.col(f"`{class_col}`").alias("c")).where("c is not null").distinct().orderBy("c").collect()]
    label = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(f"`{class_col}`")) - 1, F.lit(-1)) if classes else F.lit(-1)
    price = F.coalesce(finite_only(F.col(f"`{price_col}`").cast("double")), F.lit(float("nan")))
    val = hash_u32(F.lit(seed), F.lit("val"), F.col(f"`{id_col}`")) % 100 < val_pct
    rows = cut_lineage(src.select(x.alias("x"), label.cast("bigint").alias("label"), price.alias("price"), val.alias("val"))).persist()
    first = rows.select(F.size("x")).first()
    p = _start(first[0] if first else 0, max(1, len(classes)), hidden, seed)
    loss_weights = np.ones(2)
    best = JointModel(classes, p, (1.0, 1.0), 0)
    least, since, history = np.inf, 0, []
    first_moment, second_moment = 0.0, 0.0
    for step in range(rounds + 1):
        got = _pass(rows, p, delta)
        train, check = got[:4], got[4:8] if got[5] + got[7] else got[:4]
        loss = check[0] / max(check[1], 1) + check[2] / max(check[3], 1)
        history.append(float(loss))
        if loss < least:
            least, since = loss, 0
            best = JointModel(classes, p, (float(loss_weights[0]), float(loss_weights[1])), step)
        else:
            since += 1
        if since >= patience or step == rounds:
            break
        mean = np.array([train[0] / max(train[1], 1), train[2] / max(train[3], 1)])
        g, at = [], 8
        for k, v in p.items():
            head, n = (1, train[3]) if k.startswith("price") else (0, train[1])
            g.append(got[at:at + v.size] / max(n, 1) / (2 * loss_weights[head] ** 2))
            at += v.size
        g.append(1 / loss_weights - mean / loss_weights ** 3)
        state = np.concatenate([*[v.ravel() for v in p.values()], loss_weights])
        slope = np.concatenate(g)
        slope *= min(1.0, clip / max(np.sqrt((slope * slope).sum()), 1e-300))
        slope = slope + decay * state
        first_moment = _STEP[0] * first_moment + (1 - _STEP[0]) * slope
        second_moment = _STEP[1] * second_moment + (1 - _STEP[1]) * slope * slope
        state = state - learning_rate * (first_moment / (1 - _STEP[0] ** (step + 1))) / (
            np.sqrt(second_moment / (1 - _STEP[1] ** (step + 1))) + _STEP[2])
        moved, at = {}, 0
        for k, v in p.items():
            moved[k] = state[at:at + v.size].reshape(v.shape)
            at += v.size
        # a weight at zero would divide by it
        p, loss_weights = moved, np.maximum(state[at:], 1e-3)
    rows.unpersist()
    best.history = history
    return best
