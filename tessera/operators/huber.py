"""Linear regression with the Huber loss at a fixed delta (K2).

Rows whose residual is within ``delta`` count by its square, others by its size.  The
minimum is found by iteratively reweighted normal equations: each round is one
aggregate of weighted moments (a number per pair of features, whatever the
number of rows), and the driver solves a system of the features' size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.clean import finite_only
from tessera.session import cut_lineage


@dataclass
class HuberFit:
    features: list[str]
    coefficients: list[float]
    intercept: float
    rounds: int
    n: int

    def predict(self) -> Column:
        out = F.lit(self.intercept)
        for f, b in zip(self.features, self.coefficients):
            out = out + F.col(f"`{f}`") * b
        return out


def huber_fit(df: DataFrame, features: Sequence[str], target: str, delta: float = 1.0, tol: float = 1e-10, max_rounds: int = 200) -> HuberFit:
    """Intercept and coefficients that minimise the sum of Huber losses of ``target``.

    Rows with a missing or infinite value are skipped; without rows everything is 0.
    Features that others determine share the effect (the solution of least length).
    """
    d = len(features)
    cols = [finite_only(F.col(f"`{c}`").cast("double")).alias(f"__x{i}") for i, c in enumerate([*features, target])]
    rows = cut_lineage(df.select(*cols).dropna())
    x = [F.lit(1.0), *[F.col(f"__x{i}") for i in range(d)]]
    y = F.col(f"__x{d}")
    beta, n = np.zeros(d + 1), 0
    for i in range(1, max_rounds + 1):
        residual = y
        for b, c in zip(beta.tolist(), x):
            residual = residual - c * F.lit(b)
        size = F.abs(residual)
        # the first round is least squares
        w = F.lit(1.0) if i == 1 else F.when(size > delta, delta / size).otherwise(1.0)
        weighted = rows.select(w.alias("__w"), *[c for c in rows.columns])
        pairs = [(p, q) for p in range(d + 1) for q in range(p + 1)]
        got = weighted.agg(F.count(F.lit(1)), *[F.sum(F.col("__w") * x[p] * x[q]) for p, q in pairs],
                           *[F.sum(F.col("__w") * x[p] * y) for p in range(d + 1)]).first()
        n = got[0]
        if not n:
            break
        a = np.zeros((d + 1, d + 1))
        for (p, q), v in zip(pairs, got[1:]):
            a[p, q] = a[q, p] = v
        moved = np.linalg.lstsq(a, np.array(got[1 + len(pairs):]), rcond=None)[0]
        step, beta = np.abs(moved - beta).max(), moved
        if i > 1 and step <= tol * max(1.0, np.abs(beta).max()):
            break
    return HuberFit(list(features), beta[1:].tolist(), float(beta[0]), i, n)
