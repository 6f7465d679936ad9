"""Gradient-boosted trees on binned dense features, and isotonic calibration, in numpy.

Used to fit on a bounded sample of labelled rows; fitted models are small and
are applied to whole partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BoostedTrees:
    """Trees of one depth for a 0/1 label, fitted to the logistic loss by Newton steps."""

    n_trees: int = 80
    depth: int = 3
    rate: float = 0.15
    n_bins: int = 64
    l2: float = 1.0
    min_weight: float = 2.0
    base: float = 0.0
    trees: list = field(default_factory=list)  # (feature, threshold, leaf values)

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> BoostedTrees:
        n, m = x.shape
        p = float(np.clip((y * w).sum() / w.sum(), 1e-6, 1 - 1e-6))
        self.base, self.trees = float(np.log(p / (1 - p))), []
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.n_bins + 1)[1:-1])) for j in range(m)]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
        raw = np.full(n, self.base)
        for _ in range(self.n_trees):
            q = _sigmoid(raw)
            g, h = (y - q) * w, np.maximum(q * (1 - q), 1e-6) * w
            feature = np.zeros(2 ** self.depth - 1, np.int64)
            threshold = np.full(2 ** self.depth - 1, np.inf)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, wide = 2 ** level - 1, 2 ** level
                best = np.full(wide, 1e-6)
                cut_bin = np.full(wide, self.n_bins + 1)
                for j in range(m):
                    at = (node - first) * (self.n_bins + 1) + binned[:, j]
                    size = wide * (self.n_bins + 1)
                    gs = np.bincount(at, g, size).reshape(wide, -1).cumsum(1)
                    hs = np.bincount(at, h, size).reshape(wide, -1).cumsum(1)
                    gl, hl, ga, ha = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                    gain = gl ** 2 / (hl + self.l2) + (ga - gl) ** 2 / (ha - hl + self.l2) - ga ** 2 / (ha + self.l2)
                    small = 0.25 * self.min_weight
                    gain[(hl < small) | (ha - hl < small)] = -np.inf
                    gain[:, len(cuts[j]):] = -np.inf
                    k = gain.argmax(1)
                    top = gain[np.arange(wide), k]
                    for a in np.flatnonzero(top > best):
                        best[a], cut_bin[a] = top[a], k[a]
                        feature[first + a], threshold[first + a] = j, cuts[j][k[a]]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
            leaf = node - (2 ** self.depth - 1)
            gl, hl = (np.bincount(leaf, v, 2 ** self.depth) for v in (g, h))
            values = self.rate * gl / (hl + self.l2)
            raw += values[leaf]
            self.trees.append((feature, threshold, values))
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds of every row."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, values in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += values[node - (2 ** self.depth - 1)]
        return out


@dataclass
class Isotonic:
    """Weighted isotonic regression (pool adjacent violators), linear between block centres."""

    x: np.ndarray = field(default_factory=lambda: np.zeros(1))
    y: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def fit(self, raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> Isotonic:
        blocks: list[list[float]] = []  # weight, weighted raw, weighted label
        for i in np.argsort(raw, kind="stable"):
            blocks.append([w[i], w[i] * raw[i], w[i] * y[i]])
            while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
        self.x = np.array([b[1] / b[0] for b in blocks])
        self.y = np.array([b[2] / b[0] for b in blocks])
        return self

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.x, self.y)


def calibrated(raw: np.ndarray, isotonic: Isotonic) -> np.ndarray:
    """Calibrated probability; a thousandth of the plain one keeps the order within flat stretches."""
    return np.clip(0.999 * isotonic(raw) + 0.001 * _sigmoid(raw), 0.0, 1.0)
