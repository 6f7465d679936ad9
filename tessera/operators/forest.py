"""Regression forests of many fits grown together (K8).

A study fits the same forest again and again: per fill method, per fold, per target.  Here the
rows of all fits stand in one table of binned features, and a level of *all* trees is grown
by one pass: tasks add up weighted histograms of ``(fit, tree, node, feature, bin)``, Spark sums
them, and windows over the bins find every node's best split.  What reaches the driver is the
split table, whose size follows from the parameters (fits, targets, trees, ``2 ** max_depth``), not from rows.

Rows of a fit with the same bins take the same way down every tree.  Where the bins of all features
make a grid with far fewer cells than the fit has rows, one pass adds up every tree's drawn rows by
cell, and the levels are grown on these sums, whose number follows from the grid, not from rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

ROWS_PER_TASK = 250_000
#: A grid has at most a cell for that many training rows of the largest fit, and over all fits and trees at most so many sums.
ROWS_PER_CELL, MAX_SUMS = 4, 4_000_000
#: Rows of a fit that a task adds up in one go.
_AT_ONCE = 50_000
#: Chances that a row is drawn 0, at most 1, 2, ... times by a Poisson draw of mean 1.
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1, dtype=float)) for k in range(12)])
#: A split has to take this share of the node's variance away.
_LEAST_GAIN = 1e-9


@dataclass
class _Trees:
    """Splits of all fits: arrays ``[fit, slot, node]``, root 1, children ``2n`` and ``2n + 1``."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def nodes(self, fit: int, bins: np.ndarray, depth: int) -> np.ndarray:
        """``[slot, row]``: the node that each row (``bins[row, feature]``) has reached after ``depth`` splits."""
        return self.nodes_in(fit, np.arange(self.feature.shape[1])[:, None], bins, depth)

    def nodes_in(self, fit: int, slot: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
        """The same in the trees ``slot``: one for each row, or a column of trees for all rows."""
        row = np.arange(len(bins))
        node = np.ones(np.broadcast_shapes(slot.shape, row.shape), np.int64)
        for _ in range(depth):
            f = self.feature[fit][slot, node]
            right = bins[row, np.maximum(f, 0)] > self.cut[fit][slot, node]
            node = np.where(f >= 0, 2 * node + right, node)
        return node


@dataclass
class _Grid:
    """Cells of the features' bins, of which a feature has ``shape[feature]``."""

    shape: list[int]

    @property
    def size(self) -> int:
        return math.prod(self.shape)

    def cell(self, bins: np.ndarray) -> np.ndarray:
        return np.ravel_multi_index(tuple(bins.T.astype(np.int64)), self.shape)

    def bins(self, cell: np.ndarray) -> np.ndarray:
        return np.stack(np.unravel_index(cell, self.shape), axis=1).astype(np.int16)


def _draws(h: np.ndarray, slot: int, seed: int) -> np.ndarray:
    """How often a tree draws each row, a hash of the row's id and the tree."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * (np.uint64(slot) + np.uint64(1 + seed))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    chance, n = (z >> np.uint64(11)) / float(1 << 53), np.zeros(len(h), np.int8)
    for least in _POISSON:
        n += chance >= least
    return n.astype(float)


def _drawn(h: np.ndarray, n_slots: int, seed: int) -> np.ndarray:
    """``[slot, row]``: the same for all trees."""
    return np.stack([_draws(h, slot, seed) for slot in range(n_slots)])


def forest_mse(df: DataFrame, fit_col: str, test_col: str, id_col: str, features: Sequence[str], targets: Sequence[str],
               num_trees: int = 20, max_depth: int = 5, max_bins: int = 32, seed: int = 42) -> DataFrame:
    """``(<fit_col>, target, n, mse)``: every fit's forest, grown on its training rows, on its test rows.

    ``fit_col`` is an integer; the fits share passes but nothing else, so a fit's result is that of the
    fit alone.  A tree sees a Poisson bootstrap of the rows (drawn by a hash of ``id_col``) and all features.
    Features are cut at up to ``max_bins - 1`` quantiles of the fit's training rows; NULL and NaN lie above
    all cuts.  Rows without a fit, without a flag or with a missing target are skipped.  A fit without
    training or test rows has no result.
    """
    n_f, n_t, n_slots = len(features), len(targets), len(targets) * num_trees
    x, y = [f"x{i}" for i in range(n_f)], [f"y{i}" for i in range(n_t)]
    missing = F.lit(None).cast("double")
    rows = df.select(F.col(f"`{fit_col}`").cast("int").alias("fit"), F.col(f"`{test_col}`").alias("test"), F.xxhash64(F.lit(seed), F.col(f"`{id_col}`")).alias("h"),
                     *[F.nanvl(F.col(f"`{c}`").cast("double"), missing).alias(a) for c, a in zip(features, x)],
                     *[F.nanvl(F.col(f"`{c}`").cast("double"), missing).alias(a) for c, a in zip(targets, y)])
    rows = cut_lineage(rows.dropna(subset=["fit", "test", *y]))  # read for the cuts and for the bins

    shares = [i / max_bins for i in range(1, max_bins)]
    known = rows.where(~F.col("test")).groupBy("fit").agg(F.count(F.lit(1)).alias("n"), *[F.avg(a).alias(a) for a in y],
                                                          *[F.percentile_approx(a, shares, 10_000).alias(a) for a in x]).collect()
    number = {r["fit"]: i for i, r in enumerate(sorted(known, key=lambda r: r["fit"]))}
    result = f"`{fit_col}` int, target string, n long, mse double"
    if not number:
        return df.sparkSession.createDataFrame([], result)
    n_fits = len(number)
    cuts = {r["fit"]: [np.unique(r[a] or []) for a in x] for r in known}
    centre = np.zeros((n_fits, n_t))
    for r in known:
        centre[number[r["fit"]]] = [r[a] for a in y]

    def bins_of(pdf: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray, np.ndarray]]:
        """Per fit: its number, its rows, their bins ``[row, feature]`` and their targets less the fit's means ``[row, target]``."""
        for fit, part in pdf.groupby("fit"):
            if fit in number:
                i = number[fit]
                bins = [np.searchsorted(c, part[a].to_numpy(float), side="left").astype(np.int16) for a, c in zip(x, cuts[fit])]
                yield i, part, np.stack(bins, axis=1), part[y].to_numpy(float) - centre[i]

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, part, bins, off in bins_of(pdf):
                yield pd.DataFrame({"fit": np.int32(i), "test": part["test"].to_numpy(), "h": part["h"].to_numpy(),
                                    **dict(zip(x, bins.T)), **dict(zip(y, off.T))})

    most = max(r["n"] for r in known)
    grid = _Grid([max(len(cuts[fit][j]) for fit in cuts) + 1 for j in range(n_f)])
    gridded = grid.size * ROWS_PER_CELL <= most and grid.size * n_fits * n_slots <= MAX_SUMS

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}  # per fit: 3 x slots x cells, at most MAX_SUMS of each whatever the rows
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def add(fit: int) -> None:
            h, cell, off = (np.concatenate(a) for a in zip(*waiting.pop(fit)))
            into = sums.setdefault(fit, np.zeros((3, n_slots, grid.size)))
            for slot in range(n_slots):  # tree by tree: a tree's numbers stay in the processor's cache
                w, v = _draws(h, slot, seed), off[:, slot // num_trees]
                for k, weight in enumerate((w, w * v, w * v * v)):
                    into[k, slot] += np.bincount(cell, weight, grid.size)

        for pdf in batches:
            for i, part, bins, off in bins_of(pdf):
                waiting.setdefault(i, []).append((part["h"].to_numpy(), grid.cell(bins), off))
                if sum(len(h) for h, _, _ in waiting[i]) >= _AT_ONCE:
                    add(i)
        for i in list(waiting):
            add(i)
        for i, s in sums.items():
            slot, cell = np.nonzero(s[0])
            yield pd.DataFrame({"fit": i, "slot": slot, "cell": cell, **{c: a[slot, cell] for c, a in zip(("w", "wy", "wyy"), s)}})

    if gridded:
        sums = rows.where(~F.col("test")).mapInPandas(summed, "fit int, slot int, cell int, w double, wy double, wyy double")
        train = sums.repartition("fit", "slot").groupBy("fit", "slot", "cell").agg(*[F.sum(c).alias(c) for c in ("w", "wy", "wyy")])
        train = cut_lineage(train.sortWithinPartitions("fit"))
    else:
        schema = "fit int, test boolean, h long, " + ", ".join([f"{a} short" for a in x] + [f"{a} double" for a in y])
        salts = max(1, -(-most // ROWS_PER_TASK))
        table = rows.mapInPandas(binned, schema)
        table = cut_lineage(table.repartitionById(n_fits * salts, (F.col("fit") * salts + F.pmod("h", F.lit(salts))).cast("int")))
        train = table.where(~F.col("test"))

    trees = _Trees(np.full((n_fits, n_slots, 2 << max_depth), -1, np.int16), np.zeros((n_fits, n_slots, 2 << max_depth), np.int16),
                   np.zeros((n_fits, n_slots, 2 << max_depth)))
    for depth in range(max_depth):
        found = _best_splits(train, trees, depth, x, y, num_trees, max_bins, seed, grid if gridded else None).collect()
        if not found:
            break
        grown = _Trees(trees.feature.copy(), trees.cut.copy(), trees.value.copy())
        for r in found:
            at, s = (r["fit"], r["slot"]), r["best"]
            node = r["node"]
            grown.feature[at][node], grown.cut[at][node] = s["feature"], s["bin"]
            grown.value[at][2 * node], grown.value[at][2 * node + 1] = s["left"], s["right"]
            if node == 1:
                grown.value[at][1] = r["mean"]
        trees = grown

    def guess(fit: int, bins: np.ndarray) -> np.ndarray:
        node = trees.nodes(fit, bins, max_depth)
        return trees.value[fit][np.arange(n_slots)[:, None], node].reshape(n_t, num_trees, -1).mean(axis=1)

    def error(fit: int, off: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"fit": fit, "target": range(n_t), "n": off.shape[1], "sse": (off * off).sum(axis=1)})

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for fit, part in pdf.groupby("fit"):
                yield error(fit, guess(fit, part[x].to_numpy(np.int16)) - part[y].to_numpy(float).T)

    def errors_by_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_cells: dict[int, np.ndarray] = {}
        for pdf in batches:
            for i, _, bins, off in bins_of(pdf):
                if i not in of_cells:
                    of_cells[i] = guess(i, grid.bins(np.arange(grid.size)))
                yield error(i, of_cells[i][:, grid.cell(bins)] - off.T)

    tested = rows.where("test") if gridded else table.where("test")
    total = tested.mapInPandas(errors_by_cell if gridded else errors, "fit int, target int, n long, sse double").groupBy("fit", "target").agg(
        F.sum("n").alias("n"), (F.sum("sse") / F.sum("n")).alias("mse"))
    fits = F.array(*[F.lit(k) for k in number])
    return total.select(F.get(fits, F.col("fit")).alias(fit_col), F.get(F.array(*[F.lit(t) for t in targets]), F.col("target")).alias("target"), "n", "mse")


def _best_splits(train: DataFrame, trees: _Trees, depth: int, x: Sequence[str], y: Sequence[str], num_trees: int, max_bins: int, seed: int,
                 grid: _Grid | None = None) -> DataFrame:
    """``(fit, slot, node, mean, best)``: the best split of every node of one level that has one.

    With a ``grid``, ``train`` has the sums of its cells in place of rows.
    """
    n_slots, first, n_nodes = len(y) * num_trees, 1 << depth, 1 << depth

    def drawn_rows(fit: int, part: pd.DataFrame):
        """Slot, node, bins and weighted sums (of 1, target, its square) of every row that a tree draws."""
        bins = part[x].to_numpy(np.int16)
        node = trees.nodes(fit, bins, depth)
        w = _drawn(part["h"].to_numpy(), n_slots, seed)
        v = np.repeat(part[y].to_numpy(float).T, num_trees, axis=0)
        slot, row = np.nonzero((node >= first) & (w > 0))
        w, v = w[slot, row], v[slot, row]
        return slot, node[slot, row], bins[row], (w, w * v, w * v * v)

    def cell_sums(fit: int, part: pd.DataFrame):
        """The same of every cell that a tree draws rows of."""
        slot, bins = part["slot"].to_numpy(), grid.bins(part["cell"].to_numpy())
        node = trees.nodes_in(fit, slot, bins, depth)
        here = node >= first
        return slot[here], node[here], bins[here], tuple(part[c].to_numpy()[here] for c in ("w", "wy", "wyy"))

    def histograms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}  # per fit: slots x nodes x features x bins x 3, whatever the rows
        for pdf in batches:
            for fit, part in pdf.groupby("fit"):
                slot, node, bins, weights = (cell_sums if grid else drawn_rows)(fit, part)
                place = (slot * n_nodes + node - first) * len(x)
                into = sums.setdefault(fit, np.zeros((3, n_slots * n_nodes * len(x) * max_bins)))
                for f in range(len(x)):
                    cell = (place + f) * max_bins + bins[:, f]
                    for k, weight in enumerate(weights):
                        into[k] += np.bincount(cell, weight, into.shape[1])
        for fit, s in sums.items():
            cell = np.flatnonzero(s[0])
            rest, b = np.divmod(cell, max_bins)
            rest, f = np.divmod(rest, len(x))
            slot, node = np.divmod(rest, n_nodes)
            yield pd.DataFrame({"fit": fit, "slot": slot, "node": node + first, "feature": f, "bin": b,
                                "w": s[0][cell], "wy": s[1][cell], "wyy": s[2][cell]})

    keys = ["fit", "slot", "node", "feature"]
    cells = train.mapInPandas(histograms, "fit int, slot int, node int, feature int, bin int, w double, wy double, wyy double")
    # hashed by node from the start: the sums, both windows and the choice of the split share one shuffle
    cells = cells.repartition("fit", "slot", "node").groupBy(*keys, "bin").agg(*[F.sum(c).alias(c) for c in ("w", "wy", "wyy")])
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    c = cells.select(*keys, "bin", F.sum("w").over(upto).alias("wl"), F.sum("wy").over(upto).alias("sl"),
                     F.sum("w").over(whole).alias("w"), F.sum("wy").over(whole).alias("s"), F.sum("wyy").over(whole).alias("q"))
    c = c.withColumns({"wr": F.col("w") - F.col("wl"), "sr": F.col("s") - F.col("sl"), "mean": F.col("s") / F.col("w")}).where("wr > 0")
    spread = F.col("q") - F.col("s") * F.col("mean")
    gain = F.col("sl") * F.col("sl") / F.col("wl") + F.col("sr") * F.col("sr") / F.col("wr") - F.col("s") * F.col("mean")
    # sums differ in their last bits with the order of adding: gains equal to 9 places are ties, which go to the first feature and cut
    c = c.where(spread > _LEAST_GAIN * F.col("q")).withColumn("gain", F.round(gain / spread, 9)).where(F.col("gain") >= _LEAST_GAIN)
    split = F.struct("feature", "bin", (F.col("sl") / F.col("wl")).alias("left"), (F.col("sr") / F.col("wr")).alias("right"))
    return c.groupBy("fit", "slot", "node").agg(F.max_by(split, F.struct(F.col("gain"), -F.col("feature"), -F.col("bin"))).alias("best"),
                                                F.min_by("mean", F.struct("feature", "bin")).alias("mean"))
