"""Exact nearest references for queries that no grid cell near them serves (D6): far and crowded queries.

1. **Cuts.**  A tree of median cuts is learned from a bounded sample of the references
   (``SAMPLE_PER_LEAF`` rows a leaf, at most ``MAX_LEAVES`` leaves).  It only deals the
   rows: results don't depend on it.
2. **Boxes.**  Every reference goes to its leaf; a leaf that is larger than planned is dealt
   over several slabs by hash.  One aggregate gives each slab's exact bounding box and count:
   the only table that the driver and every task hold, of a bounded number of leaves and of
   one row per ``SLAB_ROWS`` references.
3. **First visit.**  A query goes to its nearest boxes until they hold enough references;
   the distance to the last one needed is its bound.
4. **Second visit.**  It goes to every other box that isn't farther than this bound, so
   nothing nearer can be missed.  The arithmetic of a box's distance is that of a point's
   distance with smaller terms, so rounding can't put a box behind a point that it holds.

A visit is a co-group by box.  The queries of a box are dealt over blocks of
``BLOCK_QUERIES``, each with its own copy of the box's references, so a box that all
queries visit is many tasks.  Inside one, a second tree of small boxes is searched
nearest first and left as soon as no box can hold anything nearer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.session import cut_lineage

MAX_LEAVES = 4096
LEAF_ROWS = 16_384
SAMPLE_PER_LEAF = 32
SLAB_ROWS = 4 * LEAF_ROWS
BLOCK_QUERIES = 8192
_INNER_ROWS = 64
_CELLS = 4_000_000  # numbers in a matrix of queries by boxes


class Cuts:
    """A full binary tree of cuts, one level after the other: node ``i`` leads to ``2i + 1`` and ``2i + 2``."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.dim = np.zeros((1 << depth) - 1, dtype=np.int64)
        self.at = np.full((1 << depth) - 1, np.inf)
        parts = [np.arange(len(points))]
        for level in range(depth):
            below = []
            for i, rows in enumerate(parts):
                node = (1 << level) - 1 + i
                left, right = rows, rows[:0]
                if len(rows) > 1:
                    own = points[rows]
                    dim = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                    values = np.sort(own[:, dim])
                    # the cut lies below the largest value, so neither side is empty unless all are equal
                    at = values[(len(values) - 1) // 2]
                    if at < values[-1]:
                        self.dim[node], self.at[node] = dim, at
                        high = own[:, dim] > at
                        left, right = rows[~high], rows[high]
                below += [left, right]
            parts = below

    def leaves(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        every = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[every, self.dim[node]] > self.at[node])
        return node - ((1 << self.depth) - 1)


def _points(batch, cols: Sequence[str]) -> np.ndarray:
    return np.column_stack([np.asarray(batch.column(c)) for c in cols]) if batch.num_rows else np.zeros((0, len(cols)))


def _box_distance(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of every query to every box, summed in the order of the features."""
    out = None
    for i in range(q.shape[1]):
        x = q[:, i, None]
        gap = np.maximum(np.maximum(lo[None, :, i] - x, x - hi[None, :, i]), 0.0)
        out = gap * gap if out is None else out + gap * gap
    return out


def _point_distance(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    out = None
    for i in range(q.shape[1]):
        gap = q[:, i, None] - r[None, :, i]
        out = gap * gap if out is None else out + gap * gap
    return out


def _first_boxes(distance: np.ndarray, count: np.ndarray, need: int) -> np.ndarray:
    """Marks every query's nearest boxes until they hold ``need`` references."""
    order = np.argsort(distance, axis=1, kind="stable")
    held = np.cumsum(count[order], axis=1)
    wanted = held - count[order] < need
    out = np.zeros(distance.shape, dtype=bool)
    np.put_along_axis(out, order, wanted, axis=1)
    return out


def _visits(todo: DataFrame, fq: Sequence[str], boxes, need: int, again: bool) -> DataFrame:
    """``(fq, __leaf)``: the boxes of the first visit, or with ``again`` the others within ``__bound``."""
    ids, lo, hi, count = boxes
    schema = ", ".join(f"{c} double" for c in fq) + ", __leaf bigint"
    step = max(1, _CELLS // max(1, len(ids)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                q = _points(part, fq)
                distance = _box_distance(q, lo, hi)
                go = _first_boxes(distance, count, need)
                if again:
                    go = ~go & (distance <= np.asarray(part.column("__bound"))[:, None])
                row, box = np.nonzero(go)
                yield pa.RecordBatch.from_arrays([*[pa.array(q[row, i]) for i in range(len(fq))], pa.array(ids[box])],
                                                 names=[*fq, "__leaf"])

    return todo.mapInArrow(deal, schema)


def _nearest(q: np.ndarray, r: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``(query, reference, squared distance)`` up to each query's ``need``-th distance, ties included."""
    depth = max(0, int(np.ceil(np.log2(max(1, len(r)) / _INNER_ROWS))))
    leaf = Cuts(r, depth).leaves(r)
    order = np.argsort(leaf, kind="stable")
    starts = np.searchsorted(leaf[order], np.arange((1 << depth) + 1))
    kept = [i for i in range(1 << depth) if starts[i + 1] > starts[i]]
    members = [order[starts[i]:starts[i + 1]] for i in kept]
    lo = np.array([r[m].min(axis=0) for m in members])
    hi = np.array([r[m].max(axis=0) for m in members])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, _CELLS // max(len(members), _INNER_ROWS))
    for start in range(0, len(q), step):
        own = q[start:start + step]
        distance = _box_distance(own, lo, hi)
        turns = np.argsort(distance, axis=1, kind="stable")
        best = np.full((len(own), need), np.inf)
        pairs = []
        for turn in range(len(members)):
            box = turns[:, turn]
            open_ = np.nonzero(distance[np.arange(len(own)), box] <= best[:, -1])[0]
            if not len(open_):
                break
            by_box = open_[np.argsort(box[open_], kind="stable")]
            for rows in np.split(by_box, np.nonzero(np.diff(box[by_box]))[0] + 1):
                refs = members[box[rows[0]]]
                d2 = _point_distance(own[rows], r[refs])
                best[rows] = np.sort(np.concatenate([best[rows], np.partition(d2, min(need, d2.shape[1]) - 1, axis=1)[:, :need]], axis=1),
                                     axis=1)[:, :need]
                i, j = np.nonzero(d2 <= best[rows, -1][:, None])
                pairs.append((rows[i], refs[j], d2[i, j]))
        i, j, d2 = (np.concatenate(x) for x in zip(*pairs))
        last = d2 <= best[i, -1]
        found.append((i[last] + start, j[last], d2[last]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _visit(pairs: DataFrame, refs: DataFrame, fq: Sequence[str], fr: Sequence[str], need: int, carry: Sequence[str]) -> DataFrame:
    """Candidates ``(fq, carry, __d2)`` of each query in the boxes that it visits."""
    pairs = cut_lineage(pairs)
    blocks = pairs.groupBy("__leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("__blocks"))
    # one row per box: as small as the table of boxes that every task holds
    blocks = F.broadcast(cut_lineage(blocks))
    queries = pairs.join(blocks, "__leaf").select("__leaf", F.pmod(F.xxhash64(*fq), F.col("__blocks")).cast("int").alias("__block"), *fq)
    copies = refs.join(blocks, "__leaf").select(
        "__leaf", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__block"), *fr, *carry)
    kept = copies.select(*carry).schema
    out = StructType([*queries.select(*fq).schema, *kept, StructField("__d2", DoubleType())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [*fq, *kept.names, "__d2"]
        q, r = _points(left, fq), _points(right, fr)
        if not len(q) or not len(r):
            i = j = np.zeros(0, dtype=np.int64)
            d2 = np.zeros(0)
        else:
            i, j, d2 = _nearest(q, r, need)
        take = pa.array(j)
        return pa.table([*[pa.array(q[i, n]) for n in range(len(fq))],
                         *[right.column(c).take(take) for c in kept.names], pa.array(d2)], names=names)

    by = ["__leaf", "__block"]
    return queries.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(search, out)


def kd_top(todo: DataFrame, refs: DataFrame, fq: Sequence[str], fr: Sequence[str], need: int, carry: Sequence[str],
           leaf_rows: int = LEAF_ROWS, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """The ``need`` nearest references of every query of ``todo``: ``(fq, carry, __d2)``.

    ``todo`` holds distinct points in the columns ``fq``; ``refs`` is a checkpointed table
    with the points in ``fr`` and with ``carry``, whose first column is the id: ties in
    distance go to the smaller id.  All features are finite doubles.  With fewer references
    than ``need`` all of them are returned; without references there are no rows.
    """
    n = refs.count()
    if not n:
        return todo.select(*fq).join(refs.select(*carry, F.lit(0.0).alias("__d2")).limit(0), how="inner")
    depth = max(0, int(np.ceil(np.log2(min(MAX_LEAVES, max(1.0, n / leaf_rows))))))
    cuts = Cuts(np.zeros((0, len(fr))), 0)
    if depth:
        share = min(1.0, SAMPLE_PER_LEAF * (1 << depth) / n)
        sample = refs.select(*fr).sample(share, seed=17).toArrow()
        cuts = Cuts(_points(sample, fr), depth)
    leaf = F.pandas_udf(lambda *x: pd.Series(cuts.leaves(np.column_stack([c.to_numpy() for c in x]))), "bigint")
    dealt = refs.select(leaf(*fr).alias("__leaf"), *fr, *carry)
    largest = dealt.groupBy("__leaf").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    slabs = -(-largest // slab_rows)
    slab = F.pmod(F.xxhash64(*fr), F.lit(slabs))
    dealt = cut_lineage(dealt.withColumn("__leaf", F.col("__leaf") * slabs + slab))
    table = dealt.groupBy("__leaf").agg(*[F.min(c) for c in fr], *[F.max(c) for c in fr], F.count(F.lit(1))).orderBy("__leaf").collect()
    d = len(fr)
    boxes = (np.array([row[0] for row in table], dtype=np.int64), np.array([row[1:1 + d] for row in table], dtype=float),
             np.array([row[1 + d:1 + 2 * d] for row in table], dtype=float), np.array([row[-1] for row in table], dtype=np.int64))
    ranked = Window.partitionBy(*fq).orderBy("__d2", carry[0])

    def best(candidates):
        return candidates.withColumn("__rk", F.row_number().over(ranked)).where(F.col("__rk") <= need).drop("__rk")

    first = cut_lineage(best(_visit(_visits(todo.select(*fq), fq, boxes, need, False), dealt, fq, fr, need, carry)))
    bounds = first.groupBy(*fq).agg(F.max("__d2").alias("__bound"))
    second = _visit(_visits(bounds, fq, boxes, need, True), dealt, fq, fr, need, carry)
    return best(first.unionByName(second))
