"""Exact k-nearest-neighbour join without all-pairs (D6), for numeric features.

Plan, per call:

1. **Collapse duplicates.**  Reference points at the same location tie in
   distance for every query, and ties go to the smaller id, so only the
   ``cap = k (+1 when a query may meet itself)`` smallest ids of a location
   can ever be chosen.  Each location keeps at most ``cap`` ids
   (``row_number() <= cap`` is a WindowGroupLimit, trimmed map-side), so a
   hot location holding a third of all rows costs ``cap`` rows.  Queries
   are collapsed to distinct locations the same way.
2. **Grid blocking.**  Cells over (at most ``_GRID_DIMS``) features.  A query
   location probes its own cell and the ones around it: an equi-join on the
   cell key, no cartesian product.  With more features the cells use those
   that spread most: a distance over some features is a lower bound of the
   whole one, so the test below stays exact.
3. **Cell width from the densest cell.**  One job counts the references per
   cell for a ladder of widths, each a quarter of the one before; the widest
   one without a crowded cell is the first.  Clusters and far outliers so
   change the width, not the answer, and no cell holds more than a bounded
   number of references as long as locations differ.
4. **Exactness test.**  Every point within distance ``W`` of the query sits
   in the probed cells, so a query whose ``cap``-th best candidate is within
   ``W`` is final.  All others, those without any candidate too, are answered
   by ``kd_probe``: boxes of a tree of cuts, pruned by their distance.  A
   search within classes (``by``) goes on with wider cells instead, until its
   cells cover the whole bounding box.  Deduplicated inputs and each round's
   candidates and open queries are checkpointed to the shared checkpoint
   folder, so no round is recomputed.
5. **Expand back** to query rows, drop self matches, keep the first ``k``
   by ``(distance, id)``.

Missing (NULL, NaN) and infinite features take a row out on both sides.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.clean import finite_only
from tessera.operators.kd_probe import kd_top
from tessera.session import cut_lineage

_GRID_DIMS = 3
_PER_CELL = 32  # references in a cell at most, as a multiple of the neighbours asked for
_LADDER = 16  # widths tried: down to a 4 ** 16th of the bounding box


def _sqdist(fa: Sequence[str], fb: Sequence[str]):
    acc = None
    for a, b in zip(fa, fb):
        t = (F.col(a) - F.col(b)) * (F.col(a) - F.col(b))
        acc = t if acc is None else acc + t
    return acc


def _cell(col: str, lo: float, width):
    return F.floor((F.col(col) - lo) / width).cast("bigint")


def _first_width(refs: DataFrame, cols: Sequence[str], lo: Sequence[float], full: float, most: int, by: list[str]) -> float:
    """Widest of the ladder's widths whose cells hold at most ``most`` references each (the narrowest, if none)."""
    ladder = [full / 4 ** i for i in range(_LADDER + 1)]
    cells = refs.select(*by, *cols, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in enumerate(ladder)]))
                        .alias("s"))
    sizes = (cells.groupBy("s.i", *by, *[_cell(c, o, F.col("s.w")).alias(f"__c{n}") for n, (c, o) in enumerate(zip(cols, lo))])
             .agg(F.count(F.lit(1)).alias("n")).groupBy("i").agg(F.max("n").alias("n")))
    fits = [r["i"] for r in sizes.collect() if r["n"] <= most]
    return ladder[min(fits, default=_LADDER)]


def knn_join(queries: DataFrame, refs: DataFrame, qid: str, rid: str, features: Sequence[str],
             k: int, exclude_self: bool = False, scale: float = 1.0, cell_width: float | None = None,
             checkpoint: bool = True, out_id: str = "neighbor", q_carry: Sequence[str] = (),
             r_carry: Sequence[str] = (), by: str | None = None) -> DataFrame:
    """For every query row, its ``k`` nearest reference rows.

    Distance is Euclidean over ``features`` times ``scale``; ties go to the
    smaller reference id.  Rows with a missing or infinite feature are skipped
    on both sides.  ``exclude_self`` drops pairs with ``qid == rid``; ``by``
    names a column that both sides have: neighbours then have the same value.

    Returns ``(qid, out_id, dist, rank, *q_carry, *nb_<r_carry>)`` with
    ``rank`` 1..k (fewer when there are fewer references).  Carried columns
    ride along with their rows, so callers need no join back on the ids.
    """
    d = len(features)
    cap = k + 1 if exclude_self else k
    fq = [f"__q{i}" for i in range(d)]
    fr = [f"__r{i}" for i in range(d)]
    key = ["__by"] if by else []
    byq = [F.col(by).alias("__by")] if by else []

    def present(df):
        ok = F.col(by).isNotNull() if by else F.lit(True)
        for f in features:
            ok = ok & finite_only(F.col(f).cast("double")).isNotNull()
        return df.where(ok)

    rc = [f"__rc{i}" for i in range(len(r_carry))]
    R = present(refs).select(F.col(rid).alias("__rid"), *byq, *[F.col(f).cast("double").alias(x) for f, x in zip(features, fr)],
                             *[F.col(c).alias(a) for c, a in zip(r_carry, rc)])
    wl = Window.partitionBy(*key, *fr).orderBy("__rid")
    R = R.withColumn("__rn", F.row_number().over(wl)).where(F.col("__rn") <= cap).drop("__rn")

    Q = present(queries).select(F.col(qid).alias("__qid"), *byq, *[F.col(f).cast("double").alias(x) for f, x in zip(features, fq)],
                                *q_carry)
    QL = Q.select(*key, *fq).distinct()
    if checkpoint:  # both are read by every round: compute them once
        R, QL = cut_lineage(R), cut_lineage(QL)

    # bounding box of both sides, the reference count and their spread: one small job
    both = R.select(*[F.col(x).alias(f"__f{i}") for i, x in enumerate(fr)], F.lit(1).alias("__isr")) \
        .unionByName(QL.select(*[F.col(x).alias(f"__f{i}") for i, x in enumerate(fq)], F.lit(0).alias("__isr")))
    st = both.agg(*[F.min(f"__f{i}").alias(f"lo{i}") for i in range(d)],
                  *[F.max(f"__f{i}").alias(f"hi{i}") for i in range(d)],
                  *[F.stddev_pop(F.when(F.col("__isr") == 1, F.col(f"__f{i}"))).alias(f"sd{i}") for i in range(d)],
                  F.sum("__isr").alias("n"), F.count(F.lit(1)).alias("m")).first()
    if st is None or not st["n"] or st["m"] == st["n"]:
        empty = queries.select(F.col(qid), F.lit(None).cast(refs.schema[rid].dataType).alias(out_id),
                               F.lit(None).cast("double").alias("dist"), F.lit(None).cast("int").alias("rank"),
                               *q_carry, *[F.lit(None).alias(f"nb_{c}") for c in r_carry])
        return empty.limit(0)
    dims = sorted(sorted(range(d), key=lambda i: -(st[f"sd{i}"] or 0.0))[:_GRID_DIMS])
    m = len(dims)
    lo = [float(st[f"lo{i}"]) for i in dims]
    full = max(float(st[f"hi{i}"]) - float(st[f"lo{i}"]) for i in dims) or 1.0
    gq, gr = [fq[i] for i in dims], [fr[i] for i in dims]
    width = cell_width or _first_width(R, gr, lo, full, _PER_CELL * cap, key)
    offsets = F.array(*[F.array(*[F.lit(o) for o in off]) for off in itertools.product((-1, 0, 1), repeat=m)])

    resolved = []
    todo = QL
    grow = 2.0
    while True:
        last = width >= full  # a cell and its neighbours cover the whole box
        Rc = R.select("__rid", *key, *fr, *rc, *[_cell(x, lo[i], width).alias(f"__c{i}") for i, x in enumerate(gr)])
        probe = todo.select(*key, *fq, F.explode(offsets).alias("__off")).select(
            *key, *fq, *[(_cell(x, lo[i], width) + F.col("__off")[i]).alias(f"__c{i}") for i, x in enumerate(gq)])
        cand = probe.join(Rc, [*key, *[f"__c{i}" for i in range(m)]]).select(
            *key, *fq, "__rid", *rc, _sqdist(fq, fr).alias("__d2"))
        wq = Window.partitionBy(*key, *fq).orderBy("__d2", "__rid")
        top = cand.withColumn("__rk", F.row_number().over(wq)).where(F.col("__rk") <= cap)
        if last:
            resolved.append(top.drop("__rk"))
            break
        # same partitioning as the ranking window: no further shuffle
        wl = Window.partitionBy(*key, *fq)
        flagged = top.withColumn(
            "__ok", (F.count(F.lit(1)).over(wl) >= cap) & (F.max("__d2").over(wl) <= width * width))
        if checkpoint:
            flagged = cut_lineage(flagged)  # candidates computed once per round
        final = flagged.where("__ok").drop("__ok", "__rk")
        resolved.append(final)
        # whoever isn't final stays, queries without any candidate included
        todo = todo.join(final.select(*key, *fq).distinct(), [*key, *fq], "left_anti")
        if checkpoint:
            todo = cut_lineage(todo)
        if todo.isEmpty():
            break
        if not by:
            resolved.append(kd_top(todo, R, fq, fr, cap, ["__rid", *rc]))
            break
        width *= grow
        grow = min(grow * 1.5, 16.0)

    loc_nn = resolved[0]
    for extra in resolved[1:]:
        loc_nn = loc_nn.unionByName(extra)
    pairs = Q.join(loc_nn.select(*key, *fq, "__rid", "__d2", *rc), [*key, *fq])
    if exclude_self:
        pairs = pairs.where(F.col("__qid") != F.col("__rid"))
    w = Window.partitionBy("__qid").orderBy("__d2", "__rid")
    out = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out.select(F.col("__qid").alias(qid), F.col("__rid").alias(out_id),
                      (F.sqrt("__d2") * F.lit(scale)).alias("dist"), F.col("rank").cast("int"), *q_carry,
                      *[F.col(a).alias(f"nb_{c}") for c, a in zip(r_carry, rc)])
