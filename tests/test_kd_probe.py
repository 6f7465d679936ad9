import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import kd_probe
from tessera.operators.kd_probe import Cuts, kd_top
from tessera.operators.neighbors import knn_join
from tessera.session import cut_lineage


def answers(spark, queries, refs, need, leaf_rows=16_384, slab_rows=65_536):
    d = len(queries[0])
    fq, fr = [f"q{i}" for i in range(d)], [f"r{i}" for i in range(d)]
    q = spark.createDataFrame(queries, ", ".join(f"{c} double" for c in fq)).distinct()
    r = cut_lineage(spark.createDataFrame(refs, "id string, extra array<int>, " + ", ".join(f"{c} double" for c in fr)))
    out = {}
    for row in kd_top(q, r, fq, fr, need, ["id", "extra"], leaf_rows, slab_rows).collect():
        out.setdefault(tuple(row[c] for c in fq), []).append((row["__d2"], row["id"], row["extra"]))
    return {k: sorted(v, key=lambda x: x[:2]) for k, v in out.items()}


def brute(queries, refs, need):
    out = {}
    for q in set(queries):
        rows = []
        for i, extra, *r in refs:
            d2 = 0.0
            for a, b in zip(q, r):
                d2 += (a - b) * (a - b)
            rows.append((d2, i, extra))
        out[q] = sorted(rows, key=lambda x: x[:2])[:need]
    return out


@pytest.mark.parametrize("leaf_rows,slab_rows", [(16_384, 65_536), (40, 65_536), (40, 15)])
@pytest.mark.parametrize("d", [1, 2, 5])
def test_far_near_and_tied_queries(spark, d, leaf_rows, slab_rows):
    rng = random.Random(d * 100 + leaf_rows + slab_rows)
    # half of the references are on a small grid: many equal distances
    points = [tuple(float(rng.randrange(4)) for _ in range(d)) if i % 2 else tuple(rng.gauss(0, 3) for _ in range(d)) for i in range(500)]
    refs = [(f"r{i}", [i, None] if i % 3 else None, *p) for i, p in enumerate(points)]
    queries = [tuple(rng.gauss(0, 3) for _ in range(d)) for _ in range(20)] + [tuple(1e6 + i for _ in range(d)) for i in range(20)]
    queries += [(1.5,) * d, (2.0,) * d, (-1e9,) * d]
    assert answers(spark, queries, refs, 4, leaf_rows, slab_rows) == brute(queries, refs, 4)


def test_fewer_references_than_asked_for_and_none(spark):
    refs = [("b", None, 1.0), ("a", [1], 1.0), ("c", [], 9.0)]
    assert answers(spark, [(0.0,), (100.0,)], refs, 5, 1) == brute([(0.0,), (100.0,)], refs, 5)
    assert answers(spark, [(0.0,)], refs[:0], 5) == {}


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(kd_probe, "BLOCK_QUERIES", 7)
    rng = random.Random(9)
    refs = [(f"r{i}", None, rng.random(), rng.random()) for i in range(200)]
    queries = [(1000.0 + i, rng.random()) for i in range(60)]
    assert answers(spark, queries, refs, 3, 30) == brute(queries, refs, 3)


def test_cuts_of_equal_points_and_of_none():
    assert len(set(Cuts(np.ones((50, 2)), 3).leaves(np.ones((50, 2))))) == 1
    assert len(Cuts(np.zeros((0, 2)), 2).leaves(np.zeros((5, 2)))) == 5
    points = np.random.default_rng(1).random((1024, 3))
    assert np.bincount(Cuts(points, 4).leaves(points)).tolist() == [64] * 16


def test_far_queries_see_a_small_part_of_the_references():
    """The pruned search looks at few boxes: pairs that leave a box are near the number asked for."""
    rng = np.random.default_rng(2)
    refs = rng.random((8192, 2))
    seen = []
    real = kd_probe._point_distance
    kd_probe._point_distance = lambda q, r: seen.append(len(q) * len(r)) or real(q, r)
    try:
        kd_probe._nearest(np.column_stack([np.full(500, 1e3), rng.random(500) * 1e3]), refs, 3)
    finally:
        kd_probe._point_distance = real
    assert sum(seen) < 0.1 * 500 * 8192


def test_the_join_hands_far_queries_over(spark):
    rng = random.Random(4)
    refs = spark.createDataFrame([(i, rng.random(), rng.random(), i * 10) for i in range(300)], "id long, x double, y double, v long")
    queries = spark.createDataFrame([(i, 1e5 + i, -1e5) for i in range(50)] + [(99, 0.5, 0.5), (98, None, 1.0)], "id long, x double, y double")
    got = knn_join(queries, refs, "id", "id", ["x", "y"], 2, r_carry=["v"]).collect()
    table = [(r.id, r.x, r.y) for r in refs.collect()]
    for q in queries.where("x is not null").collect():
        want = [i for _, i in sorted((math.dist((q.x, q.y), (x, y)), i) for i, x, y in table)[:2]]
        own = sorted((r["rank"], r.neighbor, r.nb_v) for r in got if r.id == q.id)
        assert [r[1] for r in own] == want and all(r[2] == r[1] * 10 for r in own)
    assert not [r for r in got if r.id == 98] and len(got) == 102
