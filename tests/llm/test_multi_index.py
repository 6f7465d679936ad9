import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import multi_index as mi

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("id", T.StringType()), T.StructField("q", T.StringType())])


def exact(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        keep = ids != q
        order = np.lexsort((ids[keep], d[keep]))[:k]
        out[q] = list(zip(ids[keep][order].tolist(), d[keep][order].tolist(), strict=True))
    return out


@pytest.mark.parametrize("m,radius", [(1, 0), (3, 2), (3, 7), (8, 27), (8, 64)])
def test_probing_finds_every_code_within_the_radius(m, radius):
    rng = np.random.default_rng(m + radius)
    codes = rng.integers(0, 256, (500, m), dtype=np.uint8)
    index = mi.SubstringIndex(codes)
    for q in rng.integers(0, 256, (20, m), dtype=np.uint8):
        want = np.flatnonzero(np.bitwise_count(codes ^ q).sum(1) <= radius)
        assert np.array_equal(index.within(q, radius), want)


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, x[i].tolist()) for i in range(3000)]
    df = spark.createDataFrame([(i, v, "c", "c") for i, v in rows], SCHEMA)
    got = {}
    for r in mi.nearest(df, F.col("vec_id") % 100 == 0, rows_per_block=700, queries_per_block=20).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = exact(rows, range(0, 3000, 100), 10)
    assert set(got) == set(want) and all(sorted(g) == list(range(1, 11)) for g in got.values())
    hits = [len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    for q, g in got.items():
        d = dict(zip(range(3000), np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1)), strict=True))
        assert [g[i] for i in sorted(g)] == sorted(g.values(), key=lambda t: (t[1], t[0]))
        assert all(abs(d[v] - s) < 1e-12 for v, s in g.values())


def test_ties_copies_and_unusable_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(i, a) for i in range(40)] + [(100 + i, b) for i in range(5)]
    bad = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 0.0]), (203, [float("nan"), 1.0, 0.0]),
           (204, [float("inf"), 1.0, 0.0]), (205, [1.0, 2.0]), (None, a), (206, [])]
    df = spark.createDataFrame([(i, v, "c", "c") for i, v in rows + bad + rows[:3]], SCHEMA)
    got = {}
    for r in mi.nearest(df, F.col("vec_id") % 2 == 0, rows_per_block=8).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i, _ in rows if i % 2 == 0}
    for q, found in got.items():
        want = exact(rows, [q], 10)[q]
        assert [v for _, v, _ in sorted(found)] == [v for v, _ in want]
        assert [s for *_, s in sorted(found)] == pytest.approx([s for _, s in want])


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], "c", "c"), (1, [2.0, 2.0], "c", "c")], SCHEMA)
    r, = mi.nearest(df, F.col("vec_id") == 0).collect()
    assert (r.query_id, r.rank, r.vec_id, r.score) == (0, 1, 1, 1.0)
    assert mi.nearest(df.limit(1), F.lit(True)).count() == 0
    assert mi.nearest(df.limit(0), F.lit(True)).count() == 0
