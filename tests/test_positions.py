import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.positions import row_numbers


@pytest.mark.parametrize("per_range", [3, 1_000_000])
def test_numbers_over_many_ranges_and_groups(spark, per_range):
    rng = random.Random(per_range)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(20)]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, v int, row long")
    got = row_numbers(df, [F.desc_nulls_last("v"), "row"], "pos", ["g"], per_range, "size").collect()
    want = []
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want += [(*r, i, len(own)) for i, r in enumerate(own, 1)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_equal_rows_get_their_own_numbers(spark):
    df = spark.createDataFrame([(1,)] * 50, "v int")
    assert sorted(r.row for r in row_numbers(df, ["v"], rows_per_range=7).collect()) == list(range(1, 51))
    assert row_numbers(df.limit(0), ["v"]).count() == 0
