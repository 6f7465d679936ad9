import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import line_dedup as ld

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
                      + [T.StructField(c, T.StringType()) for c in ("id", "h1", "r1", "pos", "n_lines", "batch")])
LOWER = str.maketrans(ld.UPPER, ld.LOWER)


def brute(rows, min_chars=20, min_docs=3):
    held = defaultdict(list)
    keys = [[line.strip(ld.SPACE).translate(LOWER) for line in (t or "").split("\n")] for _, t in rows]
    for (i, _), ks in zip(rows, keys, strict=True):
        for k in set(ks):
            held[k].append(i)

    def last(k):
        return max((i for i in held[k] if i is not None), default=None)

    out = []
    for (i, t), ks in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, ks, strict=True) if len(k) < min_chars or len(held[k]) < min_docs or last(k) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], SCHEMA)
    return sorted(map(tuple, ld.dedup_lines(df, **kw).collect()), key=str)


def some_rows(n, seed):
    rng = random.Random(seed)
    shared = [f"This Shared line Ünïcode number {i:03d}" for i in range(12)]
    rows = []
    for i in range(n):
        lines = [rng.choice(["", " ", "short", rng.choice(shared), rng.choice(shared).upper() + " \t", "\x0b" + rng.choice(shared).lower(),
                             "a line of its own " + str(rng.random()), "19 letters is short", "It's 20 letters here"])
                 for _ in range(rng.randint(0, 8))]
        rows.append((i, "\n".join(lines)))
    rows += [rows[3], rows[3], (rows[4][0], "It's 20 letters here"), (None, None), (None, "\n".join(shared)), (None, "\n".join(shared)), (n, None), (n + 1, "\n")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("batches", "fan_out"), [(1, 2), (4, 2), (5, 3)])
def test_equals_brute_force(spark, batches, fan_out):
    rows = some_rows(60, batches)
    assert run(spark, rows, batches=batches, fan_out=fan_out, keys_per_bucket=5) == brute(rows)


def test_parameters_empty_table_and_ids_all_null(spark):
    rows = some_rows(30, 9)
    assert run(spark, rows, min_chars=5, min_docs=2) == brute(rows, 5, 2)
    assert run(spark, []) == []
    rows = [(None, "one line that is long enough\nx")] * 4
    assert run(spark, rows) == brute(rows)


def test_many_lines_of_one_long_document(spark):
    lines = [f"the line with the number {i} of a long text" for i in range(30_000)]
    rows = [(i, "\n".join(lines)) for i in range(3)] + [(7, "\n".join(lines[::2] + lines[:3]))]
    assert run(spark, rows) == brute(rows)


def test_key_of_lines_that_lower_would_change_otherwise(spark):
    lines = ["ÀÉ İstanbul ÀÉ İstanbul K", "  PLAIN ascii LINE of text \r", " not stripped by the rule "]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    assert [r[0] for r in df.select(ld.line_key(F.col("x"))).collect()] == [x.strip(ld.SPACE).translate(LOWER) for x in lines]


def test_runs_are_compacted_and_decided_keys_stay_out(spark):
    runs = ld.LineRuns(spark, 4, enough=3, fan_out=2)
    batch = spark.createDataFrame([(1, 1, i) for i in (9, 8, 7)] + [(2, 2, 6)], "h1 long, h2 long, id long")
    runs.add(batch)
    runs.add(spark.createDataFrame([(1, 1, 5), (2, 2, 4), (3, 3, 4)], "h1 long, h2 long, id long"))
    assert [len(x) for x in runs.levels] == [0, 1]
    assert sorted(map(tuple, spark.table(runs.levels[1][0]).collect())) == [(1, 1, 3, 9), (2, 2, 2, 6), (3, 3, 1, 4)]
    runs.add(spark.createDataFrame([(2, 2, 3), (1, 1, 2)], "h1 long, h2 long, id long"))
    assert sorted(map(tuple, spark.table(runs.levels[0][0]).collect())) == [(2, 2, 1, 3)]
    assert sorted(map(tuple, runs.repeated().collect())) == [(1, 1, 9), (2, 2, 6)]
    joined = spark.table(runs.levels[0][0]).join(spark.table(runs.levels[1][0]).hint("merge"), ld.HASH, "left_anti")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(runs.name)]
