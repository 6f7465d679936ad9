"""Every query with a SQL twin must agree with DuckDB on the smallest tables
(the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    spark_types = {f.name: _DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    assert spark_types == duck_types
    got = sdf.toPandas()
    want = rel.df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "class", "price"]
    assert df.count() > 0
