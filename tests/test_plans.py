"""Plan shape checks: the properties the operators rely on at scale."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["knn_join", "edited_nn", "impute_knn5", "tolerance_match", "repair_labels",
                                  "cramers_v", "spearman_pairs", "adasyn_weights", "global_mode_median",
                                  "histogram_markers", "impute_price_by_class", "describe"])
def test_no_cartesian_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_cap_per_class_ranks_one_prefix_of_a_class_only(spark):
    for name in ("cap_per_class", "cap_per_class_5000"):
        plan = _plan(E.queries()[name](spark, SF))
        ranked = [line for line in plan.splitlines() if "row_number" in line and "windowspec" in line]
        assert ranked and all("__pre#" in line for line in ranked)


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = _plan(E.queries()["clean_tokens"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = _plan(E.queries()["project"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_stop_words_are_a_hash_set(spark):
    plan = _plan(E.queries()["clean_tokens"](spark, SF))
    assert "INSET" in plan


def test_column_pairs_need_no_self_join(spark):
    from tessera.operators.association import crosstabs
    df = spark.createDataFrame([(1, "a", "x", "p")], "id int, a string, b string, c string")
    plan = _plan(crosstabs(df, ["a", "b", "c"]))
    assert "Join" not in plan and "Generate" in plan


def test_fitted_scalars_do_not_shuffle_the_data(spark):
    from tessera.operators.scale import z_score
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    plan = _plan(z_score(df, ["x"]))
    assert "Join" not in plan  # parameters arrive as a scalar subquery


@pytest.mark.parametrize("name", ["repair_labels", "knn_join", "cap_per_class", "spearman_pairs", "adasyn"])
def test_results_do_not_depend_on_partitioning(spark, name):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from oracle_check import duck, rows_of
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = rows_of(E.queries()[name](spark, SF).toPandas())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == rows_of(duck(SF).sql(E.oracle_sql()[name]).df())
