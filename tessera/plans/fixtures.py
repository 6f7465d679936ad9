"""Derived inputs built from the driver tables (whole tables, no subsets).

The driver tables have no NULLs and labels unrelated to their features, so
the fixtures below derive NULLs from key residues and labels from feature
values.  Each fixture exists twice with the same meaning: as a Spark
DataFrame (``spark_*``) and as a SQL common table expression (``SQL``) for
the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table


def orders_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price0"),
        F.concat(F.lit("B"), F.floor(F.col("o_totalprice") / 100000).cast("int").cast("string")).alias("class0"),
    )


def orders_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = orders_labelled(spark, sf_dir)
    return lab.select(
        "id",
        F.when(F.col("id") % 10 == 3, F.lit(None).cast("string")).otherwise(F.col("class0")).alias("class"),
        F.when(F.col("id") % 10 == 7, F.lit(None).cast("double")).otherwise(F.col("price0")).alias("price"),
    )


def part_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 7 == 3, F.lit(None).cast("bigint")).otherwise(F.col("p_size").cast("bigint")).alias("x"),
        F.floor(F.col("p_retailprice") * 100 + 0.5).cast("bigint").alias("y"),
    )


def part_class(spark: SparkSession, sf_dir: str, threshold: int = 25) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").cast("bigint").alias("x"),
        F.floor(F.col("p_retailprice")).cast("bigint").alias("y"),
        F.when(F.col("p_size") > threshold, F.lit("L")).otherwise(F.lit("S")).alias("label"),
    )


def part_imbalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_class(spark, sf_dir, threshold=40)


def events_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        "value",
        F.when(F.col("value") < 20, "low").when(F.col("value") < 100, "mid").otherwise("high").alias("class"),
    )


def line_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.col("l_linenumber").cast("string"), F.lit(" Owner, "), "l_returnflag",
                 F.lit(", "), "l_linestatus").alias("history"),
    )


def part_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit('["'), "p_brand", F.lit('","'), "p_type", F.lit('"]')).alias("feats"),
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def train_flag(key):
    return F.when(F.pmod(key, F.lit(5)) < 4, F.lit("train")).otherwise(F.lit("test"))


# SQL twins for the oracle (DuckDB dialect; integer division avoided).
SQL = {
    "orders_labelled": """orders_labelled AS (
  SELECT o_orderkey AS id, o_totalprice AS price0,
         'B' || CAST(CAST(floor(o_totalprice / 100000) AS INTEGER) AS VARCHAR) AS class0
  FROM orders)""",
    "orders_gaps": """orders_gaps AS (
  SELECT id,
         CASE WHEN id % 10 = 3 THEN NULL ELSE class0 END AS class,
         CASE WHEN id % 10 = 7 THEN NULL ELSE price0 END AS price
  FROM orders_labelled)""",
    "part_gaps": """part_gaps AS (
  SELECT p_partkey AS id,
         CASE WHEN p_partkey % 7 = 3 THEN NULL ELSE CAST(p_size AS BIGINT) END AS x,
         CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS y
  FROM part)""",
    "part_class": """part_class AS (
  SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS x, CAST(floor(p_retailprice) AS BIGINT) AS y,
         CASE WHEN p_size > 25 THEN 'L' ELSE 'S' END AS label
  FROM part)""",
    "part_imbalanced": """part_imbalanced AS (
  SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS x, CAST(floor(p_retailprice) AS BIGINT) AS y,
         CASE WHEN p_size > 40 THEN 'L' ELSE 'S' END AS label
  FROM part)""",
    "events_skewed": """events_skewed AS (
  SELECT event_id AS id, value,
         CASE WHEN value < 20 THEN 'low' WHEN value < 100 THEN 'mid' ELSE 'high' END AS class
  FROM events)""",
    "line_history": """line_history AS (
  SELECT CAST(l_linenumber AS VARCHAR) || ' Owner, ' || l_returnflag || ', ' || l_linestatus AS history
  FROM lineitem)""",
    "part_json": """part_json AS (
  SELECT p_partkey AS id, '["' || p_brand || '","' || p_type || '"]' AS feats FROM part)""",
    "docs": """docs AS (SELECT doc_id AS id, text FROM documents)""",
}

_DEPS = {"orders_gaps": ["orders_labelled"]}


def with_fixtures(*names: str) -> str:
    """``WITH`` prefix holding the named fixtures (and what they need)."""
    order: list[str] = []
    for n in names:
        for d in _DEPS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    return "WITH " + ",\n".join(SQL[n] for n in order) + "\n"
