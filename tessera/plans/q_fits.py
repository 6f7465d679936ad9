"""Queries: regression with the Huber loss (K2), in the same rounds in SQL; the joint fit of both heads (K3, K5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import scale as S
from tessera.operators.huber import huber_fit
from tessera.operators.joint_model import fit_joint
from tessera.plans.registry import query
from tessera.sources.tables import table


@query("huber_fit", """
WITH RECURSIVE d AS (SELECT l_quantity::DOUBLE / 10 AS x, l_extendedprice::DOUBLE / 10000 AS y FROM lineitem),
it AS (
  SELECT 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b
  UNION ALL
  SELECT k, (sy - b * sx) / sw AS a, b FROM (
    SELECT k, sw, sx, sy, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS b FROM (
      SELECT k + 1 AS k, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy
      FROM (SELECT it.k, d.x, d.y,
                   CASE WHEN it.k > 0 AND abs(d.y - it.a - it.b * d.x) > 1 THEN 1 / abs(d.y - it.a - it.b * d.x) ELSE 1 END AS w
            FROM it CROSS JOIN d) GROUP BY k))
  WHERE k <= 60)
SELECT 'intercept' AS name, round(a, 5) AS value FROM it WHERE k = 60
UNION ALL SELECT 'quantity', round(b, 5) FROM it WHERE k = 60
""")
def q_huber_fit(spark, d):
    li = table(spark, d, "lineitem")
    df = li.select((F.col("l_quantity").cast("double") / 10).alias("quantity"), (F.col("l_extendedprice").cast("double") / 10000).alias("y"))
    fit = huber_fit(df, ["quantity"], "y")
    rows = [("intercept", fit.intercept), *zip(fit.features, fit.coefficients)]
    return spark.createDataFrame(rows, "name string, value double").withColumn("value", F.round("value", 5))


def _joint_scored(spark, d):
    """Part rows with a size band that half of them hide, a price, and the joint model's view of both."""
    from pyspark.ml.feature import VectorAssembler

    k = F.col("p_partkey")
    band = F.when(F.col("p_size") > 33, "large").when(F.col("p_size") > 16, "medium").otherwise("small")
    p = table(spark, d, "part").select(k.alias("id"), F.col("p_size").cast("double").alias("size"), F.length("p_name").cast("double").alias("length"),
                                       band.alias("band"), (2.0 * F.col("p_size") - F.length("p_name")).alias("price"))
    z = S.z_score(p, ["size", "length", "price"])
    rows = VectorAssembler(inputCols=["size", "length"], outputCol="features").transform(z)
    seen = rows.withColumn("shown", F.when(F.col("id") % 2 == 0, F.col("band")))
    model = fit_joint(seen, "id", "shown", "price", hidden=4, rounds=80, patience=20)
    return rows.withColumn("s", model.score())


@query("joint_two_target")
def q_joint_two_target(spark, d):
    """K3/K5: both heads in one loss with learned weights, the best of the rounds kept."""
    return _joint_scored(spark, d).select("id", "s.class_name", F.round("s.probability", 4).alias("probability"), F.round("s.price", 4).alias("price"))


@query("joint_two_target_check", """
SELECT count(*) FILTER (p_partkey % 2 = 1) AS n_hidden, true AS classes_found, true AS prices_found FROM part
""")
def q_joint_two_target_check(spark, d):
    """Bands of the rows whose class the fit never saw, and the planted line of the price."""
    s = _joint_scored(spark, d)
    hidden = F.col("id") % 2 == 1
    right = F.avg(F.when(hidden, (F.col("s.class_name") == F.col("band")).cast("double")))
    return s.agg(F.count_if(hidden).alias("n_hidden"), (right > 0.9).alias("classes_found"),
                 (F.corr("s.price", "price") > 0.98).alias("prices_found"))
