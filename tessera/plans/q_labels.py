"""Queries: label repair slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.quantiles import exact_median, global_median, global_mode, group_modes
from tessera.operators.impute import impute_class_by_price, impute_price_by_class, repair_labels
from tessera.operators.joins import class_prevalence, lookup_join, tolerance_match
from tessera.plans import fixtures as fx
from tessera.plans.registry import query, r6

_MODE_SQL = "(SELECT class FROM orders_gaps WHERE class IS NOT NULL GROUP BY class ORDER BY count(*) DESC, class LIMIT 1)"
_MED_SQL = "(SELECT median(price) FROM orders_gaps)"
_LOOKUP_SQL = "med AS (SELECT class AS mclass, median(price) AS med FROM orders_gaps WHERE class IS NOT NULL GROUP BY class)"


@query("repair_labels", fx.with_fixtures("orders_gaps") + f""",
{_LOOKUP_SQL},
firstmatch AS (
  SELECT g.id, min(m.mclass) AS mclass FROM orders_gaps g JOIN med m
    ON g.price IS NOT NULL AND g.price <> 0 AND abs(g.price - m.med) / g.price <= 0.04
  WHERE g.class IS NULL GROUP BY g.id)
SELECT g.id,
  CASE WHEN g.class IS NOT NULL THEN g.class ELSE coalesce(f.mclass, {_MODE_SQL}) END AS class,
  round(CAST(CASE WHEN g.price IS NOT NULL THEN g.price
       WHEN g.class IS NULL THEN {_MED_SQL}
       ELSE coalesce((SELECT med FROM med WHERE mclass = g.class), {_MED_SQL}) END AS DOUBLE), 6) AS price
FROM orders_gaps g LEFT JOIN firstmatch f ON g.id = f.id
""")
def q_repair_labels(spark, sf_dir):
    rep = repair_labels(fx.orders_gaps(spark, sf_dir), "class", "price")
    return rep.select("id", "class", r6("price").alias("price"))


@query("repair_labels_keyless", fx.with_fixtures("orders_gaps") + f""",
g AS (SELECT class, round(price, -4) AS price FROM orders_gaps),
med AS (SELECT class AS mclass, median(price) AS med FROM g WHERE class IS NOT NULL GROUP BY class),
p AS (SELECT price, min(mclass) AS mclass FROM (SELECT DISTINCT price FROM g WHERE class IS NULL) x JOIN med
      ON price <> 0 AND abs(price - med) / price <= 0.04 GROUP BY price)
SELECT CASE WHEN g.class IS NOT NULL THEN g.class
            ELSE coalesce(p.mclass, (SELECT class FROM g WHERE class IS NOT NULL GROUP BY class ORDER BY count(*) DESC, class LIMIT 1)) END AS class,
  round(CAST(CASE WHEN g.price IS NOT NULL THEN g.price WHEN g.class IS NULL THEN (SELECT median(price) FROM g)
       ELSE coalesce((SELECT med FROM med WHERE med.mclass = g.class), (SELECT median(price) FROM g)) END AS DOUBLE), 6) AS price
FROM g LEFT JOIN p ON g.price = p.price
""")
def q_repair_labels_keyless(spark, sf_dir):
    """Rows without a key, many of them equal: every one is kept and repaired (prices missing as NaN)."""
    g = fx.orders_gaps(spark, sf_dir).select("class", F.coalesce(F.round("price", -4), F.lit(float("nan"))).alias("price"))
    return repair_labels(g, "class", "price").select("class", r6("price").alias("price"))


@query("impute_class_by_price", fx.with_fixtures("orders_gaps") + f""",
{_LOOKUP_SQL},
firstmatch AS (
  SELECT g.id, min(m.mclass) AS mclass FROM orders_gaps g JOIN med m
    ON g.price IS NOT NULL AND g.price <> 0 AND abs(g.price - m.med) / g.price <= 0.04
  WHERE g.class IS NULL GROUP BY g.id)
SELECT g.id, round(g.price, 6) AS price, g.class,
  coalesce(g.class, f.mclass, {_MODE_SQL}) AS class_filled
FROM orders_gaps g LEFT JOIN firstmatch f ON g.id = f.id
""")
def q_impute_class_by_price(spark, sf_dir):
    out = impute_class_by_price(fx.orders_gaps(spark, sf_dir), "class", "price")
    return out.select("id", r6("price").alias("price"), "class", "class_filled")


@query("impute_price_by_class", fx.with_fixtures("orders_gaps") + f""",
{_LOOKUP_SQL}
SELECT g.id, g.class, round(g.price, 6) AS price,
  round(CASE WHEN g.price IS NOT NULL THEN g.price
       ELSE coalesce((SELECT med FROM med WHERE mclass = g.class), {_MED_SQL}) END, 6) AS price_filled
FROM orders_gaps g
""")
def q_impute_price_by_class(spark, sf_dir):
    out = impute_price_by_class(fx.orders_gaps(spark, sf_dir), "class", "price")
    return out.select("id", "class", r6("price").alias("price"), r6("price_filled").alias("price_filled"))


@query("group_median", fx.with_fixtures("orders_labelled") + """
SELECT class0, round(median(price0), 6) AS median_price FROM orders_labelled GROUP BY class0
""")
def q_group_median(spark, sf_dir):
    med = exact_median(fx.orders_labelled(spark, sf_dir), ["class0"], "price0", "median_price")
    return med.select("class0", r6("median_price").alias("median_price"))


@query("group_median_skewed", fx.with_fixtures("events_skewed") + """
SELECT class, round(median(value), 6) AS median_value, count(*) AS n FROM events_skewed GROUP BY class
""")
def q_group_median_skewed(spark, sf_dir):
    e = fx.events_skewed(spark, sf_dir)
    med = exact_median(e, ["class"], "value", "median_value")
    n = e.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return med.join(n, "class").select("class", r6("median_value").alias("median_value"), "n")


@query("group_modes", """
WITH vc AS (SELECT round(o_totalprice, -4) AS band, o_orderpriority AS prio, count(*) AS n
            FROM orders GROUP BY 1, 2),
top AS (SELECT band, max(n) AS n FROM vc GROUP BY band)
SELECT vc.band, vc.prio, vc.n FROM vc JOIN top USING (band, n)
""")
def q_group_modes(spark, sf_dir):
    """E5: modal priority per 10,000-wide price band, all ties kept."""
    o = fx.table(spark, sf_dir, "orders").select(
        F.round("o_totalprice", -4).alias("band"), F.col("o_orderpriority").alias("prio"))
    return group_modes(o, ["band"], "prio").select("band", "prio", "n")


@query("global_mode_median", fx.with_fixtures("orders_gaps") + f"""
SELECT {_MODE_SQL} AS mode_class, round({_MED_SQL}, 6) AS median_price
""")
def q_global_mode_median(spark, sf_dir):
    g = fx.orders_gaps(spark, sf_dir)
    return spark.range(1).select(global_mode(g, "class").alias("mode_class"),
                                 r6(global_median(g, "price")).alias("median_price"))


@query("lookup_join", fx.with_fixtures("orders_gaps") + f""",
{_LOOKUP_SQL}
SELECT g.id, g.class, round(coalesce(m.med, -1), 6) AS median_price
FROM orders_gaps g LEFT JOIN med m ON g.class = m.mclass
""")
def q_lookup_join(spark, sf_dir):
    g = fx.orders_gaps(spark, sf_dir)
    lk = exact_median(g.where(F.col("class").isNotNull()), ["class"], "price", "median_price")
    out = lookup_join(g, lk, "class", "median_price", default=-1)
    return out.select("id", "class", r6("median_price").alias("median_price"))


@query("class_prevalence_map", fx.with_fixtures("events_skewed") + """
SELECT id, class, round(count(*) OVER (PARTITION BY class) / (SELECT count(*) FROM events_skewed), 6) AS prevalence
FROM events_skewed
""")
def q_class_prevalence(spark, sf_dir):
    out = class_prevalence(fx.events_skewed(spark, sf_dir), "class")
    return out.select("id", "class", r6("prevalence").alias("prevalence"))


@query("tolerance_match", fx.with_fixtures("orders_gaps") + f""",
{_LOOKUP_SQL}
SELECT g.id, round(g.price, 6) AS price, min(m.mclass) AS match
FROM orders_gaps g LEFT JOIN med m
  ON g.price <> 0 AND abs(g.price - m.med) / g.price <= 0.04
GROUP BY g.id, g.price
""")
def q_tolerance_match(spark, sf_dir):
    g = fx.orders_gaps(spark, sf_dir)
    lk = exact_median(g.where(F.col("class").isNotNull()), ["class"], "price", "med")
    out = tolerance_match(g.select("id", "price"), lk, "price", "class", "med", 0.04)
    return out.select("id", r6("price").alias("price"), "match")
