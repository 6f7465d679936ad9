"""Queries: quantiles by sketch and selection (E4, E6), automatic bins, density (G6, G7), global positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import sql_hash_u32
from tessera.functions.selection import exact_quantiles, group_medians
from tessera.operators import density as D
from tessera.operators import positions as P
from tessera.operators.scale import histogram
from tessera.plans.registry import query, r6
from tessera.sources.tables import table


@query("quantiles_by_group", " UNION ALL ".join(f"""
SELECT l_returnflag, '{c}' AS "column", CAST({p} AS DOUBLE) AS prob, round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value
FROM lineitem GROUP BY l_returnflag""" for c in ("l_quantity", "l_extendedprice", "l_discount") for p in (0.1, 0.5, 0.75)))
def q_quantiles_by_group(spark, d):
    out = exact_quantiles(table(spark, d, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice", "l_discount"], (0.1, 0.5, 0.75))
    return out.withColumn("value", r6("value"))


@query("group_medians_skewed", """
WITH e AS (SELECT CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 50 END AS g, value, 7.0::DOUBLE AS same FROM events)
SELECT g, round(median(value), 6) AS value, round(median(same), 6) AS same FROM e GROUP BY g
""")
def q_group_medians_skewed(spark, d):
    """A third of the rows in one (NULL) group, and a column with one value."""
    g = F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 50)
    e = table(spark, d, "events").select(g.alias("g"), "value", F.lit(7.0).alias("same"))
    return group_medians(e, ["g"], ["value", "same"]).select("g", r6("value").alias("value"), r6("same").alias("same"))


_BINS_SQL = """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events),
k AS (SELECT lo, hi, CAST(ceil((hi - lo) / least(greatest(2 * iqr / pow(n, 1 / 3.0::DOUBLE), (hi - lo) / sqrt(n) / 2), (hi - lo) / (log2(n) + 1))) AS INTEGER) AS bins
      FROM s)
"""


@query("histogram_auto", _BINS_SQL + """,
h AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / bins)), bins - 1) AS INTEGER) AS bin, count(*) AS n FROM events, k
      WHERE value IS NOT NULL GROUP BY 1)
SELECT bin, round(lo + bin * ((hi - lo) / bins), 6) AS bin_lo, round(lo + (bin + 1) * ((hi - lo) / bins), 6) AS bin_hi, n FROM h, k
""")
def q_histogram_auto(spark, d):
    e = table(spark, d, "events").select("value")
    h = histogram(e, "value", D.bin_rule(e, "value"))
    return h.select("bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "n")


@query("density_curve", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, stddev_samp(value) * pow(count(value), -0.2) AS h, count(value) AS n FROM events),
b AS (SELECT least(floor((value - lo) / ((hi - lo) / 1024)), 1023) AS bin, count(*) AS c FROM events, s WHERE value IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS point FROM range(200))
SELECT point, round(lo + point * (hi - lo) / 199, 6) AS x,
       round(sum(c * exp(-0.5 * pow((lo + point * (hi - lo) / 199 - lo - (bin + 0.5) * (hi - lo) / 1024) / h, 2))) / (sqrt(2 * pi()) * any_value(h) * any_value(n)), 6) AS density
FROM g, b, s GROUP BY point, lo, hi
""")
def q_density_curve(spark, d):
    return D.density(table(spark, d, "events"), "value").select("point", r6("x").alias("x"), r6("density").alias("density"))


@query("contiguous_folds", """
WITH n AS (SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT id, CAST(CASE WHEN i < (n % 7) * (n // 7 + 1) THEN i // (n // 7 + 1) ELSE n % 7 + (i - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INTEGER) AS fold
FROM n
""")
def q_contiguous_folds(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate")
    return P.contiguous_folds(o, ["o_orderdate", "id"], 7).select("id", "fold")


@query("slice_rows", """
SELECT id, o_totalprice FROM (
  SELECT o_orderkey AS id, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
WHERE i >= 100
""")
def q_slice_rows(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    return P.slice_rows(o, [F.desc("o_totalprice"), "id"], 100)


@query("inject_exactly_half", f"""
WITH p AS (SELECT p_partkey AS id, p_size::DOUBLE AS x, p_retailprice AS y,
                  row_number() OVER (ORDER BY {sql_hash_u32('42', 'p_partkey')}, p_partkey) AS r, count(*) OVER () AS n FROM part),
m AS (SELECT *, CASE WHEN r <= floor(n * 0.5) THEN ['x', 'y'][CAST({sql_hash_u32('42', "'col'", 'id')} % 2 + 1 AS INTEGER)] END AS injected FROM p)
SELECT id, CASE WHEN injected = 'x' THEN NULL ELSE x END AS x, CASE WHEN injected = 'y' THEN NULL ELSE y END AS y, injected FROM m
""")
def q_inject_exactly_half(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    return P.inject_missing_exactly(p, "id", ["x", "y"])
