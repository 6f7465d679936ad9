"""Queries: association statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import association as AS
from tessera.plans.registry import query, r6
from tessera.sources.tables import table

_CAT = ["p_brand", "p_type", "size_band", "p_size"]


def _part_cats(spark, d):
    p = table(spark, d, "part")
    return p.select("p_brand", "p_type", (F.col("p_size") / 10).cast("int").alias("size_band"),
                    (F.col("p_size") > 25).cast("string").alias("big"), "p_size")


def _ct_sql(cols):
    src = ("SELECT p_brand, p_type, CAST(CAST(trunc(p_size / 10) AS INTEGER) AS VARCHAR) AS size_band, "
           "CAST(p_size > 25 AS VARCHAR) AS big, CAST(p_size AS VARCHAR) AS p_size FROM part")
    pairs = AS.column_pairs(cols)
    ct = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, count(*) AS n "
        f"FROM src GROUP BY 3, 4" for a, b in pairs)
    return f"""WITH src AS ({src}),
ct AS ({ct}),
ra AS (SELECT var1, var2, a, sum(n) AS ra FROM ct GROUP BY 1, 2, 3),
cb AS (SELECT var1, var2, b, sum(n) AS cb FROM ct GROUP BY 1, 2, 3),
tot AS (SELECT var1, var2, sum(n) AS N, count(DISTINCT a) AS r, count(DISTINCT b) AS k FROM ct GROUP BY 1, 2),
grid AS (SELECT ra.var1, ra.var2, ra.a, cb.b, ra.ra, cb.cb, tot.N, tot.r, tot.k, coalesce(ct.n, 0) AS o
         FROM ra JOIN cb USING (var1, var2) JOIN tot USING (var1, var2)
         LEFT JOIN ct ON ct.var1 = ra.var1 AND ct.var2 = ra.var2 AND ct.a = ra.a AND ct.b = cb.b),
chi AS (SELECT var1, var2, any_value(N) AS N, any_value(r) AS r, any_value(k) AS k,
  CASE WHEN any_value((r - 1) * (k - 1)) = 0 THEN 0.0
       WHEN any_value((r - 1) * (k - 1)) = 1 THEN
         sum(power(greatest(abs(o - ra * cb / N) - 0.5, 0.0), 2) / (ra * cb / N))
       ELSE sum(power(o - ra * cb / N, 2) / (ra * cb / N)) END AS chi2
  FROM grid GROUP BY var1, var2)
"""


_CHI_COLS = ["p_type", "size_band", "big", "p_size"]


@query("chi_square", _ct_sql(_CHI_COLS) + """
SELECT var1, var2, round(chi2, 6) AS chi2, (r - 1) * (k - 1) AS dof, CAST(N AS BIGINT) AS n_total, r, k FROM chi
""")
def q_chi_square(spark, d):
    out = AS.chi_square(_part_cats(spark, d), _CHI_COLS)
    return out.withColumn("chi2", r6("chi2"))


@query("cramers_v", _ct_sql(_CAT) + """,
v AS (SELECT var1, var2,
  CASE WHEN least(k - 1, r - 1) = 0 OR chi2 / N = 0 THEN 0.0
       WHEN least(k - (k - 1) * (k - 1) / (N - 1) - 1, r - (r - 1) * (r - 1) / (N - 1) - 1) = 0 THEN 0.0
       ELSE sqrt(greatest(0.0, chi2 / N - (k - 1) * (r - 1) / (N - 1))
                 / least(k - (k - 1) * (k - 1) / (N - 1) - 1, r - (r - 1) * (r - 1) / (N - 1) - 1)) END AS cv
  FROM chi)
SELECT var1, var2, round(cv, 6) AS cramers_v FROM v WHERE cv >= 0.5
""")
def q_cramers_v(spark, d):
    out = AS.cramers_v(_part_cats(spark, d), _CAT, threshold=0.5)
    return out.withColumn("cramers_v", r6("cramers_v"))


_NUM = ["p_partkey", "p_size", "p_retailprice", "x_gap"]


def _part_nums(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", "p_size", "p_retailprice",
                    F.when(F.col("p_partkey") % 7 == 3, F.lit(None)).otherwise(F.col("p_size") * 2 + 1).alias("x_gap"))


def _spearman_sql():
    src = ("SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice, "
           "CAST(CASE WHEN p_partkey % 7 = 3 THEN NULL ELSE p_size * 2 + 1 END AS DOUBLE) AS x_gap FROM part")
    parts = []
    for a, b in AS.column_pairs(_NUM):
        parts.append(f"""SELECT '{a}' AS var1, '{b}' AS var2, corr(ra, rb) AS rho, count(*) AS n FROM (
  SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
  FROM src WHERE {a} IS NOT NULL AND {b} IS NOT NULL)""")
    return f"WITH src AS ({src}),\nrho AS (" + "\nUNION ALL\n".join(parts) + ")\n"


@query("spearman_pairs", _spearman_sql() + """
SELECT var1, var2, CAST(sign(rho) AS DOUBLE) AS sign, round(abs(rho), 6) AS abs_rho, n FROM rho WHERE abs(rho) >= 0.1
""")
def q_spearman_pairs(spark, d):
    out = AS.spearman_pairs(_part_nums(spark, d), _NUM, threshold=0.1, with_p=False)
    return out.select("var1", "var2", r6("sign").alias("sign"), r6("abs_rho").alias("abs_rho"), "n")


@query("spearman_test")
def q_spearman_test(spark, d):
    """F3 with the Student-t p-value (no SQL twin: DuckDB has no t distribution)."""
    return AS.spearman_pairs(_part_nums(spark, d), _NUM, threshold=0.0, with_p=True)


@query("pearson_matrix", "WITH src AS (SELECT p_partkey, p_size, p_retailprice, "
       "CASE WHEN p_partkey % 7 = 3 THEN NULL ELSE p_size * 2 + 1 END AS x_gap FROM part)\n" +
       "\nUNION ALL\n".join(
           f"SELECT '{a}' AS var1, '{b}' AS var2, {i} AS i, {j} AS j, round(corr({a}, {b}), 6) AS corr FROM src"
           for i, a in enumerate(_NUM) for j, b in enumerate(_NUM) if i >= j))
def q_pearson_matrix(spark, d):
    out = AS.pearson_matrix(_part_nums(spark, d), _NUM)
    return out.withColumn("corr", r6("corr"))
