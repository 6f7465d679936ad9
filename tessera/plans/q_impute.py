"""Queries: imputation, neighbours, balancing, splits, keyed zips."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import sql_hash_u32
from tessera.operators import balance as J
from tessera.operators import impute as I
from tessera.operators.joins import semi_join_sample, zip_by_id
from tessera.operators.neighbors import knn_join
from tessera.plans import fixtures as fx
from tessera.plans.registry import query, r6

_IND = "missingindicator_x"


def _simple_sql(stat: str) -> str:
    return fx.with_fixtures("part_gaps") + f"""
SELECT id, round(coalesce(CAST(x AS DOUBLE), ({stat})), 6) AS x, round(CAST(y AS DOUBLE), 6) AS y,
  CAST(x IS NULL AS INTEGER) AS {_IND}
FROM part_gaps
"""


def _simple(strategy):
    def run(spark, d):
        out = I.simple_impute(fx.part_gaps(spark, d), ["x", "y"], strategy)
        return out.select("id", r6("x").alias("x"), r6("y").alias("y"), _IND)
    return run


query("impute_zero", _simple_sql("0.0"))(_simple("constant"))
query("impute_mean", _simple_sql("SELECT avg(x) FROM part_gaps"))(_simple("mean"))
query("impute_median", _simple_sql("SELECT median(x) FROM part_gaps"))(_simple("median"))


def _knn_impute_sql(k: int) -> str:
    return fx.with_fixtures("part_gaps") + f""",
pairs AS (
  SELECT r.id, d.id AS donor, d.x AS dx,
         row_number() OVER (PARTITION BY r.id ORDER BY (r.y - d.y) * (r.y - d.y), d.id) AS rk
  FROM part_gaps r JOIN part_gaps d ON d.x IS NOT NULL AND d.y IS NOT NULL
  WHERE r.x IS NULL AND r.y IS NOT NULL),
est AS (SELECT id, avg(dx) AS est FROM pairs WHERE rk <= {k} GROUP BY id)
SELECT g.id, round(coalesce(CAST(g.x AS DOUBLE), e.est, (SELECT avg(x) FROM part_gaps)), 6) AS x,
  round(CAST(g.y AS DOUBLE), 6) AS y, CAST(g.x IS NULL AS INTEGER) AS {_IND}
FROM part_gaps g LEFT JOIN est e ON g.id = e.id
"""


def _knn(k):
    def run(spark, d):
        out = I.impute_knn(fx.part_gaps(spark, d), "id", ["x", "y"], k=k)
        return out.select("id", r6("x").alias("x"), r6("y").alias("y"), _IND)
    return run


query("impute_knn5", _knn_impute_sql(5))(_knn(5))
query("impute_knn15", _knn_impute_sql(15))(_knn(15))


@query("inject_missing", fx.with_fixtures("part_gaps") + f""",
m AS (SELECT id, x, y, CASE WHEN {sql_hash_u32('42', 'id')} % 1000000 < 500000
        THEN ['x', 'y'][CAST({sql_hash_u32('42', "'col'", 'id')} % 2 + 1 AS INTEGER)] END AS injected
      FROM part_gaps)
SELECT id, CAST(CASE WHEN injected = 'x' THEN NULL ELSE x END AS DOUBLE) AS x,
  CAST(CASE WHEN injected = 'y' THEN NULL ELSE y END AS DOUBLE) AS y, injected FROM m
""")
def q_inject_missing(spark, d):
    # nullable integers are reported as doubles on both engines (one NULL marker in every client)
    out = I.inject_missing(fx.part_gaps(spark, d), "id", ["x", "y"], 0.5, 42)
    return out.select("id", F.col("x").cast("double"), F.col("y").cast("double"), "injected")


_KNN_SQL = """,
pairs AS (
  SELECT a.id, b.id AS neighbor, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2,
    row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS rank
  FROM {t} a JOIN {t} b ON a.id <> b.id)
"""


@query("knn_join", fx.with_fixtures("part_class") + _KNN_SQL.format(t="part_class") + """
SELECT id, neighbor, round(sqrt(d2), 6) AS dist, CAST(rank AS INTEGER) AS rank FROM pairs WHERE rank <= 3
""")
def q_knn_join(spark, d):
    pc = fx.part_class(spark, d)
    nn = knn_join(pc, pc, "id", "id", ["x", "y"], 3, exclude_self=True)
    return nn.select("id", "neighbor", r6("dist").alias("dist"), "rank")


@query("knn_far_queries", """
WITH r AS (SELECT p_partkey AS id, p_size AS x, floor(p_retailprice) AS y FROM part),
q AS (SELECT s_suppkey AS id, 1000000 + s_suppkey % 7 AS x, -s_nationkey AS y FROM supplier),
pairs AS (SELECT q.id, r.id AS neighbor, (q.x - r.x) * (q.x - r.x) + (q.y - r.y) * (q.y - r.y) AS d2,
    row_number() OVER (PARTITION BY q.id ORDER BY (q.x - r.x) * (q.x - r.x) + (q.y - r.y) * (q.y - r.y), r.id) AS rank FROM q, r)
SELECT id, neighbor, round(sqrt(d2), 6) AS dist, CAST(rank AS INTEGER) AS rank FROM pairs WHERE rank <= 3
""")
def q_knn_far_queries(spark, d):
    """Queries far from every reference: no cell near them holds one."""
    refs = fx.part_class(spark, d)
    s = fx.table(spark, d, "supplier")
    q = s.select(F.col("s_suppkey").alias("id"), (1000000 + F.col("s_suppkey") % 7).alias("x"), (-F.col("s_nationkey")).alias("y"))
    nn = knn_join(q, refs, "id", "id", ["x", "y"], 3)
    return nn.select("id", "neighbor", r6("dist").alias("dist"), "rank")


@query("impute_knn_isolated", """
WITH g AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS x,
                  floor(p_retailprice) + CASE WHEN p_partkey % 35 = 3 THEN 10000000 ELSE 0 END AS y FROM part),
nn AS (SELECT a.id, b.x AS v, row_number() OVER (PARTITION BY a.id ORDER BY abs(a.y - b.y), b.id) AS rk
       FROM g a JOIN g b ON b.x IS NOT NULL WHERE a.x IS NULL),
f AS (SELECT id, avg(v) AS v FROM nn WHERE rk <= 5 GROUP BY id)
SELECT g.id, round(coalesce(g.x, f.v), 6) AS x, round(CAST(g.y AS DOUBLE), 6) AS y FROM g LEFT JOIN f ON f.id = g.id
""")
def q_impute_knn_isolated(spark, d):
    """Receivers far from every donor get the nearest donors' average, not the column's mean."""
    p = fx.table(spark, d, "part")
    k = F.col("p_partkey")
    g = p.select(k.alias("id"), F.when(k % 7 != 3, F.col("p_size").cast("double")).alias("x"),
                 (F.floor("p_retailprice") + F.when(k % 35 == 3, 10000000).otherwise(0)).cast("double").alias("y"))
    out = I.impute_knn(g, "id", ["x", "y"], k=5, add_indicator=False)
    return out.select("id", r6("x").alias("x"), r6("y").alias("y"))


@query("edited_nn", fx.with_fixtures("part_class") + _KNN_SQL.format(t="part_class") + """,
bad AS (SELECT DISTINCT p.id FROM pairs p JOIN part_class a ON a.id = p.id JOIN part_class b ON b.id = p.neighbor
        WHERE p.rank <= 3 AND a.label <> b.label)
SELECT id, x, y, label FROM part_class WHERE id NOT IN (SELECT id FROM bad)
""")
def q_edited_nn(spark, d):
    return J.edited_nn(fx.part_class(spark, d), "id", ["x", "y"], "label", k=3).select("id", "x", "y", "label")


@query("adasyn_weights", fx.with_fixtures("part_imbalanced") + """,
cnt AS (SELECT label, count(*) AS n FROM part_imbalanced GROUP BY label),
mino AS (SELECT label FROM cnt ORDER BY n, label LIMIT 1),
pairs AS (
  SELECT a.id, b.label AS nl,
    row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS rk
  FROM part_imbalanced a JOIN part_imbalanced b ON a.id <> b.id
  WHERE a.label = (SELECT label FROM mino)),
oth AS (SELECT id, count(*) FILTER (WHERE nl <> (SELECT label FROM mino)) AS n_other FROM pairs WHERE rk <= 5 GROUP BY id)
SELECT id, n_other, CAST(round_even(n_other / (SELECT sum(n_other) FROM oth)
  * ((SELECT max(n) FROM cnt) - (SELECT min(n) FROM cnt)), 0) AS INTEGER) AS g
FROM oth
""")
def q_adasyn_weights(spark, d):
    return J.adasyn_weights(fx.part_imbalanced(spark, d), "id", ["x", "y"], "label", k=5)


@query("adasyn_three_classes", """
WITH t AS (SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS x, CAST(floor(p_retailprice) AS BIGINT) AS y,
                  CASE WHEN p_size > 42 THEN 'L' WHEN p_size > 30 THEN 'M' ELSE 'S' END AS label FROM part),
cnt AS (SELECT label, count(*) AS n FROM t GROUP BY label),
need AS (SELECT label, (SELECT max(n) FROM cnt) - n AS need FROM cnt WHERE n < (SELECT max(n) FROM cnt)),
pairs AS (SELECT a.id, a.label, b.label AS nl,
            row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS rk
          FROM t a JOIN t b ON a.id <> b.id WHERE a.label IN (SELECT label FROM need)),
oth AS (SELECT id, label, count(*) FILTER (WHERE nl <> label) AS n_other FROM pairs WHERE rk <= 5 GROUP BY id, label),
tot AS (SELECT label, sum(n_other) AS s FROM oth GROUP BY label)
SELECT id, n_other, CAST(CASE WHEN s > 0 THEN round_even(n_other / s * need, 0) ELSE 0 END AS INTEGER) AS g
FROM oth JOIN tot USING (label) JOIN need USING (label)
""")
def q_adasyn_three(spark, d):
    p = fx.table(spark, d, "part")
    t = p.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("bigint").alias("x"), F.floor("p_retailprice").cast("bigint").alias("y"),
                 F.when(F.col("p_size") > 42, "L").when(F.col("p_size") > 30, "M").otherwise("S").alias("label"))
    return J.adasyn_weights(t, "id", ["x", "y"], "label", k=5)


_D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"


@query("adasyn", fx.with_fixtures("part_imbalanced") + f""",
cnt AS (SELECT label, count(*) AS n FROM part_imbalanced GROUP BY label),
mino AS (SELECT label FROM cnt ORDER BY n, label LIMIT 1),
m AS (SELECT * FROM part_imbalanced WHERE label = (SELECT label FROM mino)),
allnn AS (SELECT a.id, b.label AS nl, row_number() OVER (PARTITION BY a.id ORDER BY {_D2}, b.id) AS rk
          FROM m a JOIN part_imbalanced b ON a.id <> b.id),
oth AS (SELECT id, count(*) FILTER (WHERE nl <> (SELECT label FROM mino)) AS n_other FROM allnn WHERE rk <= 5 GROUP BY id),
w AS (SELECT id, CAST(round_even(n_other / (SELECT sum(n_other) FROM oth)
        * ((SELECT max(n) FROM cnt) - (SELECT min(n) FROM cnt)), 0) AS INTEGER) AS g FROM oth),
mnn AS (SELECT a.id, a.x, a.y, b.x AS nx, b.y AS ny,
               row_number() OVER (PARTITION BY a.id ORDER BY {_D2}, b.id) AS rk
        FROM m a JOIN m b ON a.id <> b.id),
mnn5 AS (SELECT * FROM mnn WHERE rk <= 5),
nbc AS (SELECT id, count(*) AS c FROM mnn5 GROUP BY id),
draws AS (SELECT id, c, unnest(generate_series(1, g)) AS j FROM w JOIN nbc USING (id) WHERE g > 0),
pick AS (SELECT id, j, CAST({sql_hash_u32('42', 'id', 'j')} % c + 1 AS BIGINT) AS rk,
                {sql_hash_u32('42', "'step'", 'id', 'j')} / 4294967296.0 AS lam FROM draws)
SELECT p.id AS src_id, p.j, round(n.x + p.lam * (n.nx - n.x), 6) AS x, round(n.y + p.lam * (n.ny - n.y), 6) AS y,
       (SELECT label FROM mino) AS label
FROM pick p JOIN mnn5 n ON p.id = n.id AND p.rk = n.rk
""")
def q_adasyn(spark, d):
    """J2 synthetic rows (md5-drawn neighbour and step, reproducible in SQL)."""
    out = J.adasyn(fx.part_imbalanced(spark, d), "id", ["x", "y"], "label", k=5)
    return out.select("src_id", F.col("j").cast("bigint").alias("j"), r6("x").alias("x"), r6("y").alias("y"), "label")


@query("train_val_split", fx.with_fixtures("orders_labelled") + f"""
SELECT id, CASE WHEN {sql_hash_u32('42', 'id')} % 100 < 80 THEN 'train' ELSE 'val' END AS split FROM orders_labelled
""")
def q_train_val_split(spark, d):
    return J.train_val_split(fx.orders_labelled(spark, d), "id").select("id", "split")


@query("kfold_ids", fx.with_fixtures("orders_labelled") + f"""
SELECT id, CAST({sql_hash_u32('42', 'id')} % 5 AS INTEGER) AS fold FROM orders_labelled
""")
def q_kfold_ids(spark, d):
    return J.kfold_ids(fx.orders_labelled(spark, d), "id").select("id", "fold")


@query("zip_by_id", fx.with_fixtures("orders_labelled") + """
SELECT o.o_orderkey AS id, o.o_orderpriority, l.class0 FROM orders o JOIN orders_labelled l ON o.o_orderkey = l.id
""")
def q_zip_by_id(spark, d):
    o = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    return zip_by_id(o, fx.orders_labelled(spark, d).select("id", "class0"), "id")


@query("semi_join_sample", fx.with_fixtures("events_skewed") + """,
s AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY class ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn
      FROM events_skewed) WHERE rn <= 900)
SELECT e.event_id AS id, e.event_type FROM events e WHERE e.event_id IN (SELECT id FROM s)
""")
def q_semi_join_sample(spark, d):
    from tessera.operators.window import cap_per_class
    sample = cap_per_class(fx.events_skewed(spark, d), "class", "id", 900)
    ev = fx.table(spark, d, "events").select(F.col("event_id").alias("id"), "event_type")
    return semi_join_sample(ev, sample, "id")
