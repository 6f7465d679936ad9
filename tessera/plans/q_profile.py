"""Queries: sources/sinks, profiling, aggregates, scaling, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.arrays import vector_first_one, vector_get, vector_size
from tessera.functions.hashing import sql_hash_u32
from tessera.operators import aggregate as G
from tessera.operators import encode as H
from tessera.operators import profile as B
from tessera.operators import scale as S
from tessera.plans import fixtures as fx
from tessera.plans.registry import query, r6
from tessera.session import checkpoint_dir, cut_lineage, remove_folder
from tessera.sources import files as io
from tessera.sources.tables import table


@query("csv_roundtrip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_csv_roundtrip(spark, d):
    path = io.scratch_path(spark, "nation-csv")
    io.write_csv(table(spark, d, "nation"), path)
    return io.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("matrix_scan", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_features,
  round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total
FROM embeddings
""")
def q_matrix_scan(spark, d):
    path = io.scratch_path(spark, "emb-matrix")
    io.write_matrix(table(spark, d, "embeddings"), "vec_id", "embedding", path, fmt="csv")
    m = io.read_matrix(spark, path, "vec_id", fmt="csv")
    return m.select("vec_id", F.size("features").alias("n_features"),
                    r6(F.aggregate("features", F.lit(0.0), lambda a, x: a + x)).alias("total"))


@query("table_shape", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_cols FROM orders")
def q_table_shape(spark, d):
    return B.shape(table(spark, d, "orders"))


def _profile_sql(table_name: str, cols: list[str], gaps: str | None = None) -> str:
    parts = [f"""SELECT '{c}' AS column,
  CAST(count(DISTINCT {c}) + CASE WHEN count(*) - count({c}) > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_distinct,
  CAST(count(*) - count({c}) AS BIGINT) AS n_null,
  CAST(count(*) - count({c}) > 0 AS INTEGER) AS has_null FROM {table_name}""" for c in cols]
    return (gaps or "") + "\nUNION ALL\n".join(parts)


@query("profile_numeric", _profile_sql("g", ["id", "price"], fx.with_fixtures("orders_gaps") +
                                       ", g AS (SELECT * FROM orders_gaps)\n"))
def q_profile_numeric(spark, d):
    return B.profile_numeric(fx.orders_gaps(spark, d))


@query("profile_non_numeric", _profile_sql("part", ["p_name", "p_brand", "p_type"]))
def q_profile_non_numeric(spark, d):
    return B.profile_non_numeric(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def q_distinct_values(spark, d):
    return B.distinct_values(table(spark, d, "part"), "p_brand")


@query("constant_columns", """
WITH e AS (SELECT doc_id, lang, source, n_chars >= 0 AS counted FROM documents)
SELECT "column" FROM (
  SELECT 'doc_id' AS column, count(DISTINCT doc_id) + (count(*) > count(doc_id))::INT AS nd FROM e
  UNION ALL SELECT 'lang', count(DISTINCT lang) + (count(*) > count(lang))::INT FROM e
  UNION ALL SELECT 'source', count(DISTINCT source) + (count(*) > count(source))::INT FROM e
  UNION ALL SELECT 'counted', count(DISTINCT counted) + (count(*) > count(counted))::INT FROM e)
WHERE nd = 1
""")
def q_constant_columns(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", (F.col("n_chars") >= 0).alias("counted"))
    return B.constant_columns(docs)


@query("has_null", fx.with_fixtures("orders_gaps") + """
SELECT max(CAST(id IS NULL AS INTEGER)) AS id, max(CAST(class IS NULL AS INTEGER)) AS class,
       max(CAST(price IS NULL AS INTEGER)) AS price FROM orders_gaps
""")
def q_has_null(spark, d):
    return B.has_null(fx.orders_gaps(spark, d))


@query("value_counts", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type")
def q_value_counts(spark, d):
    return G.value_counts(table(spark, d, "part"), "p_type")


@query("value_shares", fx.with_fixtures("events_skewed") + """
SELECT class, count(*) AS n, round(count(*) / (SELECT count(*) FROM events_skewed), 6) AS share
FROM events_skewed GROUP BY class
""")
def q_value_shares(spark, d):
    v = G.value_shares(fx.events_skewed(spark, d), "class")
    return v.withColumn("share", r6("share"))


@query("describe", """
SELECT event_type, 'value' AS column, count(value) AS n, round(avg(value), 6) AS mean,
  round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std, round(stddev_pop(value), 6) AS std_pop,
  round(min(value), 6) AS min, round(max(value), 6) AS max
FROM events GROUP BY event_type
""")
def q_describe(spark, d):
    e = table(spark, d, "events")
    out = G.describe(e, ["value"], ["event_type"])
    return out.select("event_type", "column", "n", *[r6(c).alias(c) for c in
                                                      ("mean", "median", "std", "std_pop", "min", "max")])


@query("crosstab", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def q_crosstab(spark, d):
    return G.crosstab_long(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query("compare_distribution", fx.with_fixtures("events_skewed") + """,
b AS (SELECT class, count(*) AS n FROM events_skewed GROUP BY class),
a AS (SELECT class, count(*) AS n FROM (
  SELECT id, class, row_number() OVER (PARTITION BY class ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn
  FROM events_skewed) WHERE rn <= 900 GROUP BY class)
SELECT coalesce(b.class, a.class) AS class, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after
FROM b FULL OUTER JOIN a ON b.class = a.class
""")
def q_compare_distribution(spark, d):
    from tessera.operators.window import cap_per_class
    e = fx.events_skewed(spark, d)
    before = G.crosstab_long(e.withColumn("k", F.lit(1)), "class", "k").drop("k")
    after = G.crosstab_long(cap_per_class(e, "class", "id", 900).withColumn("k", F.lit(1)), "class", "k").drop("k")
    return G.compare_distribution(before, after, "class")


# ---- scaling ---------------------------------------------------------------
# (``+ 0.0`` turns a rounded -0.0 into 0.0, as Spark's decimal rounding does)

_Z_SQL = """
SELECT avg(value) AS m, CASE WHEN stddev_pop(value) IS NULL OR stddev_pop(value) = 0 THEN 1.0
  ELSE stddev_pop(value) END AS s FROM events"""


@query("z_score", f"""
WITH p AS ({_Z_SQL})
SELECT event_id, round((value - p.m) / p.s, 6) + 0.0 AS value_z FROM events, p
""")
def q_z_score(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return S.z_score(e, ["value"], suffix="_z").select("event_id", r6("value_z").alias("value_z"))


@query("scale_params", f"WITH p AS ({_Z_SQL}) SELECT round(m, 6) AS mean_value, round(s, 6) AS scale_value FROM p")
def q_scale_params(spark, d):
    p = S.fit_standard(table(spark, d, "events"), ["value"])
    return p.select(r6("mean_value").alias("mean_value"), r6("scale_value").alias("scale_value"))


@query("inverse_scale", f"""
WITH p AS ({_Z_SQL})
SELECT event_id, round(((value - p.m) / p.s) * p.s + p.m, 6) AS value_back FROM events, p
""")
def q_inverse_scale(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    params = S.fit_standard(e, ["value"])
    z = S.apply_standard(e, params, ["value"], suffix="_z")
    back = S.inverse_standard(z, params, "value_z", "value", "value_back")
    return back.select("event_id", r6("value_back").alias("value_back"))


@query("log_scaled", """
WITH l AS (SELECT event_id, ln(1 + value) AS lv FROM events),
p AS (SELECT avg(lv) AS m, CASE WHEN stddev_pop(lv) IS NULL OR stddev_pop(lv) = 0 THEN 1.0 ELSE stddev_pop(lv) END AS s FROM l)
SELECT event_id, round((lv - p.m) / p.s, 6) + 0.0 AS value FROM l, p
""")
def q_log_scaled(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return S.log_scaled(e, ["value"]).select("event_id", r6("value").alias("value"))


@query("distribution_stages", """
WITH l AS (SELECT value AS raw, ln(1 + value) AS lv FROM events),
p AS (SELECT avg(lv) AS m, CASE WHEN stddev_pop(lv) = 0 THEN 1.0 ELSE stddev_pop(lv) END AS s FROM l),
st AS (SELECT 'raw' AS stage, raw AS v FROM l UNION ALL SELECT 'log1p', lv FROM l
       UNION ALL SELECT 'log1p_z', (lv - p.m) / p.s FROM l, p)
SELECT stage, round(avg(v), 6) + 0.0 AS mean, round(median(v), 6) + 0.0 AS median, round(stddev_samp(v), 6) AS std
FROM st GROUP BY stage
""")
def q_distribution_stages(spark, d):
    out = S.distribution_stages(table(spark, d, "events"), "value")
    return out.select("stage", r6("mean").alias("mean"), r6("median").alias("median"), r6("std").alias("std"))


_HIST_SQL = """
WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 20 ELSE 1.0 END AS width FROM r),
h AS (SELECT CAST(least(floor((value - w.lo) / w.width), 19) AS INTEGER) AS bin, count(*) AS n
      FROM events, w WHERE value IS NOT NULL GROUP BY 1)
"""


@query("histogram", _HIST_SQL + """
SELECT bin, round(w.lo + bin * w.width, 6) AS bin_lo, round(w.lo + (bin + 1) * w.width, 6) AS bin_hi, n FROM h, w
""")
def q_histogram(spark, d):
    h = S.histogram(table(spark, d, "events"), "value", 20)
    return h.select("bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "n")


@query("histogram_markers", _HIST_SQL + """,
s AS (SELECT avg(value) AS mean, stddev_samp(value) AS std, median(value) AS med FROM events),
b AS (SELECT bin, w.lo + bin * w.width AS bin_lo, w.lo + (bin + 1) * w.width AS bin_hi, n FROM h, w)
SELECT bin, n,
  CAST(s.mean >= bin_lo AND (s.mean < bin_hi OR bin = 19) AS INTEGER) AS has_mean,
  CAST(s.med >= bin_lo AND (s.med < bin_hi OR bin = 19) AS INTEGER) AS has_median,
  CAST(s.mean - s.std >= bin_lo AND (s.mean - s.std < bin_hi OR bin = 19) AS INTEGER) AS has_mean_minus_std,
  CAST(s.mean + s.std >= bin_lo AND (s.mean + s.std < bin_hi OR bin = 19) AS INTEGER) AS has_mean_plus_std
FROM b, s
""")
def q_histogram_markers(spark, d):
    h = S.histogram_markers(table(spark, d, "events"), "value", 20)
    return h.drop("bin_lo", "bin_hi")


# ---- encoding --------------------------------------------------------------

@query("label_encode", """
SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type_code FROM part
""")
def q_label_encode(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type")
    return H.label_encode(p, "p_type")


@query("label_decode", """
WITH codes AS (SELECT p_type AS value, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS idx
               FROM (SELECT DISTINCT p_type FROM part))
SELECT o_orderkey, CAST(o_orderkey % 7 AS INTEGER) AS code, c.value AS decoded
FROM orders LEFT JOIN codes c ON CAST(o_orderkey % 7 AS INTEGER) = c.idx
""")
def q_label_decode(spark, d):
    codes = H.fit_codes(table(spark, d, "part"), "p_type")
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).cast("int").alias("code"))
    return H.label_decode(o, "code", codes, "decoded")


@query("ordinal_encode", """
WITH codes AS (SELECT p_size AS value, CAST(dense_rank() OVER (ORDER BY p_size) - 1 AS INTEGER) AS idx
               FROM (SELECT DISTINCT p_size FROM part WHERE p_size <= 40))
SELECT p_partkey, p_size, CAST(c.idx AS DOUBLE) AS p_size_code FROM part LEFT JOIN codes c ON part.p_size = c.value
""")
def q_ordinal_encode(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size")
    codes = H.fit_codes(p.where(F.col("p_size") <= 40), "p_size")  # fit on a part: larger sizes are unknown
    # unknown -> NULL code: reported as a double on both engines
    return H.ordinal_encode(p, "p_size", codes).withColumn("p_size_code", F.col("p_size_code").cast("double"))


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("one_hot", "SELECT p_partkey, " + ", ".join(
    f"CAST(coalesce(p_type = '{t}', false) AS INTEGER) AS p_type_{t}" for t in _TYPES) + " FROM part")
def q_one_hot(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type")
    return H.one_hot(p, "p_type")


@query("dummies_drop_first", "SELECT p_partkey, " + ", ".join(
    f"CAST(coalesce(p_type = '{t}', false) AS INTEGER) AS p_type_{t}" for t in _TYPES[1:]) + " FROM part")
def q_dummies(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type")
    return H.one_hot(p, "p_type", null_is_level=False, drop_first=True)


@query("feature_names", """
SELECT CAST(position AS INTEGER) AS position, "group", name FROM (VALUES
  (0, 'onehot', 'c_mktsegment_AUTOMOBILE'), (1, 'onehot', 'c_mktsegment_BUILDING'),
  (2, 'onehot', 'c_mktsegment_FURNITURE'), (3, 'onehot', 'c_mktsegment_HOUSEHOLD'),
  (4, 'onehot', 'c_mktsegment_MACHINERY'), (5, 'ordinal', 'c_nationkey_ord'), (6, 'scaled', 'c_acctbal_z'))
  AS t(position, "group", name)
""")
def q_feature_names(spark, d):
    c = table(spark, d, "customer")
    _, names = H.feature_matrix(c, "c_custkey", one_hot_cols=["c_mktsegment"], ordinal_cols=["c_nationkey"],
                                scaled_cols=["c_acctbal"])
    return names


@query("feature_matrix")
def q_feature_matrix(spark, d):
    from pyspark.ml.functions import vector_to_array
    c = table(spark, d, "customer")
    m, _ = H.feature_matrix(c, "c_custkey", one_hot_cols=["c_mktsegment"], ordinal_cols=["c_nationkey"],
                            scaled_cols=["c_acctbal"])
    return m.select("c_custkey", vector_to_array("features").alias("features"))


@query("feature_matrix_wide", """
WITH l AS (SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS pos FROM (SELECT DISTINCT c_name FROM customer)),
s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer)
SELECT c_custkey, pos, CAST((SELECT count(*) FROM l) + 1 AS INTEGER) AS size, 'c_name_' || c_name AS name,
       round((c_acctbal - m) / sd, 6) + 0.0 AS z
FROM customer JOIN l USING (c_name), s
""")
def q_feature_matrix_wide(spark, d):
    """H3/H6 with as many levels as rows: the vector's length, its one-hot place and that place's name."""
    c = table(spark, d, "customer")
    m, names = H.feature_matrix(c, "c_custkey", one_hot_cols=["c_name"], scaled_cols=["c_acctbal"])
    size = vector_size("features")
    out = m.select("c_custkey", size.alias("size"), vector_first_one("features", size - 1).cast("int").alias("pos"),
                   r6(vector_get("features", size - 1)).alias("z"))
    return out.join(names.select(F.col("position").alias("pos"), "name"), "pos").select("c_custkey", "pos", "size", "name", "z")


@query("saved_transforms", f"""
WITH t AS (SELECT * FROM customer WHERE {sql_hash_u32('42', 'c_custkey')} % 100 < 80),
seg AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT c_mktsegment FROM t)),
name AS (SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS pos FROM (SELECT DISTINCT c_name FROM t)),
nat AS (SELECT c_nationkey, CAST(row_number() OVER (ORDER BY c_nationkey) - 1 AS DOUBLE) AS nation FROM (SELECT DISTINCT c_nationkey FROM t)),
s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM t)
SELECT c_custkey, code AS segment, coalesce(pos, -1) AS pos, CAST((SELECT count(*) FROM name) + 2 AS INTEGER) AS size,
       coalesce(nation, -1.0) AS nation, round((c_acctbal - m) / sd, 6) + 0.0 AS z
FROM customer LEFT JOIN seg USING (c_mktsegment) LEFT JOIN name USING (c_name) LEFT JOIN nat USING (c_nationkey), s
""")
def q_saved_transforms(spark, d):
    """Label codes and a feature matrix fitted on the training rows, saved as one pipeline, loaded again and applied to all rows
    (names of rows that were not fitted are unseen levels)."""
    import uuid

    from pyspark.ml import Pipeline
    from tessera.operators.balance import train_val_split
    from tessera.operators.transforms import FeatureMatrix, LabelCodes
    from tessera.sources.files import load_pipeline, save_model

    c = train_val_split(table(spark, d, "customer"), "c_custkey")
    stages = [LabelCodes(inputCol="c_mktsegment", outputCol="segment"),
              FeatureMatrix(oneHotCols=["c_name"], ordinalCols=["c_nationkey"], scaledCols=["c_acctbal"])]
    path = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-model-{uuid.uuid4().hex}"
    save_model(Pipeline(stages=stages).fit(c.where("split = 'train'")), path)
    size = vector_size("features")
    out = load_pipeline(path).transform(c).select(
        "c_custkey", "segment", vector_first_one("features", size - 2).cast("int").alias("pos"), size.alias("size"),
        F.nanvl(vector_get("features", size - 2), F.lit(-1.0)).alias("nation"), r6(vector_get("features", size - 1)).alias("z"))
    out = cut_lineage(out)
    remove_folder(spark, path)
    return out


@query("crosstab_margins", """
WITH ct AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS total, count(DISTINCT l_returnflag) AS n_rows, count(DISTINCT l_linestatus) AS n_cols FROM ct
""")
def q_crosstab_margins(spark, d):
    ct = G.crosstab_long(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")
    return G.crosstab_margins(ct, "l_returnflag", "l_linestatus")
