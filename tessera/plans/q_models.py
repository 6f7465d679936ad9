"""Queries: models, evaluation, scoring, text vectors, imputation study."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.functions.arrays import softmax
from tessera.operators import models as K
from tessera.operators import scale as S
from tessera.operators import study as ST
from tessera.operators.textvec import text_norm_feature, word2vec_features
from tessera.plans import fixtures as fx
from tessera.plans.registry import query, r6
from tessera.session import cut_lineage
from tessera.sources.tables import table


def _model_frame(spark, d):
    """Part rows with a label derived from a feature (size band) and a price."""
    p = table(spark, d, "part")
    df = p.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("size"),
                  F.length("p_name").cast("double").alias("name_len"),
                  F.when(F.col("p_size") > 33, "large").when(F.col("p_size") > 16, "medium")
                  .otherwise("small").alias("band"), F.col("p_retailprice").alias("price"))
    params = S.fit_standard(df, ["price"])
    df = S.apply_standard(df, params, ["price"], suffix="_z")
    df = VectorAssembler(inputCols=["size", "name_len"], outputCol="features").transform(df)
    return df, params


@query("class_model")
def q_class_model(spark, d):
    from pyspark.ml.feature import StringIndexer
    df, _ = _model_frame(spark, d)
    df = StringIndexer(inputCol="band", outputCol="label_idx", stringOrderType="alphabetAsc").fit(df).transform(df)
    m = K.class_model().fit(df)
    return m.transform(df).select("id", "band", F.col("class_pred").cast("int").alias("class_pred"))


@query("price_model")
def q_price_model(spark, d):
    df, _ = _model_frame(spark, d)
    m = K.price_model().fit(df)
    return m.transform(df).select("id", "price_z", "price_pred")


@query("score_table")
def q_score_table(spark, d):
    """K3 + K6: fit both heads on the train split, score the held-out rows."""
    from tessera.operators.balance import train_val_split
    df, params = _model_frame(spark, d)
    df = train_val_split(df, "id")
    model = K.two_target_model(df.where(F.col("split") == "train"), "band", "price_z")
    p = params.select(F.struct("mean_price", "scale_price").alias("p")).scalar()
    return K.score_table(model, df.where(F.col("split") == "val"), "id", p["mean_price"], p["scale_price"])


@query("eval_losses", """
WITH z AS (SELECT vec_id, label AS lbl, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS z,
                  CAST(embedding[4] AS DOUBLE) * 3 AS pred, CAST(embedding[5] AS DOUBLE) * 3 AS tgt FROM embeddings),
p AS (SELECT *, list_transform(z, lambda x: exp(x - list_max(z))) AS ex FROM z),
q AS (SELECT *, ex[lbl + 1] / list_sum(ex) AS pl, pred - tgt AS e FROM p)
SELECT round(avg(-ln(pl)), 6) AS ce,
  round(avg(CASE WHEN abs(e) <= 1 THEN 0.5 * e * e ELSE abs(e) - 0.5 END), 6) AS huber,
  round(avg(-ln(pl)) + avg(CASE WHEN abs(e) <= 1 THEN 0.5 * e * e ELSE abs(e) - 0.5 END), 6) AS total
FROM q
""")
def q_eval_losses(spark, d):
    e = table(spark, d, "embeddings")
    z = F.transform("embedding", lambda x: x.cast("double"))
    df = e.select(softmax(z).alias("prob"), F.col("label").alias("lbl"),
                  (F.get("embedding", 3).cast("double") * 3).alias("pred"),
                  (F.get("embedding", 4).cast("double") * 3).alias("tgt"))
    out = K.eval_losses(df, "prob", "lbl", "pred", "tgt")
    return out.select(*[r6(c).alias(c) for c in ("ce", "huber", "total")])


@query("compare_predictions", fx.with_fixtures("orders_labelled") + """,
a AS (SELECT id, class0 AS class_name, price0 AS price FROM orders_labelled),
b AS (SELECT o_orderkey AS id, 'B' || CAST(CAST(floor(o_totalprice * 1.05 / 100000) AS INTEGER) AS VARCHAR) AS class_name,
             o_totalprice * 1.05 AS price FROM orders)
SELECT a.class_name AS class_a, b.class_name AS class_b, count(*) AS n, round(avg(abs(a.price - b.price)), 6) AS mean_abs_gap
FROM a JOIN b ON a.id = b.id GROUP BY 1, 2
""")
def q_compare_predictions(spark, d):
    a = fx.orders_labelled(spark, d).select("id", F.col("class0").alias("class_name"), F.col("price0").alias("price"))
    o = table(spark, d, "orders")
    b = o.select(F.col("o_orderkey").alias("id"),
                 F.concat(F.lit("B"), F.floor(F.col("o_totalprice") * 1.05 / 100000).cast("int").cast("string"))
                 .alias("class_name"), (F.col("o_totalprice") * 1.05).alias("price"))
    out = K.compare_predictions(a, b, "id")
    return out.withColumn("mean_abs_gap", r6("mean_abs_gap"))


@query("linear_fit", """
WITH f AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS s1, regr_intercept(l_extendedprice, l_quantity) AS i1,
                  regr_slope(l_discount, l_quantity) AS s2, regr_intercept(l_discount, l_quantity) AS i2
           FROM lineitem GROUP BY 1)
SELECT l.l_returnflag, 'l_extendedprice' AS target, round(any_value(f.s1), 6) AS slope, round(any_value(f.i1), 6) AS intercept,
  round(sqrt(avg(power(l.l_extendedprice - (f.i1 + f.s1 * l.l_quantity), 2))), 6) AS rmse
FROM lineitem l JOIN f USING (l_returnflag) GROUP BY 1
UNION ALL
SELECT l.l_returnflag, 'l_discount', round(any_value(f.s2), 6), round(any_value(f.i2), 6),
  round(sqrt(avg(power(l.l_discount - (f.i2 + f.s2 * l.l_quantity), 2))), 6)
FROM lineitem l JOIN f USING (l_returnflag) GROUP BY 1
""")
def q_linear_fit(spark, d):
    li = table(spark, d, "lineitem")
    out = K.linear_fit(li, "l_quantity", ["l_extendedprice", "l_discount"], ["l_returnflag"])
    return out.select("l_returnflag", "target", *[r6(c).alias(c) for c in ("slope", "intercept", "rmse")])


@query("word2vec_features")
def q_word2vec(spark, d):
    """H8/H9: document vectors fitted on the training split only."""
    docs = fx.docs(spark, d).withColumn("split", fx.train_flag(F.col("id")))
    _, (tr, te) = word2vec_features(docs.where(F.col("split") == "train"), [docs.where(F.col("split") == "test")],
                                    "text", "id")
    return tr.unionByName(te)


@query("text_norm_feature")
def q_text_norm(spark, d):
    """Text column replaced by the norm of its document vector."""
    docs = fx.docs(spark, d).withColumn("split", fx.train_flag(F.col("id")))
    tr, te = text_norm_feature(docs.where(F.col("split") == "train"), [docs.where(F.col("split") == "test")],
                               ["text"], "id")
    return tr.unionByName(te)


_ERR_SQL = """
WITH truth AS (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x, floor(p_retailprice) AS y FROM part),
inj AS (SELECT *, CASE WHEN {h1} % 1000000 < 500000 THEN ['x', 'y'][CAST({h2} % 2 + 1 AS INTEGER)] END AS injected
        FROM truth),
m AS (SELECT id, injected, CASE WHEN injected = 'x' THEN NULL ELSE x END AS x,
             CASE WHEN injected = 'y' THEN NULL ELSE y END AS y FROM inj),
st AS (SELECT avg(x) AS mx, avg(y) AS my, median(x) AS medx, median(y) AS medy FROM m),
nnx AS (SELECT r.id, d.x AS v, row_number() OVER (PARTITION BY r.id ORDER BY abs(r.y - d.y), d.id) AS rk
        FROM m r JOIN m d ON d.x IS NOT NULL AND d.y IS NOT NULL WHERE r.injected = 'x'),
nny AS (SELECT r.id, d.y AS v, row_number() OVER (PARTITION BY r.id ORDER BY abs(r.x - d.x), d.id) AS rk
        FROM m r JOIN m d ON d.x IS NOT NULL AND d.y IS NOT NULL WHERE r.injected = 'y'),
k5 AS (SELECT id, avg(v) AS v FROM (SELECT * FROM nnx UNION ALL SELECT * FROM nny) WHERE rk <= 5 GROUP BY id),
k15 AS (SELECT id, avg(v) AS v FROM (SELECT * FROM nnx UNION ALL SELECT * FROM nny) WHERE rk <= 15 GROUP BY id),
e AS (
  SELECT 'zero' AS method, injected AS "column", 0.0 - CASE injected WHEN 'x' THEN i.x ELSE i.y END AS err FROM inj i WHERE injected IS NOT NULL
  UNION ALL SELECT 'mean', injected, CASE injected WHEN 'x' THEN st.mx - i.x ELSE st.my - i.y END FROM inj i, st WHERE injected IS NOT NULL
  UNION ALL SELECT 'median', injected, CASE injected WHEN 'x' THEN st.medx - i.x ELSE st.medy - i.y END FROM inj i, st WHERE injected IS NOT NULL
  UNION ALL SELECT 'knn5', injected, k5.v - CASE injected WHEN 'x' THEN i.x ELSE i.y END FROM inj i JOIN k5 USING (id)
  UNION ALL SELECT 'knn15', injected, k15.v - CASE injected WHEN 'x' THEN i.x ELSE i.y END FROM inj i JOIN k15 USING (id))
SELECT method, "column", count(*) AS n, round(avg(abs(err)), 6) AS mae, round(sqrt(avg(err * err)), 6) AS rmse
FROM e GROUP BY 1, 2
"""


def _err_sql():
    from tessera.functions.hashing import sql_hash_u32
    return _ERR_SQL.format(h1=sql_hash_u32("42", "id"), h2=sql_hash_u32("42", "'col'", "id"))


@query("imputation_error", _err_sql())
def q_imputation_error(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"),
                                       F.floor("p_retailprice").cast("double").alias("y"))
    out = ST.imputation_error(p, "id", ["x", "y"])
    return out.select("method", "column", "n", r6("mae").alias("mae"), r6("rmse").alias("rmse"))


# Thresholds on planted signals: the learned heads must find what the table holds.

@query("class_model_check", "SELECT count(*) AS n, true AS good FROM part")
def q_class_model_check(spark, d):
    m = q_class_model(spark, d)
    df, _ = _model_frame(spark, d)
    names = F.element_at(F.array(*[F.lit(x) for x in ("large", "medium", "small")]), F.col("class_pred") + 1)
    right = F.avg((names == F.col("band")).cast("double"))
    return m.agg(F.count("*").alias("n"), (right > 0.9).alias("good"))


@query("class_model_hidden_check", "SELECT count(*) AS n, true AS good FROM part")
def q_class_model_hidden_check(spark, d):
    """K1 with a hidden layer learns bands that are not linear in the features."""
    from pyspark.ml.feature import StandardScaler, StringIndexer
    df, _ = _model_frame(spark, d)
    df = df.withColumn("band", F.when(F.abs(F.col("size") - 25) < 12, "inner").otherwise("outer"))
    df = StringIndexer(inputCol="band", outputCol="label_idx", stringOrderType="alphabetAsc").fit(df).transform(df)
    df = StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(df).transform(df)
    out = K.hidden_class_model(2, 2, (8,), "scaled", max_iter=200).fit(df).transform(df)
    return out.agg(F.count("*").alias("n"), (F.avg((F.col("class_pred") == F.col("label_idx")).cast("double")) > 0.9).alias("good"))


@query("price_model_check", "SELECT count(*) AS n, true AS finite, true AS fits FROM part")
def q_price_model_check(spark, d):
    """A price that is a line of the features plus nothing is predicted to a hundredth of its spread."""
    df, _ = _model_frame(spark, d)
    df = df.withColumn("price_z", 0.1 * F.col("size") - 0.05 * F.col("name_len"))
    out = K.price_model(reg=0.0).fit(df).transform(df)
    err = F.col("price_pred") - F.col("price_z")
    return out.agg(F.count("*").alias("n"), (~F.isnan(F.sum("price_pred"))).alias("finite"),
                   (F.sqrt(F.avg(err * err)) < 0.01 * F.stddev_pop("price_z")).alias("fits"))


@query("two_target_check", "SELECT count(*) AS n, true AS good FROM part")
def q_two_target_check(spark, d):
    out = q_two_target_model(spark, d).join(_model_frame(spark, d)[0].select("id", "band"), "id")
    names = F.element_at(F.array(*[F.lit(x) for x in ("large", "medium", "small")]), F.col("class_pred") + 1)
    return out.agg(F.count("*").alias("n"), (F.avg((names == F.col("band")).cast("double")) > 0.9).alias("good"))


@query("score_table_check", "SELECT true AS good, true AS positive")
def q_score_table_check(spark, d):
    out = q_score_table(spark, d).join(_model_frame(spark, d)[0].select("id", "band"), "id")
    return out.agg((F.avg((F.col("class_name") == F.col("band")).cast("double")) > 0.9).alias("good"),
                   (F.min("price") > 0).alias("positive"))


@query("study_bounds", """
SELECT true AS ordered, 6 AS n_methods, true AS full_is_best, count(*) AS n, true AS full_explains,
  round((var_pop(p_retailprice) + var_pop(p_size * 3.0)) / 2, 6) AS variance
FROM part WHERE p_size IS NOT NULL AND p_name IS NOT NULL AND p_retailprice IS NOT NULL
""")
def q_study_bounds(spark, d):
    """I7 on the study: the bounds are in order, every method predicts every row, no fill beats the full data,
    and the full data leave at most the targets' variance (of which the half that follows from ``x`` must go)."""
    study = cut_lineage(q_imputation_study(spark, d))
    b = ST.study_bounds(study)
    full = study.where("method = 'full'").select("mean_mse").scalar()
    p = table(spark, d, "part").where("p_size is not null and p_name is not null and p_retailprice is not null")
    variance = p.select(((F.var_pop("p_retailprice") + F.var_pop(F.col("p_size") * 3.0)) / 2).alias("v")).scalar()
    out = study.agg(F.count("*").cast("int").alias("n_methods"), F.min(F.col("mean_mse") >= full).alias("full_is_best"), F.min("n").alias("n"))
    return out.select(b.select(F.col("lower") <= F.col("upper")).scalar().alias("ordered"), "n_methods", "full_is_best", "n",
                      (full < variance * 1.05).alias("full_explains"), r6(variance).alias("variance"))


@query("forest_cv_check", """
SELECT kv.t AS target, count(*) AS n, true AS good, round(var_pop(kv.v), 6) AS variance
FROM lineitem, LATERAL (VALUES ('line', l_quantity * 2.0), ('step', CASE WHEN l_discount > 0.05 THEN 10.0 ELSE 0.0 END)) kv(t, v)
GROUP BY 1
""")
def q_forest_cv_check(spark, d):
    """K8 on all lines, two targets and three folds in shared passes: at most a fiftieth of a planted target's variance is left."""
    from tessera.operators.balance import kfold_ids
    from tessera.operators.forest import forest_mse
    li = table(spark, d, "lineitem").select(
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("id"), "l_quantity", "l_discount", "l_extendedprice",
        (F.col("l_quantity") * 2.0).alias("line"), F.when(F.col("l_discount") > 0.05, 10.0).otherwise(0.0).alias("step"))
    folds = kfold_ids(li, "id", 3)
    fits = folds.withColumn("fit", F.explode(F.array(*[F.lit(k) for k in range(3)]))).withColumn("test", F.col("fit") == F.col("fold"))
    mse = forest_mse(fits, "fit", "test", "id", ["l_quantity", "l_discount", "l_extendedprice"], ["line", "step"], num_trees=10)
    out = mse.groupBy("target").agg(F.sum("n").alias("n"), (F.sum(F.col("mse") * F.col("n")) / F.sum("n")).alias("mse"))
    variance = F.when(F.col("target") == "line", li.select(F.var_pop("line").alias("v")).scalar()).otherwise(
        li.select(F.var_pop("step").alias("v")).scalar())
    return out.select("target", "n", (F.col("mse") < variance / 50).alias("good"), r6(variance).alias("variance"))


@query("imputation_study")
def q_imputation_study(spark, d):
    """Forest MSE per fill method under 5-fold CV (learned: rows-only)."""
    e = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"),
                                       F.length("p_name").cast("double").alias("z"),
                                       F.col("p_retailprice").alias("t1"), (F.col("p_size") * 3.0).alias("t2"))
    study = ST.imputation_study(e, "id", ["x", "z"], ["t1", "t2"], num_trees=10)
    return study


@query("two_target_model")
def q_two_target_model(spark, d):
    """K3/K5: both heads tuned on a validation split; in-sample predictions."""
    from pyspark.ml import PipelineModel
    df, _ = _model_frame(spark, d)
    model = K.two_target_model(df, "band", "price_z")
    heads = PipelineModel(stages=model.stages[1:])
    return heads.transform(df).select("id", F.col("class_pred").cast("int").alias("class_pred"), "price_pred")
