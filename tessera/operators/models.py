"""Two-target modelling on tables (K1-K9, I6-I7), built on Spark ML.

The reference trains one network with a softmax class head and a linear
Huber price head.  Here the two heads are independent Spark ML estimators
in one ``Pipeline`` (they share no layers in the reference either), tuned
on a validation split; scoring returns ``(id, class_name, price)`` in
original units.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax


def class_model(features: str = "features", label: str = "label_idx", reg: float = 0.001,
                max_iter: int = 100) -> LogisticRegression:
    """K1: multinomial softmax regression (probabilities in ``prob``)."""
    return LogisticRegression(featuresCol=features, labelCol=label, family="multinomial", regParam=reg,
                              elasticNetParam=0.0, maxIter=max_iter, probabilityCol="prob",
                              predictionCol="class_pred", rawPredictionCol="class_raw")


def hidden_class_model(n_features: int, n_classes: int, hidden: Sequence[int] = (32,), features: str = "features",
                       label: str = "label_idx", max_iter: int = 100, seed: int = 42) -> MultilayerPerceptronClassifier:
    """K1 with hidden layers: a feed-forward network with a softmax output (same output columns as ``class_model``)."""
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=[n_features, *hidden, n_classes],
                                          maxIter=max_iter, seed=seed, probabilityCol="prob",
                                          predictionCol="class_pred", rawPredictionCol="class_raw")


def price_model(features: str = "features", label: str = "price_z", reg: float = 0.001,
                epsilon: float = 1.35, max_iter: int = 100) -> LinearRegression:
    """K2: linear price head with Huber loss (Spark estimates the scale; epsilon > 1)."""
    return LinearRegression(featuresCol=features, labelCol=label, loss="huber", epsilon=epsilon,
                            regParam=reg, elasticNetParam=0.0, maxIter=max_iter, predictionCol="price_pred")


def two_target_model(train: DataFrame, class_col: str, price_z_col: str, features: str = "features",
                     regs: Sequence[float] = (0.001, 0.01), seed: int = 42) -> PipelineModel:
    """K3/K5: label indexer + class head + price head, each tuned over ``regs``
    on an 80/20 split (the best validation loss wins, as early stopping did).

    Each head learns from the rows that have its own target: rows without a
    class still teach the price head, and the other way round."""
    indexer = StringIndexer(inputCol=class_col, outputCol="label_idx", stringOrderType="alphabetAsc",
                            handleInvalid="skip")
    clf = class_model(features)
    reg = price_model(features, price_z_col)
    clf_tuned = TrainValidationSplit(
        estimator=clf, estimatorParamMaps=ParamGridBuilder().addGrid(clf.regParam, list(regs)).build(),
        evaluator=_LogLossEvaluator(), trainRatio=0.8, seed=seed, parallelism=len(regs))
    reg_tuned = TrainValidationSplit(
        estimator=reg, estimatorParamMaps=ParamGridBuilder().addGrid(reg.regParam, list(regs)).build(),
        evaluator=RegressionEvaluator(labelCol=price_z_col, predictionCol="price_pred", metricName="mse"),
        trainRatio=0.8, seed=seed, parallelism=len(regs))
    classed = train.where(F.col(class_col).isNotNull())
    indexed = indexer.fit(classed)
    heads = [clf_tuned.fit(indexed.transform(classed)),
             reg_tuned.fit(train.where(F.col(price_z_col).isNotNull() & ~F.isnan(price_z_col)))]
    return PipelineModel(stages=[indexed, *heads])


def _LogLossEvaluator():
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    return MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="class_pred",
                                             probabilityCol="prob", metricName="logLoss")


def eval_losses(df: DataFrame, prob_col: str, label_col: str, pred_col: str, target_col: str,
                delta: float = 1.0) -> DataFrame:
    """K4: mean cross-entropy, mean Huber loss (delta 1) and their sum, over rows."""
    p = F.get(F.col(prob_col), F.col(label_col).cast("int"))
    e = F.col(pred_col) - F.col(target_col)
    hub = F.when(F.abs(e) <= delta, 0.5 * e * e).otherwise(delta * (F.abs(e) - 0.5 * delta))
    out = df.agg(F.avg(-F.log(p)).alias("ce"), F.avg(hub).alias("huber"))
    return out.withColumn("total", F.col("ce") + F.col("huber"))


def score_table(model: PipelineModel, df: DataFrame, id_col: str, price_mean, price_scale,
                features: str = "features") -> DataFrame:
    """K6: ``(id, class_name, price)``: argmax class decoded to its name, price
    back in original units, rounded half-even to cents."""
    indexer = model.stages[0]
    heads = PipelineModel(stages=model.stages[1:])  # the label indexer is only needed to fit
    scored = heads.transform(df.select(id_col, features))
    decode = IndexToString(inputCol="class_pred", outputCol="class_name", labels=indexer.labels)
    scored = decode.transform(scored)
    price = F.bround(F.col("price_pred") * price_scale + price_mean, 2)
    return scored.select(id_col, "class_name", price.alias("price"),
                         argmax(vector_to_array("prob")).alias("class_idx"))


def compare_predictions(a: DataFrame, b: DataFrame, id_col: str, class_col: str = "class_name",
                        price_col: str = "price") -> DataFrame:
    """K7: crosstab of two prediction tables on the same ids, with the mean
    absolute price gap per cell: ``(class_a, class_b, n, mean_abs_gap)``."""
    j = a.select(id_col, F.col(class_col).alias("class_a"), F.col(price_col).alias("pa")).join(
        b.select(id_col, F.col(class_col).alias("class_b"), F.col(price_col).alias("pb")), id_col)
    return j.groupBy("class_a", "class_b").agg(F.count(F.lit(1)).alias("n"),
                                                F.avg(F.abs(F.col("pa") - F.col("pb"))).alias("mean_abs_gap"))


def linear_fit(df: DataFrame, x: str, targets: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """K9: least squares of each target on one predictor from grouped moments,
    with the in-sample root mean squared error: ``(group..., target, slope, intercept, rmse)``.

    One scan: the squared error is ``Syy - Sxy^2 / Sxx`` of the centred moments
    over the rows where both values are present (NULL and NaN are not).
    """
    g = list(group_cols)

    def value(c):
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    fits = df.groupBy(*g).agg(*[F.struct(
        F.regr_slope(value(t), value(x)).alias("slope"), F.regr_intercept(value(t), value(x)).alias("intercept"),
        F.regr_syy(value(t), value(x)).alias("syy"), F.regr_sxy(value(t), value(x)).alias("sxy"),
        F.regr_sxx(value(t), value(x)).alias("sxx"), F.regr_count(value(t), value(x)).alias("n")).alias(f"__fit{i}")
        for i, t in enumerate(targets)])
    long = fits.select(*g, F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(f"__fit{i}").alias("f")) for i, t in enumerate(targets)])).alias("r"))
    f = F.col("r.f")
    sse = F.greatest(f["syy"] - f["sxy"] * f["sxy"] / f["sxx"], F.lit(0.0))
    return long.select(*g, "r.target", f["slope"].alias("slope"), f["intercept"].alias("intercept"),
                       F.when(f["slope"].isNotNull(), F.sqrt(sse / f["n"])).alias("rmse"))


def forest_cv_mse(df: DataFrame, features: str, targets: Sequence[str], fold_col: str, n_folds: int,
                  num_trees: int = 20, max_depth: int = 5, seed: int = 42, parallelism: int = 8,
                  folds: Sequence[int] | None = None) -> list[float]:
    """K8 inside I6: k-fold MSE of a random forest, averaged over the targets
    (of the ``folds`` asked for, or of all).

    The ``folds x targets`` fits are independent Spark jobs; like
    ``CrossValidator(parallelism=...)`` they are submitted from a small
    thread pool so the cluster runs several at once.
    """
    from concurrent.futures import ThreadPoolExecutor

    df = df.persist()

    def one(job):
        k, t = job
        tr, te = df.where(F.col(fold_col) != k), df.where(F.col(fold_col) == k)
        rf = RandomForestRegressor(featuresCol=features, labelCol=t, numTrees=num_trees,
                                   maxDepth=max_depth, seed=seed)
        pred = rf.fit(tr).transform(te)
        return k, RegressionEvaluator(labelCol=t, metricName="mse").evaluate(pred)

    folds = list(range(n_folds)) if folds is None else list(folds)
    jobs = [(k, t) for k in folds for t in targets]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(one, jobs))
    df.unpersist()
    return [sum(m for kk, m in results if kk == k) / len(targets) for k in folds]
