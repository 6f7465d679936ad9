"""Sources and sinks: CSV with arrays, matrices with names, persisted encoders and models."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tessera.sources import files as io


def test_csv_roundtrip_with_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"], 2.5), (2, None, None)], "id int, tags array<string>, x double")
    path = io.scratch_path(spark, "t-csv")
    io.write_csv(df, path)
    back = io.read_csv(spark, path, "id int, tags string, x double")
    got = {r["id"]: (r["tags"], r["x"]) for r in back.collect()}
    assert got == {1: ('["a","b"]', 2.5), 2: (None, None)}


def test_matrix_roundtrip_keeps_names(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "id long, v array<double>")
    path = io.scratch_path(spark, "t-mat")
    io.write_matrix(df, "id", "v", path, names=["alpha", "beta"])
    back = io.read_matrix(spark, path, "id")
    assert sorted((r["id"], r["features"]) for r in back.collect()) == [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    assert [r["name"] for r in spark.read.parquet(f"{path}/_names").orderBy("position").collect()] == ["alpha", "beta"]


def test_encoder_and_model_persistence(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 2.0, 4.1), ("a", 3.0, 6.2)], "c string, x double, y double")
    enc = StringIndexer(inputCol="c", outputCol="ci", stringOrderType="alphabetAsc").fit(df)
    p = io.scratch_path(spark, "t-enc")
    io.save_model(enc, p)
    assert io.load_label_encoder(p).labels == ["a", "b"]
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"),
                             LinearRegression(featuresCol="f", labelCol="y")]).fit(df)
    p2 = io.scratch_path(spark, "t-model")
    io.save_model(model, p2)
    again = io.load_pipeline(p2).transform(df).select(F.round("prediction", 6)).collect()
    assert again == model.transform(df).select(F.round("prediction", 6)).collect()
    with pytest.raises(FileNotFoundError):
        io.load_pipeline(p2 + "-missing")


def test_remove_folder(spark):
    import uuid

    from tessera.session import checkpoint_dir, remove_folder

    path = f"{checkpoint_dir(spark)}/gone-{uuid.uuid4().hex}"
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    remove_folder(spark, path)
    remove_folder(spark, path)  # nothing there: nothing to do
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
