"""Fitted transforms give the same on unseen rows after they are saved and loaded."""

import uuid

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera.functions.arrays import vector_first_one, vector_get, vector_size
from tessera.operators.encode import feature_matrix
from tessera.operators.transforms import FeatureMatrix, FeatureMatrixModel, LabelCodes, LabelCodesModel
from tessera.session import checkpoint_dir
from tessera.sources.files import load_pipeline, save_model

TRAIN = [(1, "b", "u", 3, 1.0, 9.0), (2, "a", None, 5, 3.0, 8.0), (3, None, "v", 3, None, 7.0)]
UNSEEN = [(4, "c", "w", 4, 2.0, None), (5, "a", "u", 5, 3.0, 6.0), (6, None, None, None, None, 1.0)]
SCHEMA = "id int, `a level` string, d string, o int, s double, p double"


@pytest.fixture()
def frames(spark):
    return spark.createDataFrame(TRAIN, SCHEMA), spark.createDataFrame(UNSEEN, SCHEMA)


@pytest.fixture()
def folder(spark):
    return f"{checkpoint_dir(spark)}/saved-{uuid.uuid4().hex}"


def _matrix():
    return FeatureMatrix(oneHotCols=["a level"], dummyCols=["d"], ordinalCols=["o"], scaledCols=["s"], passthrough=["p"], outputCol="v")


def _vectors(df):
    return {r["id"]: [None if x != x else x for x in r["v"]] for r in df.select("id", vector_to_array("v").alias("v")).collect()}


def test_reloaded_matrix_equals_the_fitted_one(frames, folder):
    train, unseen = frames
    model = _matrix().fit(train)
    model.write().save(folder)
    again = FeatureMatrixModel.load(folder)
    want = {4: [0, 0, 0, 0, None, 0, None], 5: [1, 0, 0, 0, 1, 1, 6], 6: [0, 0, 1, 0, None, None, 1]}
    assert _vectors(model.transform(unseen)) == want
    assert _vectors(again.transform(unseen)) == want
    names = [(r["position"], r["group"], r["name"]) for r in again.names().orderBy("position").collect()]
    assert names == [(0, "onehot", "a level_a"), (1, "onehot", "a level_b"), (2, "onehot", "a level___null__"), (3, "dummies", "d_v"),
                     (4, "ordinal", "o_ord"), (5, "scaled", "s_z"), (6, "passthrough", "p")]
    assert again.uid == model.uid and again.transform(unseen).columns == [*unseen.columns, "v"]


def test_inside_a_pipeline(frames, folder):
    train, unseen = frames
    stages = [LabelCodes(inputCol="d", outputCol="code"), _matrix()]
    fitted = Pipeline(stages=stages).fit(train)
    save_model(fitted, folder)
    loaded = load_pipeline(folder)
    a, b = fitted.transform(unseen), loaded.transform(unseen)
    assert _vectors(a) == _vectors(b)
    assert {r["id"]: r["code"] for r in b.collect()} == {4: None, 5: 0, 6: None}
    save_model(loaded, f"{folder}-again")  # what was loaded can be saved elsewhere
    assert _vectors(load_pipeline(f"{folder}-again").transform(unseen)) == _vectors(a)


def test_an_unfitted_pipeline_is_saved_too(frames, folder):
    train, unseen = frames
    Pipeline(stages=[_matrix()]).write().save(folder)
    assert _vectors(Pipeline.load(folder).fit(train).transform(unseen)) == _vectors(_matrix().fit(train).transform(unseen))


def test_codes_decode(spark, folder):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    LabelCodes(inputCol="c", outputCol="i").fit(df).write().save(folder)
    model = LabelCodesModel.load(folder)
    out = model.decode(model.transform(df), "i", "back")
    assert sorted((r["c"] or "", r["i"], r["back"]) for r in out.where("c is not null").collect()) == [("a", 0, "a"), ("b", 1, "b"), ("b", 1, "b")]
    assert model.transform(df).where("c is null and i is null").count() == 1
    assert model.transform(spark.createDataFrame([("z",)], "c string")).first()["i"] is None


def test_no_rows(spark, frames, folder):
    train, _ = frames
    none = train.where(F.lit(False))
    model = _matrix().fit(none)
    model.write().save(folder)
    out = _vectors(FeatureMatrixModel.load(folder).transform(train))
    assert {k: len(v) for k, v in out.items()} == {1: 3, 2: 3, 3: 3}
    m, names = feature_matrix(none, "id", one_hot_cols=["a level"], passthrough=["p"])
    assert m.count() == 0 and names.count() == 1


def test_many_levels_stay_sparse(spark):
    """Neither the schema nor a read of single places grows with the number of levels (before: a name per place, dense rows)."""
    df = spark.range(3000).select("id", F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("c"), (F.col("id") % 3).alias("p"))
    m, _ = feature_matrix(df, "id", one_hot_cols=["c"], passthrough=["p"])
    assert m.schema["features"].metadata == {"ml_attr": {"num_attrs": 3001}}
    size = vector_size("features")
    out = m.select("id", size.alias("n"), vector_first_one("features", size - 1).alias("one"), vector_get("features", size - 1).alias("p"))
    assert out.where("n = 3001 and one = id and p = id % 3").count() == 3000


def test_places_of_vectors(spark):
    far = SparseVector(2_000_000_000, [7, 1_999_999_999], [1.0, 4.0])
    df = spark.createDataFrame([(0, far), (1, DenseVector([0.0, 1.0, 1.0])), (2, SparseVector(9, [], []))], StructType([StructField("id", IntegerType()), StructField("v", VectorUDT())]))
    size = vector_size("v")
    got = {r["id"]: tuple(r)[1:] for r in df.select("id", size.alias("n"), vector_first_one("v", size - 1).alias("one"), vector_get("v", size - 1).alias("x")).collect()}
    assert got == {0: (2_000_000_000, 7, 4.0), 1: (3, 1, 1.0), 2: (9, -1, 0.0)}
