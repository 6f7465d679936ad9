"""File sources and sinks (A1-A9).  Everything is a distributed read or
write; nothing goes through the driver (the reference's toPandas().to_csv
becomes a partitioned CSV/Parquet write)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tessera.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None,
             header: bool = True) -> DataFrame:
    """A1/A2: CSV scan.  Give a DDL schema in production; without one the
    types are inferred (an extra pass over the file)."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def _csv_safe(df: DataFrame) -> DataFrame:
    """The CSV writer rejects arrays/maps/structs: write them as JSON text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Distributed CSV write with a header (one file per task)."""
    w = _csv_safe(df).write.mode(mode).option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_matrix(df: DataFrame, id_col: str, vec_col: str, path: str, names: Sequence[str] | None = None,
                 fmt: str = "parquet") -> None:
    """A5: a vector / array column as one numeric column per feature, keyed by id.

    The feature names go to ``path/_names`` as a ``(position, name)`` table,
    so column meaning never depends on row or file order.
    """
    arr = F.col(vec_col)
    if df.schema[vec_col].dataType.typeName() != "array":
        arr = vector_to_array(arr)
    n = df.select(F.max(F.size(arr))).first()[0] or 0
    names = list(names) if names else [f"f{i}" for i in range(n)]
    flat = df.select(id_col, *[F.get(arr, i).cast("double").alias(names[i]) for i in range(n)])
    spark = df.sparkSession
    if fmt == "csv":
        write_csv(flat, f"{path}/data")
    else:
        flat.write.mode("overwrite").parquet(f"{path}/data")
    spark.createDataFrame(list(enumerate(names)), "position int, name string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/_names")


def read_matrix(spark: SparkSession, path: str, id_col: str, out: str = "features",
                as_vector: bool = False, fmt: str = "parquet") -> DataFrame:
    """A3: typed scan of a matrix written by ``write_matrix`` into ``(id, array)``."""
    names = [r[0] for r in spark.read.parquet(f"{path}/_names").orderBy("position").select("name").collect()]
    if fmt == "csv":
        ddl = ", ".join([f"`{id_col}` bigint"] + [f"`{n}` double" for n in names])
        data = read_csv(spark, f"{path}/data", ddl)
    else:
        data = spark.read.parquet(f"{path}/data")
    arr = F.array(*[F.col(n).cast("double") for n in names])
    res = data.select(id_col, arr.alias(out))
    return res.withColumn(out, array_to_vector(out)) if as_vector else res


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The 3-column prediction file ``(id, class, price)``."""
    return read_csv(spark, path, "id bigint, class_name string, price double")


def save_model(model, path: str) -> None:
    """Persist a fitted StringIndexerModel / PipelineModel (Spark ML format)."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    if not _exists(path):
        raise FileNotFoundError(f"no saved model at {path}")
    return PipelineModel.load(path)


def load_label_encoder(path: str) -> StringIndexerModel:
    if not _exists(path):
        raise FileNotFoundError(f"no saved encoder at {path}")
    return StringIndexerModel.load(path)


def _exists(path: str) -> bool:
    if "://" in path and not path.startswith("file:"):
        return True  # remote stores: let the loader raise its own error
    return os.path.exists(path.replace("file:", ""))
