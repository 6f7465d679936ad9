"""K6 on arriving rows: score a file stream with a fitted two-target model.

The model (label indexer + class head + price head) and the price scaling
are fitted on a table at rest; each micro-batch is scored with the same
per-row projection as the batch ``score_table``, so the stream needs no
state and no shuffle.  The scaling parameters are two numbers inlined as
literals.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax


def score_rows(model: PipelineModel, df: DataFrame, id_col: str, feature_cols, price_mean: float,
               price_scale: float) -> DataFrame:
    """``(id, class_name, price, class_idx)`` for batch or streaming rows."""
    indexer = model.stages[0]
    heads = PipelineModel(stages=model.stages[1:])
    x = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="keep").transform(
        df.select(id_col, *[F.col(c).cast("double") for c in feature_cols]))
    scored = IndexToString(inputCol="class_pred", outputCol="class_name", labels=indexer.labels).transform(
        heads.transform(x))
    price = F.bround(F.col("price_pred") * F.lit(price_scale) + F.lit(price_mean), 2)
    return scored.select(id_col, "class_name", price.alias("price"),
                         argmax(vector_to_array("prob")).alias("class_idx"))


def score_file_stream(spark, src_dir: str, schema: str, model: PipelineModel, id_col: str, feature_cols,
                      price_mean: float, price_scale: float, out_dir: str, checkpoint: str,
                      fmt: str = "parquet"):
    """Start a file-to-file scoring stream (``checkpoint`` in shared storage)."""
    src = spark.readStream.schema(schema).format(fmt).load(src_dir)
    out = score_rows(model, src, id_col, feature_cols, price_mean, price_scale)
    return (out.writeStream.format(fmt).option("path", out_dir)
            .option("checkpointLocation", checkpoint).outputMode("append").start())
