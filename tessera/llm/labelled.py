"""Bounded samples of labelled rows for fitting classifiers, and scoring of whole texts by a fitted one."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.text_blocks import text_blocks


def fold(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % n


def class_sample(labels: DataFrame, label_col: str, max_per_class: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``max_per_class`` labelled ids of each class, by the order of a hash of the id.

    Returns ``id``, ``y`` (0.0 or 1.0) and ``w``, the number of labelled ids that
    the row stands for, so weighted rates are those of all labelled rows.  Null
    ids and labels are left out; of several labels of an id the largest counts.
    """
    one = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("l"))
           .select("id", F.when(F.col("l") > 0, 1.0).otherwise(0.0).alias("y")))
    sizes = {r.y: r.n for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y, n in sorted(sizes.items()):
        part = (one.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_per_class)
                .withColumn("w", F.lit(n / min(n, max_per_class))))
        picked = part if picked is None else picked.union(part)
    return one.withColumn("w", F.lit(1.0)).limit(0) if picked is None else picked


def free_name(name: str, columns: list[str]) -> str:
    """``name``, longer if a column of the input is called so (whatever its case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def score_texts(df: DataFrame, model, keep: list[str], text_col: str = "text", out: str = "score") -> DataFrame:
    """The columns ``keep`` of every input row and ``out``, the model's score of its whole text.

    ``model.score`` maps an Arrow array of texts to numbers.  A null text scores
    as an empty one (and stays null if it is kept); a column that is already
    called ``out`` is replaced; an empty table gives no rows.
    """
    keep = [c for c in keep if c != out]
    scored = free_name("text to score", df.columns)
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(scored))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(out, T.DoubleType())])

    def run(batches):
        for block in text_blocks(batches, scored):
            scores = pa.array(model.score(block.column(len(keep))), pa.float64())
            yield pa.RecordBatch.from_arrays([*block.columns[:-1], scores], names=[*keep, out])

    return rows.mapInArrow(run, schema)
