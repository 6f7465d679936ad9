"""Corpus pipeline over ``documents``: each stage works on what its predecessor kept.

1. toxicity: rows scored 0.5 or more go;
2. quality: rows scored under 0.7 go;
3. near duplicates: of every component of documents linked by shingle sets the
   smallest id stays (of repeated rows with that id, one);
4. secrets: every span found is replaced in the text;
5. packing: the remaining texts become token sequences.

All stages but the last return the columns of ``documents``.  Null and empty
texts are scored, kept or rejected like any other text; empty tables give empty
results.  Classifiers are fitted on the labelled rows of ``documents`` in
``sf_dir`` by the same rules as queries op1 and op5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.jaccard_join import one_per_component
from tessera.llm.labelled import score_texts
from tessera.llm.packing import pack_documents
from tessera.llm.quality import fit_quality
from tessera.llm.queries import held_out
from tessera.llm.secrets import fit_secrets, scan_secrets
from tessera.llm.token_counts import tokenizer_path
from tessera.llm.toxicity import fit_toxicity
from tessera.session import checkpoint_dir, forget_finished
from tessera.sources.tables import table

SCORE = "pipeline score"
#: Rows a batch between Spark and Python: the first stages hand whole texts back and forth.
BATCH_ROWS = 1000
#: The same where every text is worked on alone: a task's words and features take memory by the batch.
TEXT_ROWS = 250


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = fit_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    small_batches(spark, TEXT_ROWS)
    return score_texts(docs, model, docs.columns, out=SCORE).where(F.col(SCORE) < 0.5).drop(SCORE)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out(4, 2)))
    small_batches(spark, TEXT_ROWS)
    return score_texts(docs, model, docs.columns, out=SCORE).where(F.col(SCORE) >= 0.7).drop(SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return one_per_component(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = fit_secrets(docs)
    small_batches(spark, TEXT_ROWS)
    found = scan_secrets(docs, model, docs.columns, mark="[SECRET]")
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark, TEXT_ROWS)
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", remove_secrets),
    ("packing", pack),
]

#: The classifiers, the tagger and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet to the shared folder and read again."""
    import uuid

    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        forget_finished(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
