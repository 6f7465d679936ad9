"""Line deduplication by levelled sorted runs of line hashes (operator 13, DataFrame functions only).

``LineRuns`` is the index: tables of (hash of a line's key, number of documents
that hold it, largest id among them), each bucketed and sorted by the hash.
Batches come in falling order of the ids.  A new batch is counted by key,
merge-anti-joined with the runs' keys that are decided already (held by enough
documents, the largest id among them, since ids fall), and what is left becomes
a run of level 0.  ``fan_out`` runs of a level are compacted into one of the next.
Buckets are the same in all runs, so a merge join of two runs, or of a batch with
them, moves no row of a run.

``dedup_lines`` cuts the documents into batches by ranges of the id, feeds the index and
then drops lines: only hashes, ids and positions are grouped; texts are moved once,
to meet the positions that go.

Defined results: a null text is an empty one, and an empty text is one empty line.
Every row is a document: rows with the same id count as so many documents, and
all of them keep the lines if the id is the largest.  A null id is below all
others; rows without an id count like the rest.  Texts and lines of any length are
handled whole.  Other columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, cut_lineage, remove_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"
KEYS_PER_BUCKET = 2_000_000
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    bare = F.trim(line, F.lit(SPACE))
    # of an ASCII text ``lower`` changes the same letters, and faster
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _once(value: Column, then) -> Column:
    """``then`` of an array that is computed once, however often ``then`` looks at it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def line_entries(lines: Column, min_chars: int) -> Column:
    """Per line whose key has ``min_chars`` code points or more: ``h1``, ``h2``, ``pos`` and whether it is the first with that key."""

    def entry(line, pos):
        key = line_key(line)
        return F.when(F.char_length(key) >= min_chars,
                      F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(13), key).alias("h2"), pos.alias("pos")))

    found = F.array_sort(F.filter(F.transform(lines, entry), lambda e: e.isNotNull()))
    return _once(found, lambda a: F.transform(a, lambda e, i: F.struct(
        e.h1.alias("h1"), e.h2.alias("h2"), e.pos.alias("pos"),
        ((i == 0) | (F.get(a, i - 1).h1 != e.h1) | (F.get(a, i - 1).h2 != e.h2)).alias("first"))))


class LineRuns:
    """Levels of sorted runs (``h1``, ``h2``, ``n``, ``last``) in a shared folder."""

    def __init__(self, spark: SparkSession, buckets: int, enough: int, fan_out: int = 2):
        self.spark, self.buckets, self.enough, self.fan_out = spark, buckets, enough, fan_out
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/{self.name}"
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, rows: DataFrame) -> str:
        self.written += 1
        table = f"{self.name}_{self.written}"
        (rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet")
         .option("path", f"{self.folder}/{self.written}").saveAsTable(table))
        return table

    def _merge(self, runs: list[str]) -> DataFrame:
        """One row per key of several runs, merged two by two.

        Not a union: Spark 4.1 takes a union of bucketed tables to be bucketed, and then
        adds up only the rows of a key that happen to meet.
        """
        rows = self.spark.table(runs[0])
        for r in runs[1:]:
            more = self.spark.table(r).withColumnsRenamed({"n": "more", "last": "other"})
            rows = rows.join(more.hint("merge"), HASH, "full_outer").select(
                *HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"), F.greatest("last", "other").alias("last"))
        return rows

    def add(self, batch: DataFrame) -> None:
        """Counts a batch (``h1``, ``h2``, ``id`` per document and key), whose ids aren't above those of earlier ones."""
        own = batch.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).repartition(self.buckets, *HASH)
        for runs in self.levels:
            for r in runs:
                decided = self.spark.table(r).where(F.col("n") >= self.enough).select(*HASH)
                own = own.join(decided.hint("merge"), HASH, "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(own))
        level = 0
        while len(self.levels[level]) >= self.fan_out:
            if level + 1 == len(self.levels):
                self.levels.append([])
            full, self.levels[level] = self.levels[level], []
            self.levels[level + 1].append(self._write(self._merge(full).repartition(self.buckets, *HASH)))
            for r in full:
                self.spark.sql(f"DROP TABLE {r}")
            level += 1

    def repeated(self) -> DataFrame:
        """Keys that enough documents hold, with the largest id."""
        runs = [r for level in self.levels for r in level]
        return self._merge(runs).where(F.col("n") >= self.enough).select(*HASH, "last")

    def close(self) -> None:
        for level in self.levels:
            for r in level:
                self.spark.sql(f"DROP TABLE {r}")
        remove_folder(self.spark, self.folder)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
                batches: int = 4, fan_out: int = 2, keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """One row per input row: ``id_col``, ``n_lines``, ``n_dropped`` and ``text``, the lines that stay joined by a line feed.

    A line goes if at least ``min_docs`` documents hold its key of at least
    ``min_chars`` code points, unless its document has the largest id of them.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # rows with the same id and text have the same lines; the pair of hashes stands for such a row
    docs = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).select(
        "id", F.xxhash64("id", "text").alias("r1"), F.xxhash64(F.lit(13), "id", "text").alias("r2"), F.split("text", "\n", -1).alias("lines"))
    held = docs.select("id", "r1", "r2", F.inline(line_entries(F.col("lines"), min_chars)))

    shares = [i / batches for i in range(1, batches)]
    cuts = df.select(F.percentile_approx(F.col(f"`{id_col}`"), shares or [0.5], 10_000).alias("q")).first()["q"] or []
    batch = F.lit(0)  # the highest ids first, rows without an id last
    for q in cuts if shares else []:
        batch = batch + (F.coalesce(F.col("id") <= q, F.lit(True))).cast("int")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    held.withColumn("batch", batch).write.partitionBy("batch").parquet(folder)
    held = spark.read.schema(f"{_ddl(held)}, batch int").parquet(folder)

    runs = LineRuns(spark, max(8, -(-held.count() // keys_per_bucket)), min_docs, fan_out)
    for i in range(batches):
        runs.add(held.where((F.col("batch") == i) & F.col("first")).select(*HASH, "id"))
    repeated = cut_lineage(runs.repeated())
    runs.close()

    goes = held.join(repeated, HASH).where(~F.col("id").eqNullSafe(F.col("last")))
    goes = cut_lineage(goes.groupBy("r1", "r2").agg(F.collect_set("pos").alias("goes")))
    remove_folder(spark, folder)
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = _once(F.col("lines"), lambda a: F.transform(F.array_except(places, F.col("goes")), lambda i: F.get(a, i)))
    out = docs.join(goes, ["r1", "r2"], "left").select(
        F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("goes").isNull(), F.col("lines")).otherwise(stay).alias("stay"))
    return out.select(id_col, "n_lines", (F.col("n_lines") - F.size("stay")).alias("n_dropped"), F.array_join("stay", "\n").alias("text"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
