"""Label repair on a stream of new rows (Structured Streaming).

The batch operators fit their lookup tables on a table at rest; new rows
arriving later (files landing in a folder, a message bus) are repaired by
the *fitted* state without re-reading history.  The fitted state is tiny
(one row per class plus two defaults) and is checked against a size bound
before it is inlined into the stream's expressions, so each micro-batch is
a pure projection: no shuffle, no state store, no watermark needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.quantiles import global_median, global_mode
from tessera.operators.impute import price_lookup

MAX_CLASSES = 100_000


@dataclass(frozen=True)
class LabelRepairState:
    medians: tuple[tuple[str, float], ...]   # (class, median price), sorted by class
    default_class: str | None
    default_price: float | None
    tol: float = 0.04


def fit_label_repair(df: DataFrame, class_col: str, price_col: str, tol: float = 0.04) -> LabelRepairState:
    """Fit on a table at rest; refuses more than ``MAX_CLASSES`` classes."""
    lk = price_lookup(df, class_col, price_col, "m")
    n = lk.limit(MAX_CLASSES + 1).count()
    if n > MAX_CLASSES:
        raise ValueError(f"{n}+ classes: too many to inline; use the batch join instead")
    meds = tuple(sorted((r[0], float(r[1])) for r in lk.collect() if r[1] is not None))
    spark = df.sparkSession
    row = spark.range(1).select(global_mode(df, class_col).alias("c"),
                                global_median(df, price_col).alias("p")).first()
    return LabelRepairState(meds, row["c"], row["p"], tol)


def apply_label_repair(df: DataFrame, state: LabelRepairState, class_col: str, price_col: str) -> DataFrame:
    """Same answer as ``impute.repair_labels`` with the fitted state; works on
    batch and streaming DataFrames alike (a projection per row)."""
    c, p = F.col(class_col), F.col(price_col).cast("double")
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m).alias("m")) for k, m in state.medians]) \
        if state.medians else F.array().cast("array<struct<k:string,m:double>>")
    hits = F.filter(table, lambda s: F.abs(p - s["m"]) / p <= F.lit(state.tol))
    first = F.when((p.isNotNull()) & (p != 0), F.array_min(F.transform(hits, lambda s: s["k"])))
    med_map = F.map_from_entries(table)
    fill_class = F.coalesce(c, first, F.lit(state.default_class))
    fill_price = F.when(p.isNotNull(), p).when(c.isNull(), F.lit(state.default_price)) \
        .otherwise(F.coalesce(F.try_element_at(med_map, c), F.lit(state.default_price)))
    return df.withColumns({class_col: fill_class, price_col: fill_price})


def repair_file_stream(spark, src_dir: str, schema: str, class_col: str, price_col: str,
                       state: LabelRepairState, out_dir: str, checkpoint: str, fmt: str = "parquet"):
    """Start a file-to-file repair stream; the caller owns the returned query.

    ``checkpoint`` must sit in shared storage (it carries the stream's
    progress across driver and executor restarts).
    """
    src = spark.readStream.schema(schema).format(fmt).load(src_dir)
    out = apply_label_repair(src, state, class_col, price_col)
    return (out.writeStream.format(fmt).option("path", out_dir)
            .option("checkpointLocation", checkpoint).outputMode("append").start())
