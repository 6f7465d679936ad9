"""Label, one-hot, dummy and ordinal encoding; feature matrix (H1-H7).

Fitted encoders are ``(value, idx)`` DataFrames computed with a distributed
prefix count over the distinct values (no single-task ``dense_rank`` over the
whole column), applied with a join that AQE broadcasts when the table is
small.  The feature matrix keeps one-hot blocks as sparse vectors by position
(neither driver nor schema lists the places), so any number of levels, and levels with any spelling, fit; the levels' names
are rows of a table.  Only the wide form (one column per level) collects
its levels, which become column names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.functions.quantiles import rows_before
from tessera.session import cut_lineage

NULL_LEVEL = "__null__"


def fit_codes(df: DataFrame, col: str, descending: bool = False) -> DataFrame:
    """H1/H5 fit: ``(value, idx)``, idx = 0..k-1 in sorted order (numeric
    columns sort numerically, strings by text).  NULL is not a level."""
    d = df.where(F.col(col).isNotNull()).select(col).distinct().withColumn("__n", F.lit(1))
    key = col
    if descending:
        if not isinstance(df.schema[col].dataType, NumericType):
            raise ValueError("descending codes need a numeric column; use alphabetDesc via StringIndexer")
        d = d.withColumn("__neg", -F.col(col))
        key = "__neg"
    ranked = rows_before(d, [], key, "__n", out="idx")
    return ranked.select(F.col(col).alias("value"), F.col("idx").cast("int"))


def label_encode(df: DataFrame, col: str, codes: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """H1/H5 apply: value -> idx; unknown or NULL -> NULL."""
    codes = codes if codes is not None else fit_codes(df, col)
    out = out or f"{col}_code"
    c = codes.select(F.col("value").alias("__v"), F.col("idx").alias(out))
    return df.join(c, df[col] == c["__v"], "left").drop("__v")


ordinal_encode = label_encode


def label_decode(df: DataFrame, code_col: str, codes: DataFrame, out: str) -> DataFrame:
    """H2: idx -> value."""
    c = codes.select(F.col("idx").alias("__i"), F.col("value").alias(out))
    return df.join(c, df[code_col] == c["__i"], "left").drop("__i")


def string_indexer(col: str, out: str, order: str = "alphabetAsc") -> StringIndexer:
    """H1 as a Spark ML stage (``alphabetAsc`` = sorted codes; unknown kept)."""
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType=order, handleInvalid="keep")


def _levels(df: DataFrame, col: str, with_null: bool) -> list:
    d = df.select(F.col(col).cast("string").alias("v")).distinct()
    d = d if with_null else d.where(F.col("v").isNotNull())
    return [r[0] for r in d.orderBy(F.col("v").asc_nulls_last()).collect()]


def one_hot(df: DataFrame, col: str, levels: Sequence | None = None, fit_on: DataFrame | None = None,
            null_is_level: bool = True, drop_first: bool = False) -> DataFrame:
    """H3/H4: one 0/1 column ``<col>_<level>`` per sorted level.

    H3 (``null_is_level``): NULL is its own level (sorted last); a value not
    seen at fit time gets all zeros.  H4 (``drop_first``, no NULL level): the
    first sorted level is dropped and NULL gives all zeros.  Of level names
    that differ in case only, the later ones get a number.  For very many
    levels use ``feature_matrix`` or ``one_hot_sparse``.
    """
    if levels is None:
        levels = _levels(fit_on if fit_on is not None else df, col, null_is_level and not drop_first)
    levels = list(levels)
    if drop_first:
        levels = levels[1:]
    v = F.col(col).cast("string")
    cols, taken = {}, {c.lower() for c in df.columns}
    for lv in levels:
        name = plain = f"{col}_{NULL_LEVEL if lv is None else lv}"
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{plain}__{n}"
        taken.add(name.lower())
        cols[name] = (v.isNull() if lv is None else F.coalesce(v == F.lit(lv), F.lit(False))).cast("int")
    return df.withColumns(cols).drop(col)


def one_hot_sparse(col: str, out: str) -> Pipeline:
    """H3 for many levels: indexer + sparse one-hot vector (unknown -> extra slot)."""
    return Pipeline(stages=[
        StringIndexer(inputCol=col, outputCol=f"{col}__idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCol=f"{col}__idx", outputCol=out, dropLast=False, handleInvalid="keep"),
    ])


def feature_names(groups: Sequence[tuple[str, Sequence[str]]]) -> list[tuple[int, str, str]]:
    """H7: ``(position, group, name)`` for an ordered list of column groups."""
    out, pos = [], 0
    for g, names in groups:
        for n in names:
            out.append((pos, g, n))
            pos += 1
    return out


def fit_levels(fit: DataFrame, col: str, dummies: bool) -> tuple[DataFrame, int]:
    """H3/H4 fit: the table ``(value, idx)`` of a column's levels as text, NULL the last of them, and their number.

    For ``dummies`` the first level and NULL have no place.
    """
    codes = cut_lineage(fit_codes(fit.select(F.col(f"`{col}`").cast("string").alias("value")), "value"))
    if dummies:
        codes = codes.where("idx > 0").withColumn("idx", F.col("idx") - 1)
    elif fit.where(F.col(f"`{col}`").isNull()).limit(1).count():
        null = codes.agg(F.lit(None).cast("string").alias("value"), F.count("*").cast("int").alias("idx"))
        codes = codes.select("value", "idx").unionByName(null)
    return codes, codes.count()


def levels_place(df: DataFrame, col: str, codes: DataFrame, out: str, dummies: bool) -> DataFrame:
    """H3/H4 apply: ``df`` with ``out``, the place of the row's level; NULL for unknown values (for dummies the first level and NULL too)."""
    c = codes.select(F.col("value").alias("__v"), F.col("idx").cast("int").alias(out))
    match = F.col("__t").eqNullSafe(F.col("__v")) if not dummies else F.col("__t") == F.col("__v")
    return df.withColumn("__t", F.col(f"`{col}`").cast("string")).join(c, match, "left").drop("__t", "__v")


def feature_matrix(df: DataFrame, id_col: str, one_hot_cols: Sequence[str] = (), dummy_cols: Sequence[str] = (),
                   ordinal_cols: Sequence[str] = (), scaled_cols: Sequence[str] = (),
                   passthrough: Sequence[str] = (), fit_on: DataFrame | None = None,
                   out: str = "features") -> tuple[DataFrame, DataFrame]:
    """H6/H7: combined transform into one vector column plus its name table.

    Returns ``(matrix (id, features), names (position, group, name))``.
    One-hot blocks are sparse and hold any number of levels.  Columns not named
    are dropped (C5).  NULLs inside numeric features become NaN in the vector
    (``handleInvalid="keep"``).  ``transforms.FeatureMatrix`` is the form that can be saved.
    """
    from tessera.operators.transforms import FeatureMatrix

    model = FeatureMatrix(oneHotCols=list(one_hot_cols), dummyCols=list(dummy_cols), ordinalCols=list(ordinal_cols),
                          scaledCols=list(scaled_cols), passthrough=list(passthrough), outputCol=out).fit(fit_on if fit_on is not None else df)
    return model.transform(df).select(id_col, out), model.names()
