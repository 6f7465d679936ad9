"""Class balancing, sampling and splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_u32, hash_unit
from tessera.operators.clean import finite_only
from tessera.operators.neighbors import knn_join
from tessera.operators.window import cap_per_class  # noqa: F401  (J1 lives with the windows)
from tessera.session import cut_lineage


def train_val_split(df: DataFrame, id_col: str, train_pct: int = 80, seed: int = 42,
                    out: str = "split") -> DataFrame:
    """Reproducible 80/20 split by a hash bucket of the id (no shuffle)."""
    b = hash_u32(F.lit(seed), F.col(id_col)) % 100
    return df.withColumn(out, F.when(b < train_pct, F.lit("train")).otherwise(F.lit("val")))


def kfold_ids(df: DataFrame, id_col: str, n_folds: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number 0..n-1 from a hash of the id."""
    return df.withColumn(out, (hash_u32(F.lit(seed), F.col(id_col)) % n_folds).cast("int"))


def minority_class(df: DataFrame, label_col: str):
    """Least frequent label (smallest on ties) as a scalar subquery."""
    vc = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("__n"))
    return vc.orderBy("__n", label_col).limit(1).select(label_col).scalar()


def edited_nn(df: DataFrame, id_col: str, features: Sequence[str], label_col: str, k: int = 3) -> DataFrame:
    """Edited nearest neighbours ("all" classes, "all" rule).

    A row survives when all of its ``k`` nearest other rows (ties to the
    smaller id) carry its label.  Rows with a missing feature are dropped.
    """
    own = df.select(id_col, *features, F.col(label_col).alias("__own"))
    nn = knn_join(own, df, id_col, id_col, features, k, exclude_self=True, out_id="__nb",
                  q_carry=["__own"], r_carry=[label_col])
    bad = nn.where(~F.col(f"nb_{label_col}").eqNullSafe(F.col("__own"))).select(id_col).distinct()
    ok = F.lit(True)
    for f in features:
        ok = ok & finite_only(F.col(f).cast("double")).isNotNull()
    return df.where(ok).join(bad, id_col, "left_anti")


def _small_classes(df: DataFrame, label_col: str, minority) -> DataFrame:
    """``(label, need)``: rows each class lacks to the largest one; classes that lack none are left out."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count(F.lit(1)).alias("__n"))
    need = counts.select(F.col(label_col).alias("__label"), (counts.select(F.max("__n")).scalar() - F.col("__n")).alias("__need"))
    need = need.where("__need > 0")
    return need if minority is None else need.where(F.col("__label") == minority)


def adasyn_weights(df: DataFrame, id_col: str, features: Sequence[str], label_col: str,
                   k: int = 5, minority=None) -> DataFrame:
    """J2 first half: how many synthetic rows each row of a smaller class gets.

    For every class but the largest (or only ``minority``): r_i = share of
    other-class rows among a row's k nearest rows; g_i = round_half_even(r_i /
    sum(r) * G), the sum over the class and G = n_largest - n_class.  A class
    whose rows have no neighbour of another class gets none (g = 0).  Output
    ``(id, n_other, g)``.
    """
    need = cut_lineage(_small_classes(df, label_col, minority))  # one row per class
    mdf = df.join(need, F.col(label_col) == F.col("__label")).withColumnRenamed("__label", "__own")
    nn = knn_join(mdf, df, id_col, id_col, features, k, exclude_self=True, out_id="__nb",
                  q_carry=["__own", "__need"], r_carry=[label_col])
    other = cut_lineage(nn.groupBy(id_col, "__own", "__need").agg(
        F.count_if(~F.col(f"nb_{label_col}").eqNullSafe(F.col("__own"))).alias("n_other")))
    total = other.groupBy("__own").agg(F.sum("n_other").alias("__total"))
    g = F.when(F.col("__total") > 0, F.bround(F.col("n_other") / F.col("__total") * F.col("__need"), 0)).otherwise(0)
    return other.join(total, "__own").select(id_col, "n_other", g.cast("int").alias("g"))


def adasyn(df: DataFrame, id_col: str, features: Sequence[str], label_col: str, k: int = 5,
           seed: int = 42, minority=None, with_originals: bool = False) -> DataFrame:
    """ADASYN synthetic rows ``x + lambda * (x_nn - x)`` for every class but the largest (or only ``minority``).

    ``x_nn`` is one of the row's k nearest neighbours of its class and
    ``lambda`` in [0, 1); both come from md5 hashes of (seed, id, j), so the
    output is reproducible.  Returns ``(src_id, j, features..., label)``;
    ``with_originals`` adds the original rows with ``j`` 0.
    """
    w = adasyn_weights(df, id_col, features, label_col, k, minority).where(F.col("g") > 0)
    need = _small_classes(df, label_col, minority).select("__label")
    mdf = df.join(need, F.col(label_col) == F.col("__label"), "left_semi")
    mnn = knn_join(mdf, mdf, id_col, id_col, features, k, exclude_self=True, out_id="__nb",
                   q_carry=[*features, label_col], r_carry=list(features), by=label_col)
    n_nb = mnn.groupBy(id_col).agg(F.count(F.lit(1)).alias("__cnt"))
    draws = (w.join(n_nb, id_col).select(id_col, "__cnt", F.explode(F.sequence(F.lit(1), F.col("g"))).alias("j"))
             .withColumn("rank", (hash_u32(F.lit(seed), F.col(id_col), F.col("j")) % F.col("__cnt") + 1).cast("int"))
             .withColumn("__lam", hash_unit(F.lit(seed), F.lit("step"), F.col(id_col), F.col("j"))))
    out = draws.join(mnn, [id_col, "rank"])
    out = out.select(F.col(id_col).alias("src_id"), "j",
                     *[(F.col(f) + F.col("__lam") * (F.col(f"nb_{f}") - F.col(f))).alias(f) for f in features], label_col)
    if with_originals:
        out = df.select(F.col(id_col).alias("src_id"), F.lit(0).alias("j"), *[F.col(f).cast("double").alias(f) for f in features],
                        label_col).unionByName(out)
    return out
