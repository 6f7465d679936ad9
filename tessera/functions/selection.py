"""Exact quantiles of many columns and groups in two scans.

The first scan builds Spark's mergeable quantile sketch per group and column and reads off an
interval around every rank that is asked for.  The second scan counts what lies below and
above the interval and, value by value, what lies inside: a share of a group of about four
times the sketch's error.  Only these counts are shuffled and only the inside is sorted.  The
largest value below and the smallest above come along, so a rank just outside is known too.
Should a sketch miss a rank by more, its group is looked at again with a wider interval, at
last with all values: the result is exact whatever the sketch says.

The intervals of up to ``MAX_BROADCAST`` ranks go to the rows, so that a few groups aren't a few
tasks; those of more groups meet the rows by a shuffle on the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

ACCURACY = 10_000  # of the sketch: a rank is off by at most a row in that many
MAX_BROADCAST = 200_000  # ranks asked for over all groups, some 50 bytes each
_SLACKS = (2, 64, None)  # half an interval, in errors of the sketch; None: all values


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], cols: Sequence[str], probs: Sequence[float] = (0.5,),
                    accuracy: int = ACCURACY, slacks: Sequence[int | None] = _SLACKS) -> DataFrame:
    """``(group..., column, prob, value)``: between the two nearest ranks the value is interpolated.

    NULL and NaN are skipped; infinities are values.  A group (a NULL group is one) or column without
    values has no row.  Columns of any name; the result's ``column`` and ``prob`` hide groups of these names.
    """
    g = [f"__g{i}" for i in range(len(group_cols))]
    rows = df.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(group_cols, g)],
                     *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"__v{i}") for i, c in enumerate(cols)])
    found, open_ = [], None
    for slack in slacks:
        asked = cut_lineage(_intervals(rows, g, len(cols), probs, accuracy, slack, open_))
        got = cut_lineage(_ranked(rows, g, len(cols), asked))
        found.append(got.where("value is not null"))
        open_ = got.where("value is null").select(*g, "__c", "__p")
        if slack is None or open_.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    named = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("__c") + 1)
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__p") + 1)
    return out.select(*[F.col(a).alias(c) for a, c in zip(g, group_cols)], named.alias("column"), prob.alias("prob"), "value")


def _intervals(rows: DataFrame, g: Sequence[str], n_cols: int, probs: Sequence[float], accuracy: int, slack: int | None,
               open_: DataFrame | None) -> DataFrame:
    """``(group, __asked)``: a row per group with the column, quantile, number of values and interval of each rank asked for."""
    aggs = []
    for i in range(n_cols):
        v = F.col(f"__v{i}")
        aggs.append(F.count(v).alias(f"__n{i}"))
        if slack is not None:
            edges = [min(1.0, max(0.0, p + s * slack / accuracy)) for p in probs for s in (-1, 1)]
            aggs.append(F.percentile_approx(v, edges, accuracy).alias(f"__e{i}"))
    sketch = rows.groupBy(*g).agg(*aggs)
    asked = []
    for i in range(n_cols):
        for j, p in enumerate(probs):
            lo, hi = (F.col(f"__e{i}")[2 * j], F.col(f"__e{i}")[2 * j + 1]) if slack is not None else (F.lit(float("-inf")), F.lit(float("inf")))
            asked.append(F.struct(F.lit(i).alias("c"), F.lit(j).alias("p"), ((F.col(f"__n{i}") - 1) * F.lit(float(p))).alias("at"),
                                  F.col(f"__n{i}").alias("n"), lo.alias("lo"), hi.alias("hi")))
    long = sketch.select(*g, F.explode(F.array(*asked)).alias("a")).where("a.n > 0")
    if open_ is not None:
        other = open_.toDF(*[f"__o{c}" for c in open_.columns])
        on = (F.col("a.c") == F.col("__o__c")) & (F.col("a.p") == F.col("__o__p"))
        for c in g:
            on = on & F.col(c).eqNullSafe(F.col(f"__o{c}"))
        long = long.join(other, on, "left_semi")
    return long.groupBy(*g).agg(F.collect_list("a").alias("__asked"))  # columns times quantiles


def _ranked(rows: DataFrame, g: Sequence[str], n_cols: int, asked: DataFrame) -> DataFrame:
    """``(group, __c, __p, value)``; the value is NULL where the interval doesn't hold the ranks."""
    if g:
        on = F.lit(True)
        for c in g:  # a NULL group is a group
            on = on & F.col(c).eqNullSafe(F.col(f"__o{c}"))
        ranks = asked.agg(F.sum(F.size("__asked"))).first()[0] or 0
        others = asked.withColumnsRenamed({c: f"__o{c}" for c in g})
        joined = rows.join(F.broadcast(others) if ranks <= MAX_BROADCAST else others, on)
    else:
        joined = rows.withColumn("__asked", asked.select("__asked").scalar())
    values = F.array(*[F.col(f"__v{i}") for i in range(n_cols)])
    each = joined.select(*g, values.alias("v"), F.explode("__asked").alias("a")).select(
        *g, F.get("v", F.col("a.c")).alias("v"), F.col("a.c").alias("__c"), F.col("a.p").alias("__p"), F.col("a.at").alias("at"),
        F.col("a.lo").alias("lo"), F.col("a.hi").alias("hi")).where("v is not null")
    side = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), 1).otherwise(0)
    keys = [*g, "__c", "__p", "at"]
    counts = each.groupBy(*keys, side.alias("side"), F.when(side == 0, F.col("v")).alias("inside")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    running = Window.partitionBy(*g, "__c", "__p").orderBy("side", "inside").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("start", F.coalesce(F.sum("n").over(running), F.lit(0)))

    def at(rank):
        last = F.col("start") + F.col("n") - 1
        known = (F.col("side") == 0) | ((F.col("side") == -1) & (rank == last)) | ((F.col("side") == 1) & (rank == F.col("start")))
        return F.max(F.when((rank >= F.col("start")) & (rank <= last) & known, F.when(F.col("side") == -1, F.col("most")).otherwise(F.col("least"))))

    ends = placed.groupBy(*keys).agg(at(F.floor("at")).alias("lo"), at(F.ceil("at")).alias("hi"))
    between = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    return ends.select(*g, "__c", "__p", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(between).alias("value"))


def group_medians(df: DataFrame, group_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``(group..., <col>...)``: the exact median of every column per group; NULL where a group has no value of a column."""
    long = exact_quantiles(df, group_cols, cols)
    return long.groupBy(*[F.col(f"`{c}`") for c in group_cols]).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in cols])
