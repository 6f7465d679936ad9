"""Connected components of links, as joins over the links until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label`` (the smallest node it is connected with) of every node in a link.

    Every round a node takes the smallest label among its neighbours, and then
    that label's own label, so paths halve; chains end after a logarithmic
    number of rounds.  Aggregates combine before the shuffle, so a node with
    very many links doesn't gather them in one task.
    """
    one_way = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y").distinct()
    edges = cut_lineage(one_way.union(one_way.select(F.col("y"), F.col("x"))))
    labels = cut_lineage(edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("y"))
                         .select("node", F.least("node", "y").alias("label")))
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node"))
                .agg(F.min("label").alias("near")))
        taken = (labels.join(near, "node")
                 .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        taken = cut_lineage(taken)
        jump = taken.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = cut_lineage(taken.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")))
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
