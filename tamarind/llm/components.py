"""Connected components of an edge table by minimum labels with pointer jumping; nothing is collected but row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.scratch import freeze, release


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an edge: the smallest node it can reach.

    Each round takes the smallest label among a node and its neighbours and then the label of that label, so long chains
    shrink quickly. Every round is written to the shared folder, which cuts the lineage. Edges with a null are left out.
    Hot nodes meet in joins that adaptive execution may split, and are combined in each task before a shuffle.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null")
    both = freeze(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = freeze(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("x").alias("y"), "label"), "y")
            .groupBy("x")
            .agg(F.min("label").alias("least"))
        )
        lower = labels.join(near, "x").select("x", "label", F.least("label", "least").alias("next"))
        further = labels.select(F.col("x").alias("next"), F.col("label").alias("beyond"))
        moved = freeze(
            lower.join(further, "next").select("x", "label", F.least("next", "beyond").alias("next")), "labels"
        )
        settled = moved.filter("label <> next").isEmpty()
        release(labels)
        labels = moved.select("x", F.col("next").alias("label"))
        if settled:
            release(both)
            return labels.select(F.col("x").alias("node"), F.col("label").alias("component"))
