"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.scratch import durable


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of `links` (x, y): the smallest node reachable.

    Each round every node takes the smallest label around it and then that label's own label, until nothing
    changes; the labels are written out after each round.
    """
    edges = durable(links.select("x", "y").union(links.select("y", "x")).distinct())
    labels = durable(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("comp")))
    while True:
        seen = edges.join(labels, edges.y == labels.node).groupBy("x").agg(F.min("comp").alias("seen"))
        lower = durable(
            labels.join(seen, labels.node == seen.x, "left").select("node", "comp", F.least("comp", "seen").alias("low"))
        )
        jump = lower.select(F.col("node").alias("at"), F.col("low").alias("there"))
        moved = durable(
            lower.join(jump, lower.low == jump["at"], "left").select(
                "node", F.coalesce("there", "low").alias("new"), "comp"
            )
        )
        labels = moved.select("node", F.col("new").alias("comp"))
        if moved.where("new <> comp").isEmpty():
            return labels
