"""Connected components of an edge table by repeated contraction, in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pipewatch.session import durable


def connected(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``); equal roots, same component.

    Each round hooks every root that has a smaller neighbour to the smallest one and replaces it
    in the edges, until no edge is left. Ids should be hashes: then chains of falling ids are
    short, and so are the rounds. All tables are durable, and none grows.
    """
    left = durable(edges.select("a", "b").where("a <> b").distinct())
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = durable(nodes.select("node", F.col("node").alias("root")))
    while left.head(1):
        hooks = durable(
            left.select(F.greatest("a", "b").alias("old"), F.least("a", "b").alias("new")).groupBy("old").agg(F.min("new").alias("new"))
        )
        labels = durable(
            labels.join(hooks, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
        )
        for end in ("a", "b"):
            left = left.join(hooks, F.col(end) == F.col("old"), "left").withColumn(end, F.coalesce("new", end)).drop("old", "new")
        left = durable(left.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels
