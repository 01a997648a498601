"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import materialize


def components(links: DataFrame, put=materialize) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every end of a link (``a``, ``b``).

    Each round points every node at its smallest neighbour, follows these pointers to their
    ends and joins the links of what has been merged; at least half of the nodes go in a
    round.  Every aggregate is a minimum, combined before the shuffle, so a node with very
    many links is no hot group, and every round is written (by ``put``), so a lost executor costs one round.
    """
    edges = put(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = put(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p")).select(
            "node", F.least("node", "p").alias("p")), "parents")
        while True:
            above = parents.select(F.col("node").alias("p"), F.col("p").alias("top"))
            stepped = parents.join(above.where("p <> top"), "p", "left")
            moved = put(stepped.select("node", F.coalesce("top", "p").alias("p"), F.col("top").isNotNull().alias("moved")), "parents")
            parents = moved.select("node", "p")
            if moved.where("moved").isEmpty():
                break
        if labels is None:
            labels = parents.select("node", F.col("p").alias("component"))
        else:
            labels = put(labels.join(parents.withColumnRenamed("node", "component"), "component", "left").select(
                "node", F.coalesce("p", "component").alias("component")), "labels")
        merged = edges.join(parents.select(F.col("node").alias("a"), F.col("p").alias("pa")), "a").join(
            parents.select(F.col("node").alias("b"), F.col("p").alias("pb")), "b")
        edges = put(merged.where("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
