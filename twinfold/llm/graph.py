"""Connected components of large edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node.

    Each round points every node to its least neighbour or itself, follows the pointers twice and contracts the
    graph, so long chains shrink geometrically and a node of any degree costs one aggregated row.
    """
    edges = stage(edges.filter("a <> b").select("a", "b"), "links")
    known = None
    while True:
        both = edges.union(edges.select("b", "a"))
        to = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to"))
        to = stage(to, "pointers")
        for _ in range(2):
            ahead = to.select(F.col("node").alias("to"), F.col("to").alias("ahead"))
            to = to.join(ahead, "to").select("node", F.col("ahead").alias("to"))
        to = stage(to, "pointers")
        if known is None:
            known = to.withColumnRenamed("to", "component")
        else:
            later = to.select(F.col("node").alias("component"), "to")
            known = known.join(later, "component", "left")
            known = known.select("node", F.coalesce("to", "component").alias("component"))
        for side in ("a", "b"):
            edges = edges.join(to.withColumnRenamed("node", side), side).drop(side).withColumnRenamed("to", side)
        edges = stage(edges.filter("a <> b").select("a", "b").distinct(), "links")
        if edges.isEmpty():
            return stage(known, "components")
        known = stage(known, "components")
