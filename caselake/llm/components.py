"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root): every node that occurs, with the smallest node of its component.

    Each round points every node at its smallest neighbour, and links the ends of that instead; nodes
    that are smallest among their neighbours carry on. The nodes left at least halve, so the rounds
    are as the logarithm of the nodes, and no component meets in one task: minima are combined on
    the map side and joins on a hub's name are split by adaptive execution.
    """
    spark = links.sparkSession
    edges = materialise(links.filter("a <> b").select("a", "b").distinct(), "edges")
    steps: list[DataFrame] = []
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        to = materialise(least.select(F.col("a").alias("node"), F.least("a", "low").alias("to")), "pointers")
        steps.append(to)
        # a pointer may point at a node that points on: that is the next round's link
        ends = edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a").join(to.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        onward = ends.select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        chained = to.join(to.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").filter("next <> to").select(F.col("to").alias("a"), F.col("next").alias("b"))
        edges = materialise(onward.unionByName(chained).filter("a <> b").distinct(), "edges")
    if not steps:
        return spark.createDataFrame([], links.select(F.col("a").alias("node"), F.col("a").alias("root")).schema)
    roots = steps[0].select("node", F.col("to").alias("root"))
    for to in steps[1:]:
        moved = to.select(F.col("node").alias("root"), F.col("to").alias("next"))
        roots = roots.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return materialise(roots, "roots")
