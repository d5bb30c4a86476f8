"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `links (a, b)` of longs: `root` is the smallest node that can be reached.

    Each round sends every node to its least neighbour, renames the ends of all links by that and drops the links that
    have become loops; the rounds end when no link is left. Nodes are compared by their hashes (which are one to one for
    longs), so whatever the order of the numbers along a path, a constant part of the nodes goes in every round, and there are
    about as many rounds as the logarithm of the longest path. Rounds are written tables, so the lineage stays short; a node
    with many links is summed inside the tasks first.
    """
    given = cut(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").distinct())
    edges = given.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        step = cut(least.select(F.col("a").alias("node"), F.least("a", "m").alias("to")))
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = edges.join(left, "a").join(right, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        edges = cut(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not steps:
        return given.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # from the last round back: where a node went, and where that one went in the end
    roots = steps[-1].select("node", F.col("to").alias("end"))
    for step in reversed(steps[:-1]):
        later = roots.select(F.col("node").alias("to"), "end")
        roots = cut(step.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("end")))
    nodes = given.select(F.col("a").alias("node")).union(given.select("b")).distinct()
    ended = cut(nodes.join(roots.withColumnRenamed("node", "hash"), F.xxhash64(nodes["node"]) == F.col("hash")).select("node", "end"))
    named = ended.groupBy("end").agg(F.min("node").alias("root"))
    return ended.join(named, "end").select("node", "root")
