"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Most rounds; nodes at least halve with each round and paths with each jump, so 60 do for any graph.
ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def downhill_roots(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of nodes with a lesser neighbour: where going to the least neighbour, again and again,
    ends. Nodes of one root are connected; connected nodes may have different ones.

    Neighbours are aggregated, never gathered, and each jump doubles the length of the way: all steps
    but the first work on a row for each node.
    """
    least = _both_ways(links.filter("a <> b")).groupBy("a").agg(F.min("b").alias("root")).filter("root < a")
    ways = scratch.table(least.withColumnRenamed("a", "node"), f"{name}-way")
    for jump in range(ROUNDS):
        on = ways.select(F.col("node").alias("from"), F.col("root").alias("to"))
        longer = ways.join(on, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved"))
        longer = scratch.table(longer, f"{name}-way-{jump}")
        ways, done = longer.select("node", "root"), not longer.filter("moved").limit(1).count()
        if done:
            return ways
    raise RuntimeError("the roots of a graph did not settle")


def thinned(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Of each node the links with its least and its greatest neighbour: two a node, which connect nearly
    what all links do."""
    ends = scratch.table(_both_ways(links.filter("a <> b")).groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most")), f"{name}-ends")
    return ends.select("a", F.col("least").alias("b")).union(ends.select("a", "most"))


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for each node of the links (a, b) but the roots: root is the least node reachable.

    In each round nodes go downhill to roots, and what links different roots is left for the next one.
    A large group whose nodes nearly all link with each other ends in the first round. Should the
    rounds not do, this raises.
    """
    edges, found = links.select("a", "b").filter("a <> b"), None
    for k in range(ROUNDS):
        roots = downhill_roots(edges, scratch, f"{name}-{k}")
        onto = roots.select(F.col("node").alias("from"), F.col("root").alias("to"))
        if found is None:
            found = roots
        else:
            moved = found.join(onto, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root"))
            found = scratch.table(moved.unionByName(roots), f"{name}-found-{k}")
        for end in "ab":
            edges = edges.join(onto, F.col(end) == F.col("from"), "left").withColumn(end, F.coalesce("to", end)).drop("from", "to")
        edges = scratch.table(edges.filter("a <> b").distinct(), f"{name}-edges-{k}")
        if not edges.limit(1).count():
            return found
    raise RuntimeError("the components of a graph did not settle")
