"""Connected components of an undirected edge table, by alternating large-star and small-star rounds.

Labels are the smallest id of a component. Each round is two aggregations and two joins over the edges; the
number of rounds grows with the logarithm of the graph, not with the size of a hub, and no task gathers a
neighbourhood. Rounds are written to the shared folder, so lost executors only cost their own part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.llm.common import forget, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect each node's neighbours to the smallest of node and neighbours (large: those above the node only)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:  # towards smaller neighbours
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # written first, so that the join reads both sides from plain shuffles, in which a hub's edges can be split
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    linked = both.join(least, "u")
    if large:
        pairs = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        pairs = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return pairs.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component for every node of ``edges`` (columns a, b of longs; loops, repeats and nulls are ignored).

    An empty edge table gives an empty result.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = materialize(edges, "edges"), None
    while True:
        nodes = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if nodes == before or nodes[0] == 0:
            break
        before = nodes
        after = materialize(_star(_star(edges, True), False), "edges")
        forget(edges)
        edges = after
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
