"""Connected components of a graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``): the smallest node it is connected with.

    Each round first points every node's larger neighbours, then its smaller ones, at the smallest node nearby, until
    the edges are stars; edges that are stars from the start need no round. Each round is written to the shared folder, so the plan
    stays short and a lost executor repeats at most one round. Smallest neighbours are found by partial aggregation; the joins back
    are left to AQE, which splits a node with very many neighbours.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    graph = cut_lineage(edges.filter("a <> b").select(larger, smaller).distinct())
    while not _stars(graph):
        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # One row for each edge, from its smaller end; repeats go with those of the next step.
        down = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select("m", F.explode(F.array("a", "b")).alias("a"))
        graph = cut_lineage(small.select("a", F.col("m").alias("b")).filter("a <> b").distinct())
    roots = graph.select(F.col("b").alias("node")).distinct()
    return graph.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _stars(graph: DataFrame) -> bool:
    """Whether all edges ``a > b`` lead from a node that has no other to one that has only such."""
    ends = graph.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        graph.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max(F.col("up") + F.col("down") * F.least("up", F.lit(1)) > 1)).first()[0]
