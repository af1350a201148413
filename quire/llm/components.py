"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of the edge table (a, b) (longs) the
    smallest node reachable from it; a node without edges isn't listed.

    Each round links every node to the smallest of its neighbours, first for
    the larger neighbours, then for the smaller ones, until the edges are stars
    around the smallest node. The number of edges never grows, no neighbour
    list is collected (smallest neighbours are an aggregate that Spark
    combines before the shuffle), and each round is written to the shared
    checkpoint folder."""
    edges = stored(edges.where("a is not null and b is not null and a != b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = stored(small.select("a", F.col("m").alias("b"))
                       .union(small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                       .where("a != b").distinct(), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
