"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import saved


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least of its neighbourhood."""
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b): each linked node and the least node that it reaches, itself left out.

    Alternates large-star and small-star until no edge moves: rounds grow with the
    logarithm of the component size. Neighbourhoods are never gathered: each round
    takes minima, aggregated before they are shuffled, and joins them back, where
    adaptive execution splits a node with very many neighbours. An empty graph has
    no rows; loops and repeated edges change nothing.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges
        state = now
        edges = saved(_small_star(_large_star(edges)), "edges")
