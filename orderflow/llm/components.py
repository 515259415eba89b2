"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.sources.workdir import stored


def _closest(pairs: DataFrame) -> DataFrame:
    """Least neighbour of each node. A node with very many neighbours is pre-aggregated in each task."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its least neighbour, or to itself if it is less."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    return (pairs.join(_closest(pairs), "u").where("v > u")
            .select(F.least("m", "u").alias("a"), F.col("v").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them. Edges have a < b."""
    pairs = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = _closest(pairs)
    moved = pairs.join(least, "u").where("v > m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node that it reaches.

    ``edges`` has comparable columns a and b without nulls. Large and small stars alternate; the number of
    rounds grows with the logarithm of the longest path. Each round is written to the shared folder, so the
    plan stays short and lost executors cost one round. Joins are of neighbour rows with one row per node, so
    a hub's rows can be split over tasks.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "stars")
        # order-free digest of all edges; equal in two rounds: nothing moved
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select("a", "a").distinct())
