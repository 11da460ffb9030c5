"""Connected components of a stored edge table, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import stored


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b: long) is connected to.

    Each round makes every node point at smaller ones: first all larger
    neighbours of a node at its smallest neighbour, then the node and its smaller
    neighbours. Rounds needed grow with the logarithm of the longest path. Each
    is a written table; nothing but counts reaches the driver. Nodes without an
    edge are not returned.
    """
    at = stored(_small_star(edges.select("a", "b")), "edges")
    for _ in range(rounds):
        if _settled(at):
            break
        at = stored(_small_star(_large_star(at)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = at.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return stored(at.toDF("node", "root").unionByName(roots), "roots")


def _settled(edges: DataFrame) -> bool:
    """Whether each node points at one other that points at none, so that edges are stars around smallest nodes."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.filter("out > 1 OR (out > 0 AND into > 0)").count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.toDF("a", "b")).distinct()
