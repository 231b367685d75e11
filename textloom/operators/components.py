"""Connected components by alternating star contractions; links and labels stay distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is hung on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(id, component) of every node that has an edge; the component is its smallest node.

    Edges may repeat, point either way or loop; null ends are left out, a node with only a loop to itself has no row.
    Rounds are logarithmic in the longest path. A node's edges are never gathered: stars are formed by aggregation and join,
    whose skew adaptive execution splits.
    """
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    now, before = checkpointed(now), None
    for _ in range(most_rounds):
        now = checkpointed(_small_star(_large_star(now)))
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
