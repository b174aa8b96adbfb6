"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deslinde.session import cut, large


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest one."""
    near = _both_ways(edges)
    low = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return near.where("v > u").join(large(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(large(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, label) for every node that has an edge; the label is the smallest id in the component.

    Each round halves the depth of the trees at least, so rounds grow with the logarithm of
    the longest chain. The smallest neighbour is found by a combinable aggregate and joined
    back as a unique side, which keeps a node with very many edges from being one task's work.
    Every round is written, which is what both the next round and the end test read.
    """
    current = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    state = None
    while True:  # ends: every round but the last hangs some node on a smaller one
        current = cut(_small_star(_large_star(current)))
        fresh = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if fresh == state:
            roots = current.select(F.col("v").alias("id")).distinct().withColumn("label", F.col("id"))
            return current.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots)
        state = fresh
