"""Connected components of a link table by alternating large and small stars.

Each round is two joins on node ids; a star's centre keeps only what is
smaller than itself, so that rounds grow with the logarithm of the longest
chain.  Links are staged after every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.operators.staging import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or the node itself."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v")))


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for all nodes of ``links(u long, v long)``."""
    own = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stage(own, "links")
    seal = _seal(now)
    while True:
        now = stage(_small_star(stage(_large_star(now).distinct(), "links")).distinct(), "links")
        was, seal = seal, _seal(now)
        if was == seal:
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _seal(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first())
