"""Connected components of a link table, by alternating star steps.

Large-star hangs every larger neighbour of a node onto the smallest node around
it, small-star does so with the smaller ones.  Repeating both turns each
component into a star around its smallest node.  Each step is a combining
aggregate and a join, so a node with very many links is never gathered; each
round is written to the shared folder, and only a count comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    # u is larger than v in every edge that comes from large_star
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (u, v); component is the smallest node reachable.

    Runs until a round changes nothing; the number of rounds grows with the
    logarithm of the longest chain.  Self-links and repeated links do not matter.
    """
    edges = materialize(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    mark = None
    while True:
        edges = materialize(small_star(large_star(edges)))
        # a star forest has one edge per non-root node, and no root has a parent
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == (now["n"], now["h"]):
            break
        mark = (now["n"], now["h"])
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
