"""Connected components of an edge table, by alternating large-star and small-star contraction.

Every round is two aggregations and two joins over edges; stars shrink the diameter geometrically, so the rounds grow
with the logarithm of the longest chain. Each star is written to the shared folder and the one before it deleted. No vertex or edge list reaches
the driver; only a count and a checksum per round do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import forget, written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction of edges (u, v): neighbours are linked to the least of the neighbourhood."""
    if small:  # each vertex with its smaller neighbours
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """vertex, component (the least vertex) for all vertices that have an edge."""
    e = edges.select(F.col(src).cast("bigint").alias("u"), F.col(dst).cast("bigint").alias("v")).where("u <> v")
    e = written(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        # cut between the stars too: the second names its edges twice and would plan the first as often
        for small in (False, True):
            star = written(_star(e, small), "star")
            forget(e)
            e = star
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    members = e.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return members.unionByName(e.select(F.col("v").alias("vertex"), F.col("v").alias("component"))).groupBy("vertex").agg(F.min("component").alias("component"))
