"""Connected components by alternating large-star and small-star, on edges that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, written

ROUNDS = 99


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    tied = down.join(least, F.col("u") == F.col("k"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node that has an edge (u, v).

    Each round is written to the shared folder and the one before deleted; its size and a sum of hashes, one row, tell whether it changed anything.
    Edges that still change after ROUNDS rounds are an error: their labels would be those of parts of components.
    """
    edges = written(edges.where("u <> v").distinct(), "star-0")
    state = None
    for i in range(1, ROUNDS + 1):
        before, edges = edges, written(small_star(large_star(edges)), f"star-{i}")
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components: not converged after {ROUNDS} rounds of stars")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
