"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges(u, v)`` that is not the smallest of its component.

    Alternating large-star and small-star rounds: every round is two joins against one row per node, minima are
    aggregated before the shuffle, and the edge list never grows.  Each round is written to the shared folder, so
    a lost executor costs one round.  Rounds grow with the logarithm of the diameter.  Self-loops and repeated
    edges are allowed; an empty edge list gives an empty result.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = materialise(ordered, label)
    mark = None
    while True:
        stamp = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
        now = tuple(state.agg(F.count(F.lit(1)).alias("n"), stamp).first())
        if now == mark or now[0] == 0:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        state = materialise(_small_star(_large_star(state)), label)
