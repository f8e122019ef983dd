"""Connected components on Spark (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged


def _low(edges: DataFrame, name: str) -> DataFrame:
    """Smallest neighbour of each ``u`` (at most ``u`` itself); stored, so that the join
    with it has a plain exchange on both sides and hot nodes can be split."""
    return staged(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), name)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); component = smallest node.

    Each round links every node to the smallest one it knows. Neighbour lists
    are never gathered: a round is two grouped minima and two joins. Rounds grow
    with the logarithm of the longest chain; the result is checked to be a set of
    stars, and a graph that isn't after ``max_rounds`` raises.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = staged(pairs.where("u <> v").distinct(), "cc_edges")
    mark = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _low(both, "cc_low")
        large = staged(both.join(low, "u").where("v > u and v <> m")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc_large")
        low = _low(large, "cc_low")
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = staged(small, "cc_edges")
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if mark == seen:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
