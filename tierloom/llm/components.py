"""Connected components of a distributed graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import stored

# The steps converge in O(log^2 nodes) rounds; this many would mean a fault.
MAX_ROUNDS = 100


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges point from the larger to the smaller."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    linked = edges.join(least, "u")
    near = linked.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest reachable node for every node of the edges (u, v), without the roots themselves.

    Edges may repeat, point either way and be loops; nodes are of any ordered type without nulls. Each round is stored
    in the shared folder. No group is gathered: minima combine before the shuffle, and are stored, so that adaptive
    execution can divide the edges of a node with many of them in the join.
    """
    pointed = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = stored(pointed, "component-edges")
    before = _fingerprint(current)
    for _ in range(MAX_ROUNDS):
        current = stored(_small_star(stored(_large_star(current), "component-edges")), "component-edges")
        now = _fingerprint(current)
        if now == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError("components did not converge")
