"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackcast.llm.common import WorkTables


def _toward_smallest(edges: DataFrame) -> DataFrame:
    """(u, v, m) for each directed edge, m the smallest of u and its neighbours; minima are combined before the shuffle."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(low, "u")


def components(links: DataFrame, work: WorkTables, name: str) -> DataFrame:
    """(key, component) of every key that occurs in ``links`` (a, b): the smallest key it is linked to.

    Each round rewires every edge towards smaller keys; stars are the fixed point. Rounds grow with the
    logarithm of the longest chain; every round is written, so a lost executor costs one round.
    """
    # every round has at most as many edges as there are links: its files are sized by that count
    files = max(8, -(-links.count() // 500_000))
    edges = work.put(f"{name}-0", links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().coalesce(files))
    seen, k = None, 0
    while True:
        # u > v in every edge; both directions give a node all its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # smaller neighbours are joined to the smallest of them, and so is the node
        small = _toward_smallest(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        k += 1
        edges = work.put(f"{name}-{k}", small.coalesce(files))
        work.drop(f"{name}-{k - 1}")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("key"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("key"), F.col("v").alias("component")).distinct())
