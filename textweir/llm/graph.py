"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.session import stage

ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum, to see that a round changed nothing."""
    h = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; the root is the smallest node.

    Alternates the large-star and small-star steps: each round hangs the neighbours of a node
    below the smallest of them, until every component is one star. A node's smallest neighbour
    is a partial aggregate, and neighbours are never gathered, so a hub costs no more than its
    edges; its join is split by adaptive execution. Every round is a stored table. Self loops
    and repeated edges are allowed; null ends are dropped; no edges give no rows.
    """
    pairs = edges.where("u < v or v < u").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current = stage(pairs.distinct(), "edges")
    before = _state(current)
    for _ in range(ROUNDS if before[0] else 0):
        both = current.union(current.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
