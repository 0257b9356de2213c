"""Connected components of an edge table, by alternating large-star and small-star rounds; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """pairs (a, b): links every neighbour b of a on the one side of a to the least of a and its neighbours."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = pairs.join(least, "a")
    if small:
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
    return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the least node reachable) for every node of edges (a, b); loops and repeated edges are harmless, nulls are
    left out, an empty table gives an empty one. The rounds grow as the logarithm of the longest path; RuntimeError where most_rounds
    don't do, as an unfinished result would be wrong."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    check = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).alias("c")
    before = now.agg(check).first().c
    for _ in range(most_rounds if before[0] else 0):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, small=False)
        old, now = now, stored(_star(large, small=True), "edges")
        after = now.agg(check).first().c
        discard(old)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components aren't complete after {most_rounds} rounds")
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
