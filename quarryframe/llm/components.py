"""Connected components of an edge table by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import cut, free, spread_join


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) longs -> (id, component): for each id in an edge, the smallest id that it reaches.

    Both stars only ever compute a minimum for each key and join it back, so no neighbourhood is gathered in one task: a hub
    with a third of all rows is summed map-side, and its join is split by AQE. Each round is checkpointed. Self-loops and
    repeated rows are fine; rows with a null end are dropped.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and u > v")
    now, last = cut(pairs.distinct()), None
    for _ in range(max_rounds):
        # Large star: every larger neighbour of x hangs on the smallest id around x.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = spread_join(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: x and its smaller neighbours hang on the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        before, now = now, cut(small.select("e.*").where("u > v").distinct())
        free(before)
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError("connected components did not converge")
    # At the fixed point every id hangs on its component's smallest id.
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
