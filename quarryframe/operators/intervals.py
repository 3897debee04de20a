"""Interval operators: range merging, band and nearest joins, stabbing. Non-equi joins are given an equality on buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_ranges(df: DataFrame, keys: Sequence[str], start: str, stop: str) -> DataFrame:
    """Merge half-open ranges of a key that overlap or touch. Equal ranges are peers in the island numbering, whatever their order."""
    order = Window.partitionBy(*keys).orderBy(start, stop)
    reach = F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1))
    islands = marked.withColumn("_island", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    return islands.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(stop).alias(stop), F.count("*").alias("ranges")).drop("_island")


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, radius: int, how: str = "inner") -> DataFrame:
    """Pairs of a key with |left_at - right_at| <= radius (integers). Each right row goes to its bucket of width radius + 1 and the
    left row looks into three, so the join is an equi join with a residual and no pair is met twice."""
    width = radius + 1
    l = left.withColumn("_bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col(left_at) / width) + d)))
    r = right.withColumn("_bucket", F.floor(F.col(right_at) / width))
    joined = l.join(r, [*keys, "_bucket"]).where(F.abs(F.col(left_at) - F.col(right_at)) <= radius).drop("_bucket")
    if how == "inner":
        return joined
    raise ValueError("inner only; use nearest_join for an outer lookup")


def nearest_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], left_at: str, right_at: str, radius: int) -> DataFrame:
    """For each left row the nearest right position within `radius` (ties: the smaller), NULL if there is none."""
    found = band_join(left.select(*dict.fromkeys([*keys, *left_id, left_at])), right.select(*keys, right_at).distinct(), keys, left_at, right_at, radius)
    best = found.groupBy(*dict.fromkeys([*keys, *left_id, left_at])).agg(F.min(F.struct(F.abs(F.col(left_at) - F.col(right_at)).alias("gap"), F.col(right_at).alias("at"))).alias("_b"))
    best = best.select(*dict.fromkeys([*keys, *left_id, left_at]), F.col("_b.at").alias(right_at))
    return left.join(best, list(dict.fromkeys([*keys, *left_id, left_at])), "left")


def stab(points: DataFrame, ranges: DataFrame, keys: Sequence[str], at: str, start: str, stop: str, width: int) -> DataFrame:
    """Pairs (point, range) with start <= at < stop. Ranges are cut into buckets of `width` so the join has an equality; a range is
    in as many buckets as it spans."""
    r = ranges.where(F.col(stop) > F.col(start)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(stop) - 1) / width))))
    p = points.withColumn("_bucket", F.floor(F.col(at) / width))
    return p.join(r, [*keys, "_bucket"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(stop))).drop("_bucket")


def written_clips(frames: DataFrame, segments: DataFrame, key: str, frame: str, good: str, segment: str, start: str, stop: str, patience: int = 24) -> DataFrame:
    """Clips that are written while a video is decoded: segment, start, how many frames it gets.

    Only frames of the merged ranges are decoded. A segment opens at its start if that frame is good, else never. Each decoded frame
    from there adds one (a bad one repeats the last good one). It closes at the first good frame from stop - 1 on; `patience` bad
    frames in a row close all open segments, and are then counted anew; the end of decoding closes the rest.
    """
    ranges = merge_ranges(segments.select(key, start, stop), [key], start, stop).select(key, start, stop)
    seen = stab(frames.select(key, frame, F.col(good).alias("_good")), ranges, [key], frame, start, stop, 64).select(key, frame, "_good")
    order = Window.partitionBy(key).orderBy(frame)
    ahead = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    seen = seen.withColumns({"_at": F.row_number().over(order), "_after": F.count_if("_good").over(order)})
    bad = F.count_if(~F.col("_good")).over(Window.partitionBy(key, "_after").orderBy(frame))
    seen = seen.withColumn("_flush", ~F.col("_good") & (bad % patience == 0))
    last = F.max("_at").over(Window.partitionBy(key))
    seen = seen.withColumns({"_flushed": F.coalesce(F.min(F.when(F.col("_flush"), F.col("_at"))).over(ahead), last), "_closed": F.coalesce(F.min(F.when(F.col("_good"), F.col("_at"))).over(ahead), last)})
    opened = seen.where("_good").select(key, F.col(frame).alias(start), "_at", "_flushed")
    closing = seen.select(key, (F.col(frame) + 1).alias(stop), "_closed")
    joined = segments.select(key, segment, start, stop).join(opened, [key, start]).join(closing, [key, stop])
    return joined.select(key, segment, start, (F.least("_flushed", "_closed") - F.col("_at") + 1).alias("written"))
