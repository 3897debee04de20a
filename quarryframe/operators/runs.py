"""Frame-ordered analytics: runs, gap filling, presence flags, sliding consensus. Windows are partitioned by clip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, run: str = "run_id", length: str = "run_length") -> DataFrame:
    """Number the maximal runs of equal `value` in each key's order (from 1) and add their length."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(value).over(ordered)
    change = F.when(F.row_number().over(ordered) == 1, 1).when(before.eqNullSafe(F.col(value)), 0).otherwise(1)
    out = df.withColumn("_change", change)
    out = out.withColumn(run, F.sum("_change").over(ordered.rowsBetween(Window.unboundedPreceding, 0))).drop("_change")
    return out.withColumn(length, F.count("*").over(Window.partitionBy(*keys, run)))


def run_segments(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """One row for each run: keys, run_id, value, first and last position, length."""
    return with_runs(df, keys, [order], value).groupBy(*keys, "run_id").agg(F.first(value).alias(value), F.min(order).alias("first_at"), F.max(order).alias("last_at"), F.count("*").alias("length"))


def short_run_limit(n: Column, ratio: float = 0.1) -> Column:
    """max(1, round half-even(n * ratio))."""
    return F.greatest(F.lit(1), F.rint(n * F.lit(ratio)).cast("int"))


def clean_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, limit: Column) -> DataFrame:
    """Fill False runs shorter than `limit`, then, on the new series, drop True runs shorter than it; edges count as runs."""
    out = df.withColumn("_limit", limit)
    filled = with_runs(out, keys, order, value).withColumn(value, F.col(value) | (F.col("run_length") < F.col("_limit"))).drop("run_id", "run_length")
    return with_runs(filled, keys, order, value).withColumn(value, F.col(value) & (F.col("run_length") >= F.col("_limit"))).drop("run_id", "run_length", "_limit")


def presence_flags(frames: DataFrame, clip: str, order: Sequence[str], left: Column, right: Column, both: Column, ratio: float = 0.1) -> DataFrame:
    """Per clip the eight flags over cleaned frame series: hands left, right, both, none; objects none, left, right, two-hand."""
    out = frames.select(clip, *order, left.alias("_l"), right.alias("_r"), both.alias("_b"))
    out = out.withColumn("_n", F.count("*").over(Window.partitionBy(clip)))
    for c in ("_l", "_r", "_b"):
        out = clean_runs(out, [clip], order, c, short_run_limit(F.col("_n"), ratio))
    every = lambda x: F.coalesce(F.bool_and(x), F.lit(True)).cast("int")
    l, r, b = F.col("_l"), F.col("_r"), F.col("_b")
    return out.groupBy(clip).agg(
        every(l).alias("left_hand_presence"), every(r).alias("right_hand_presence"), every(l & r).alias("both_hands_presence"), every(~(l | r)).alias("no_hands_presence"),
        every(~(l | r | b)).alias("no_object_presence"), every(l).alias("left_object_presence"), every(r).alias("right_object_presence"), every(b).alias("twohands_object_presence"),
    )


def temporal_consensus(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, radius: int, share: float, out: str = "consensus") -> DataFrame:
    """True where at least max(1, ceil(share * n)) of the n rows within `radius` positions (clamped at the ends) are True."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-radius, radius)
    return df.withColumn(out, F.sum(F.col(value).cast("int")).over(w) >= F.greatest(F.lit(1), F.ceil(F.count("*").over(w) * F.lit(float(share)))))


def local_median_cap(df: DataFrame, keys: Sequence[str], frame: str, area: str, radius: int = 5, factor: int = 6) -> DataFrame:
    """Keep rows whose area is at most factor * int(median of the areas within `radius` frames). The window form: medians are taken
    before anything is dropped."""
    w = Window.partitionBy(*keys).orderBy(frame).rangeBetween(-radius, radius)
    return df.withColumn("local_median", F.percentile(F.col(area), F.lit(0.5)).over(w)).where(F.col(area) <= factor * F.floor("local_median"))


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """The last non-null value so far."""
    return df.withColumn(out, F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def visibility_spans(df: DataFrame, keys: Sequence[str], order: str, visible: str) -> DataFrame:
    """First and last visible position, number of visible rows, number of visibility changes."""
    flips = F.lag(visible).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_flip", (flips != F.col(visible)).cast("int")).groupBy(*keys).agg(
        F.min(F.when(F.col(visible), F.col(order))).alias("first_visible"), F.max(F.when(F.col(visible), F.col(order))).alias("last_visible"),
        F.count_if(visible).alias("visible_rows"), F.coalesce(F.sum("_flip"), F.lit(0)).alias("visibility_changes"),
    )


def overlapping_windows(frame: Column, frames: Column, size: int, overlap: int) -> Column:
    """Ids of the processing windows [i*(size-overlap), +size) that hold a frame; the last one is ragged and reaches the end."""
    step = size - overlap
    last = F.greatest(F.ceil((frames - size) / step), F.lit(0)).cast("int")
    first = F.greatest(F.ceil((frame - size + 1) / step), F.lit(0)).cast("int")
    return F.sequence(F.least(first, last), F.least(F.floor(frame / step).cast("int"), last))
