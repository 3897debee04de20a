"""Streaming forms of the frame analytics: watermarked sessions and a stateful run counter."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sessions(events: DataFrame, key: str, at: str, gap: str, late: str) -> DataFrame:
    """Sessions of a key with their length, for a batch or a stream (rows later than `late` are dropped from a stream)."""
    source = events.withWatermark(at, late) if events.isStreaming else events
    out = source.groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("events"))
    return out.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")


def tumbling_counts(events: DataFrame, at: str, size: str, late: str, *keys: str) -> DataFrame:
    source = events.withWatermark(at, late) if events.isStreaming else events
    return source.groupBy(F.window(at, size).alias("w"), *keys).agg(F.count("*").alias("events")).select(F.col("w.start").alias("window_start"), *keys, "events")


def longest_runs(frames: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Stream of (key, longest run of True so far): state is the open run and the longest one, rows of a key come in order."""
    kind = dict(frames.dtypes)[key]

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, longest = state.get if state.exists else (0, 0)
        for batch in batches:
            for good in batch.sort_values(order)[value]:
                now = now + 1 if good else 0
                longest = max(longest, now)
        state.update((now, longest))
        yield pd.DataFrame({key: [keys[0]], "longest": [longest]})

    return frames.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, longest long", "now long, longest long", "update", GroupStateTimeout.NoTimeout)
