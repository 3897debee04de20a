"""Exact nearest vectors for a stated query set: blocks of queries against one pass over all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1_000


def nearest_vectors(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, exact_zero: float = 1e-12) -> DataFrame:
    """q, k, rank, dist: for each query the k rows of smallest cosine distance (ties: smaller key), not itself and not at distance 0.

    Each task keeps k candidates for each query of a block, so what is shuffled is (tasks x queries x k) rows, not pairs. A
    block's matrix is bounded by BLOCK vectors; more queries make more passes.
    """
    n = queries.count()
    found = None
    for b in range(max(1, -(-n // BLOCK))):
        own = queries.where(F.pmod(F.xxhash64(key), F.lit(max(1, -(-n // BLOCK)))) == b).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).toPandas()
        if not len(own):
            continue
        ids, q = own["id"].to_numpy(), np.array(own["v"].tolist())
        q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
        hits = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(_search(ids, q, k, exact_zero), "q long, k long, dist double")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return rows.sparkSession.createDataFrame([], "q long, k long, dist double, rank long")
    order = Window.partitionBy("q").orderBy(F.round("dist", 9), "k")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def _search(ids: np.ndarray, q: np.ndarray, k: int, exact_zero: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_id, best = np.full((len(ids), 0), -1), np.empty((len(ids), 0))
        for batch in batches:
            own = batch.column("id").to_numpy()
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1) if len(own) else np.empty((0, q.shape[1]))
            dist = 1 - q @ (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)).T
            dist[(ids[:, None] == own[None]) | (np.abs(dist) <= exact_zero)] = np.inf
            all_id, every = np.hstack((best_id, np.broadcast_to(own, dist.shape))), np.hstack((best, dist))
            order = np.lexsort((all_id, np.round(every, 9)), axis=1)[:, :k]
            best_id, best = np.take_along_axis(all_id, order, 1), np.take_along_axis(every, order, 1)
        real = np.isfinite(best)
        yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(ids[:, None], best.shape)[real]), pa.array(best_id[real]), pa.array(best[real])], names=["q", "k", "dist"])

    return run
