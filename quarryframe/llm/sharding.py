"""Operator 3: uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows sit in many small source parts. The driver draws how many rows of each part go to each shard (a multivariate
hypergeometric law: the counts that a uniform permutation of all rows would give), each part permutes its rows and deals
them by its counts, and each shard permutes again what it has got. Only the part sizes (at most `MAX_PARTS` integers) and
the matrix (parts x shards) pass through the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import cut

SHARDS = 16
PART_ROWS = 20_000
MAX_PARTS = 8_192
MIN_PARTS = 32


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """matrix[i, j]: rows of part i for shard j. Rows sum to the part sizes, columns to shard sizes at most one apart."""
    total = sum(sizes)
    left = np.array([total // shards + (j < total % shards) for j in range(shards)], dtype=np.int64)
    draw, out = np.random.default_rng(seed), np.zeros((len(sizes), shards), dtype=np.int64)
    for i, size in enumerate(sizes):
        for j in range(shards):  # one shard after another: univariate draws, exact at any size that the generator takes
            rest = int(left[j + 1 :].sum())
            take = size if not rest else _hypergeometric(draw, int(left[j]), rest, size)
            out[i, j], size = take, size - take
        left -= out[i]
    return out


def _hypergeometric(draw: np.random.Generator, good: int, bad: int, sample: int) -> int:
    if good == 0 or sample == 0:
        return 0
    if good + bad < 10**9:
        return int(draw.hypergeometric(good, bad, sample))
    return inverse_draw(draw.random(), good, bad, sample)  # beyond the generator's range


def inverse_draw(u: float, good: int, bad: int, sample: int) -> int:
    """The hypergeometric law by inversion: its quantile at u, for populations of any size.

    The weights around the mode follow from it by the law's own ratios of neighbours, so no factorials (and no loss of digits in them)
    are needed; what lies further than 12 standard deviations and 60 away weighs under 1e-18 and is left out.
    """
    low, high = max(0, sample - bad), min(sample, good)
    mode = (sample + 1) * (good + 1) // (good + bad + 2)
    spread = math.sqrt(sample * (good / (good + bad)) * (bad / (good + bad)))
    low, high = max(low, mode - int(12 * spread) - 60), min(high, mode + int(12 * spread) + 60)
    k = np.arange(low, high, dtype=np.float64)  # weight(k + 1) / weight(k)
    ratio = (good - k) * (sample - k) / ((k + 1) * (bad - sample + k + 1))
    weight = np.concatenate((np.cumprod(1 / ratio[: mode - low][::-1])[::-1], [1.0], np.cumprod(ratio[mode - low :])))
    upto = np.cumsum(weight)
    return low + min(int(np.searchsorted(upto, u * upto[-1], side="right")), len(weight) - 1)


def uniform_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """documents (doc_id, text) -> doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `rows`: shard sizes differ by one row at most, and any assignment is equally likely over seeds; slot is the row's place
    in its shard's shuffled order, gapless from 0. size = UTF-8 bytes of the text (null: none) plus 1; text_crc32 of a null
    text is that of an empty one. The assignment depends on the rows and the seed only, so a lost task is repeated alike:
    rows are ordered by seeded hashes of (doc_id, size, crc), and rows equal in all of these are interchangeable. grown_shard
    is null (law `key` only). An empty table gives an empty result; other columns are ignored.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"))
    slim = cut(slim)
    rows = slim.count()
    parts = min(MAX_PARTS, max(MIN_PARTS, math.ceil(rows / PART_ROWS)))
    key = ["doc_id", "size", "text_crc32"]
    dealt = slim.select("*", F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(parts)).cast("int").alias("part"))
    sizes = {r.part: r["count"] for r in dealt.groupBy("part").count().collect()}
    matrix = communication_matrix([sizes.get(i, 0) for i in range(parts)], shards, seed)
    ends = matrix.cumsum(axis=1)
    spark = docs.sparkSession
    plan = spark.createDataFrame([(i, [int(x) for x in ends[i]]) for i in range(parts)], "part int, ends array<long>")
    local = Window.partitionBy("part").orderBy(F.xxhash64(*key, F.lit(seed + 1)), *key)
    sent = dealt.withColumn("rank", F.row_number().over(local).cast("long")).join(F.broadcast(plan), "part")  # at most MAX_PARTS x shards numbers
    sent = sent.select(*key, F.size(F.filter("ends", lambda e: e < F.col("rank"))).alias("shard"))
    # The second permutation sorts each shard by a fresh hash, in slices of the hash range so that no task holds a shard.
    slices = max(4, math.ceil(parts / shards) * 2)
    fresh = sent.withColumn("order", F.xxhash64(*key, F.lit(seed + 2)))
    fresh = cut(fresh.withColumn("slice", F.floor((F.shiftrightunsigned("order", 33) * slices) / F.lit(float(2**31))).cast("int")))
    counts = fresh.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")).select("shard", "slice", "before")
    inner = Window.partitionBy("shard", "slice").orderBy(F.shiftrightunsigned("order", 0), "order", *key)
    return fresh.withColumn("at", F.row_number().over(inner)).join(F.broadcast(before), ["shard", "slice"]).select(  # at most shards x slices rows
        *key, F.lit("rows").alias("law"), "shard", (F.col("before") + F.col("at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
