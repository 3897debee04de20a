"""Vectorised word handling over Arrow string columns, and lineage cuts.

A *word* is a maximal run of bytes outside 0x20 and 0x09-0x0D. Words never span rows. Everything here works on slices of a
record batch of at most `CHUNK_BYTES` of text (or one row, if a single text is longer), so memory is bounded by the
longest text and not by the batch that Spark sends.
"""

from __future__ import annotations

import atexit
import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, shared_folder

CHUNK_BYTES = 2 << 20
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_NO_LETTERS = np.ones(256, dtype=bool)
_NO_LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_RNG = np.random.default_rng(20240229)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_VALUE_LOWER = _BYTE_VALUE.copy()
_BYTE_VALUE_LOWER[0x41:0x5B] = _BYTE_VALUE[0x61:0x7B]
_BASE = 0x9E3779B97F4A7C13  # odd, 3 mod 8: powers of it keep their low bits apart
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2^64."""
    if len(_POWERS["up"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser; works in place on a fresh uint64 array."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each slice holds at most `limit` bytes of `column`, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_buffers(batch.column(batch.schema.get_field_index(column)))[1]
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; a null counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data, offsets


class Words:
    """Word positions (`starts`, `ends` in `data`) of a string column, and `bounds`: row i has words bounds[i]..bounds[i+1]."""

    def __init__(self, column: pa.Array, letters_only: bool = False):
        """letters_only: other ASCII characters than letters and digits part words, too."""
        data, offsets = text_buffers(column)
        self.data = data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets = offsets - offsets[0]
        n = len(data)
        space, edge = np.ones(n + 2, dtype=bool), np.zeros(n + 1, dtype=bool)
        space[1:-1] = (_NO_LETTERS if letters_only else _SPACES)[data]
        edge[offsets] = True
        word = ~space[1:-1]
        self.starts = np.flatnonzero(word & (space[:-2] | edge[:-1]))
        self.ends = np.flatnonzero(word & (space[2:] | edge[1:])) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self, lower: bool) -> np.ndarray:
        """A 64-bit hash of each word's bytes; with `lower`, A-Z count as a-z."""
        up, down = powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((_BYTE_VALUE_LOWER if lower else _BYTE_VALUE)[self.data] * up[:-1], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        h ^= (self.ends - self.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(h)


def window_hashes(words: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Rabin-Karp hashes of all runs of `size` consecutive word hashes (of len(words) - size + 1 runs), by prefix sums."""
    n = len(words)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((words if not salt else mix(words ^ np.uint64(salt))) * up[:-1], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[: n - size + 1] + np.uint64(size))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of start, start+1, ... of each run."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return first + np.arange(total)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write `df` as Parquet to the shared folder and read it back.

    Lost executors then cost at most the stages after the last cut. `free` deletes a cut that nothing reads any more, `drop_cuts`
    (also called at exit) all of them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if spark.sparkContext.applicationId not in _OPEN:
        _OPEN[spark.sparkContext.applicationId] = []
        atexit.register(drop_cuts, spark)
    _OPEN[spark.sparkContext.applicationId].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def free(*cuts: DataFrame) -> None:
    """Delete cuts; whatever rests on them must have been written before."""
    for df in cuts:
        delete_path(df.sparkSession, df._cut_path)


def tidy(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of finished stages now: its cleaner follows the garbage collection of the driver, which may be
    long in coming while the driver has little to do. It takes two: the first lets go of what Python held in the JVM."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(1)
    spark.sparkContext._jvm.System.gc()


def cuts_so_far(spark: SparkSession) -> int:
    return len(_OPEN.get(spark.sparkContext.applicationId, ()))


def free_between(spark: SparkSession, first: int, last: int) -> None:
    """Delete the cuts numbered first to last - 1, in the order in which they were made."""
    for path in _OPEN.get(spark.sparkContext.applicationId, ())[first:last]:
        delete_path(spark, path)
    tidy(spark)


def drop_cuts(spark: SparkSession) -> None:
    """Delete every cut of this application; no frame that rests on one may be used afterwards."""
    try:
        delete_path(spark, shared_folder(spark))
    except Exception:  # at exit the JVM may be gone
        pass


_OPEN: dict[str, list[str]] = {}


def boxed(docs: DataFrame, **keys) -> DataFrame:
    """All columns of `docs` in one struct `row`, beside the given keys: no column of theirs can clash with a name used here."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *[value.alias(name) for name, value in keys.items()])


def spread_join(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """rows joined with one row for each `key` (a long), so that AQE can split a key that many rows share.

    `groups` is an aggregate by the key and thus dealt out by it already, which would tie the join to that exchange; AQE splits
    skewed partitions only where both sides are dealt out for the join itself. Joining on an expression of the key does that.
    """
    other = groups.withColumnRenamed(key, "_other")
    return rows.join(other, F.col(key).bitwiseXOR(F.lit(1)) == F.col("_other").bitwiseXOR(F.lit(1))).drop("_other")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
