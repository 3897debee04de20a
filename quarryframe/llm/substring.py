"""Operator 2: removal of repeated passages by Rabin-Karp hashes of every window of 50 words.

Each window's rolling hash is computed; windows that cannot repeat are recognised before the shuffle. Each window has an
anchor, the smallest hash among the 10-word runs inside it (a minimizer; neighbouring windows mostly share theirs, so a
document has about one anchor for 20 words). Equal windows have equal anchors, so a window can only repeat in another
document if its anchor does. Anchors are counted first; then only windows with a repeated anchor are shuffled and counted.
Nothing is lost by it, and as hashes have 64 bits, a window can only be taken for another one by chance if its anchor repeats
as well. Copies of a whole word sequence are judged by their first document and send nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import Words, chunks, cut, mix, ranges, spread_join, window_hashes

WINDOW = 50
ANCHOR = 10


def _windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows: hash, anchor, row and start (in words of its row)."""
    h, counts = words.hashes(lower=False), words.counts
    n = np.maximum(counts - WINDOW + 1, 0)
    if not n.any():
        empty = np.empty(0, np.uint64)
        return empty, empty, np.empty(0, np.int64), np.empty(0, np.int64)
    runs = window_hashes(h, ANCHOR, salt=0x5BD1E995)
    least, have, need = runs, 1, WINDOW - ANCHOR + 1
    while have * 2 <= need:
        least, have = np.minimum(least[:-have], least[have:]), have * 2
    least = np.minimum(least[: len(least) - (need - have)], least[need - have :])
    at = ranges(words.bounds[:-1], n)
    row = np.repeat(np.arange(len(counts)), n)
    return window_hashes(h, WINDOW)[at], least[at], row, at - words.bounds[:-1][row]


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        column = batch.column("text")
        words = Words(column)
        _, anchors, row, _ = _windows(words)
        h = words.hashes(lower=False)
        print_a, print_b = np.zeros(len(column), np.uint64), np.zeros(len(column), np.uint64)
        some = np.flatnonzero(words.counts)
        if len(some):
            place = np.arange(len(h)) - np.repeat(words.bounds[:-1], words.counts)
            inner = words.bounds[some]
            print_a[some] = np.add.reduceat(mix(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), inner)
            print_b[some] = np.add.reduceat(mix((h ^ np.uint64(0x77)) + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)), inner)
        fresh = np.ones(len(anchors), dtype=bool)
        fresh[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
        anchors, row = anchors[fresh], row[fresh]
        bounds = np.searchsorted(row, np.arange(len(column) + 1)).astype(np.int32)
        raw, digests = words.data.tobytes(), []
        for a, b in zip(words.offsets[:-1], words.offsets[1:]):
            digests.append(hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("row"), pa.array(words.counts.astype(np.int64)), pa.array(print_a.view(np.int64)), pa.array(print_b.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(anchors.view(np.int64))), pa.array(digests),
            ],
            names=["doc_id", "row", "n_words", "print_a", "print_b", "anchors", "whole_sha256"],
        )


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows whose anchor is among the row's repeated ones."""
    for batch in chunks(batches):
        hashes, anchors, row, start = _windows(Words(batch.column("text")))
        shared = batch.column("shared")
        values, bounds = shared.values.to_numpy(zero_copy_only=False).view(np.uint64), shared.offsets.to_numpy()
        hit = np.zeros(len(hashes), dtype=bool)
        edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
        for i in range(batch.num_rows):
            hit[edges[i] : edges[i + 1]] = np.isin(anchors[edges[i] : edges[i + 1]], values[bounds[i] : bounds[i + 1]])
        ids, keys = batch.column("doc_id").to_numpy(), batch.column("row").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(hashes[hit].view(np.int64)), pa.array(ids[row[hit]]), pa.array(keys[row[hit]]), pa.array(start[hit].astype(np.int32))], names=["window", "doc_id", "row", "start"])


def _removed(n: int, starts: np.ndarray) -> np.ndarray:
    """Which of n words some window covers; windows that overlap or touch merge into one interval."""
    step = np.zeros(n + 1, dtype=np.int32)
    starts = starts[starts <= n - WINDOW]
    np.add.at(step, starts, 1)
    np.add.at(step, starts + WINDOW, -1)
    return np.cumsum(step[:-1]) > 0


def _erase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their removal starts -> what is left, as digest and as text (the white space after a removed word goes with it)."""
    for batch in chunks(batches):
        words = Words(batch.column("text"))
        starts = batch.column("starts")
        values, bounds = starts.values.to_numpy(zero_copy_only=False), starts.offsets.to_numpy()
        raw, gone, digests, texts = words.data.tobytes(), [], [], []
        for i in range(batch.num_rows):
            a, b = words.bounds[i], words.bounds[i + 1]
            out = _removed(b - a, values[bounds[i] : bounds[i + 1]])
            begin, end = words.starts[a:b], words.ends[a:b]
            gone.append(int(out.sum()))
            digests.append(hashlib.sha256(b" ".join(raw[x:y] for x, y in zip(begin[~out], end[~out]))).hexdigest())
            until = np.append(begin[1:], words.offsets[i + 1])  # a word and the white space after it
            change = np.flatnonzero(np.diff(np.concatenate(([True], out, [True])).astype(np.int8)))
            pieces = [raw[begin[x] if x else words.offsets[i] : until[y - 1]] for x, y in zip(change[::2], change[1::2])]
            texts.append(b"".join(pieces).decode())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "row", "n_removed", "kept_sha256", "kept_text"])


def row_key(text: str = "text"):
    """Tells rows apart that share a doc_id; equal rows have the same key."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def repeated_passages(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """documents (doc_id, text) -> doc_id, n_words, n_removed, kept_sha256 (and with `with_text` `row_key` and kept_text, null if
    nothing goes).

    A word is removed if a window of 50 consecutive words of its document covers it whose word sequence also starts in a
    document with a smaller doc_id; judged on the input. Null, empty or short texts (under 50 words) lose nothing. Rows with a
    null doc_id lose nothing and are no one's source. Rows that share a doc_id are judged each by its own text, never against each
    other; equal rows get equal results. Of copies, that with the smallest doc_id stays whole. Other columns are ignored; an
    empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row", row_key())
    outline = cut(docs.mapInArrow(_outline, "doc_id long, row long, n_words long, print_a long, print_b long, anchors array<long>, whole_sha256 string"))
    known = outline.where(f"doc_id is not null and n_words >= {WINDOW}")
    first = known.groupBy("n_words", "print_a", "print_b").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top"))
    many = cut(first.where("top > rep").select(F.xxhash64("n_words", "print_a", "print_b").alias("class"), F.col("n_words").alias("n"), F.col("print_a").alias("x"), F.col("print_b").alias("y"), "rep"))
    same = (F.xxhash64("n_words", "print_a", "print_b") == F.col("class")) & (F.col("n_words") == F.col("n")) & (F.col("print_a") == F.col("x")) & (F.col("print_b") == F.col("y"))
    copies = cut(known.select("doc_id", "row", "n_words", "print_a", "print_b").join(many, same).where("doc_id > rep").select("doc_id", "row").distinct())
    anchors = known.join(copies, ["doc_id", "row"], "left_anti").select("doc_id", "row", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor")
    suspects = cut(spread_join(anchors, shared, "anchor").groupBy("doc_id", "row").agg(F.collect_set("anchor").alias("shared")))
    windows = docs.join(suspects, ["doc_id", "row"]).mapInArrow(_suspects, "window long, doc_id long, row long, start int")
    low = windows.groupBy("window").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("window", "low")
    goes = cut(spread_join(windows, low, "window").where("doc_id > low").groupBy("doc_id", "row").agg(F.collect_set("start").alias("starts")))
    left = docs.join(goes, ["doc_id", "row"]).mapInArrow(_erase, "doc_id long, row long, n_removed long, kept_sha256 string, kept_text string")
    left = left.select("doc_id", "row", "n_removed", "kept_sha256", *(["kept_text"] if with_text else []))
    nothing = hashlib.sha256(b"").hexdigest()
    left = left.unionByName(copies.select("doc_id", "row", F.lit(None).cast("long").alias("n_removed"), F.lit(nothing).alias("kept_sha256"), *([F.lit("").alias("kept_text")] if with_text else [])))
    left = left.dropDuplicates(["doc_id", "row"]).withColumn("hit", F.lit(True))
    return outline.select("doc_id", "row", "n_words", "whole_sha256").join(left, ["doc_id", "row"], "left").select(
        "doc_id", "n_words",
        F.when(F.col("hit"), F.coalesce("n_removed", "n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"), *([F.col("row").alias("row_key"), "kept_text"] if with_text else []),
    )
