"""Operator 8: packing token sequences into windows by the minimum bin slack heuristic.

A text of n ids gives n // 1024 full windows and at most one remainder. Which remainder came from which text does not matter for the
fit, so the multiset of remainders is just 1023 counters, however large the corpus: the driver plans on those. Minimum bin slack:
take the longest remainder that is left, find by a bitset subset-sum recursion the multiset of other remainders that fills
the window closest to capacity, backtrack which counts it uses, and repeat that pattern as often as the counters allow.
Every pattern exhausts a counter (or nearly), so the plan has some thousand rows at most. In Spark each remainder gets its rank
among those of its length and takes its place in the plan.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import chunks, cut

CAPACITY = 1024
END_ID = 0
BUCKET_ROWS = 50_000
FULL_BUCKET_ROWS = 5_000  # of full pieces, which may carry 4 KB of ids each
#: Runs of white space (Unicode's) of this length and more are encoded past the pattern, whose search would backtrack through them.
LONG_RUN = 1000
_LONG_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """The tokenizer file (byte-level BPE of the `tokenizers` library) as an encoder that gives the same ids.

    The vocabulary and merges are read through `tokenizers`; encoding itself runs in tiktoken's BPE, which takes the ranks of the
    same file and is four times as fast (tests compare the ids with those of `tokenizers`, on long runs of characters, too).
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        Tokenizer.from_file(path)  # refuses a file that the library can't read
        with open(path, encoding="utf-8") as file:
            kept = json.load(file)
        before = kept["pre_tokenizer"]
        if kept["model"]["type"] != "BPE" or before["type"] != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or kept.get("normalizer"):
            raise ValueError("a plain byte-level BPE tokenizer without a prefix space is expected")
        if any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in kept.get("added_tokens", [])):
            raise ValueError("added tokens that take the white space or words around them are not expected")
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves in such files
        as_char = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        as_byte = {c: b for b, c in as_char.items()}
        special = {x["content"]: x["id"] for x in kept.get("added_tokens", [])}
        ranks = {bytes(as_byte[c] for c in token): i for token, i in kept["model"]["vocab"].items() if token not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.by_pattern = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.as_one = tiktoken.Encoding("byte_level_run", pat_str=r"(?s:.)+", mergeable_ranks=ranks, special_tokens={})
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def __call__(self, text: str) -> np.ndarray:
        """The ids of a text. A long run of white space is one piece but for its last character, which goes with what follows;
        at the end of the text or before an added token it is one piece as a whole."""
        runs = list(_LONG_RUN.finditer(text))
        if not runs:
            return self.by_pattern.encode_to_numpy(text, allowed_special="all")
        parts, at = [], 0
        for run in runs:
            start, end = run.span()
            if end < len(text) and not (self.special and self.special.match(text, end)):
                end -= 1
            parts += [self.by_pattern.encode_to_numpy(text[at:start], allowed_special="all"), self.as_one.encode_to_numpy(text[start:end], disallowed_special=())]
            at = end
        return np.concatenate([*parts, self.by_pattern.encode_to_numpy(text[at:], allowed_special="all")])


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(pattern: length -> uses, how many windows have it) until every item is placed.

    The longest item is always taken; the others are chosen so that the sum is the largest reachable within the capacity. For
    each length, binary portions of its count go into the bitset of reachable sums; the bitsets before each length allow
    backtracking, which prefers long items, so that short ones stay for later gaps.
    """
    left, plan = {k: v for k, v in counts.items() if v > 0}, []
    while left:
        longest = max(left)
        room = capacity - longest
        lengths = sorted(k for k in left if k <= room)
        mask, reach, before = (1 << (room + 1)) - 1, 1, []
        for k in lengths:
            before.append(reach)
            n, portion = min(left[k] - (k == longest), room // k), 1
            while n > 0:
                use = min(portion, n)
                reach |= (reach << (use * k)) & mask
                n, portion = n - use, portion * 2
            if reach >> room & 1:
                break  # the window is full
        best, pattern = reach.bit_length() - 1, {longest: 1}
        for k, earlier in zip(reversed(lengths[: len(before)]), reversed(before)):
            most = min(left[k] - (k == longest), best // k)
            for n in range(most, -1, -1):
                if earlier >> (best - n * k) & 1:
                    break
            if n:
                pattern[k], best = pattern.get(k, 0) + n, best - n * k
        times = min(left[k] // n for k, n in pattern.items())
        plan.append((pattern, times))
        for k, n in pattern.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def _pieces(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in chunks(batches, limit=4 << 20):
            cols: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else []))}
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encode(text), END_ID).astype("<u4") if text else np.array([END_ID], dtype="<u4")
                for a in range(0, len(ids), CAPACITY):
                    raw = ids[a : a + CAPACITY].tobytes()
                    for k, v in zip(cols, (doc, a, len(raw) // 4, zlib.crc32(raw), len(ids), raw)):
                        cols[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in cols.items()], names=list(cols))

    return run


def pack(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """documents (doc_id, text) -> one row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A text's ids are cut every 1024 ids; full pieces are sequences of their own, remainders share sequences as planned. Null or
    empty texts have the end id only. Rows are packed one by one, repeated rows too (they are interchangeable); a null doc_id stays
    null; other columns are ignored; an empty table gives an empty result. Sequences are numbered gapless from 0, `offset` is
    the place of the piece in its sequence. With `with_ids`, `ids` has the piece's ids as little-endian 32-bit integers.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if with_ids else "")
    pieces = cut(slim.mapInArrow(_pieces(path, with_ids), fields))
    key = ["length", "doc_id", "start", "ids_crc32", "doc_tokens"]
    rows = pieces.count()
    buckets = max(8, math.ceil(rows / BUCKET_ROWS))
    several = F.when(F.col("length") == CAPACITY, F.lit(max(8, math.ceil(rows / FULL_BUCKET_ROWS)))).otherwise(F.lit(buckets))
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), several).cast("int"))
    # Rank within the length: counts of small (length, bucket) groups give offsets, so that no task sees all pieces of a length.
    groups = cut(spread.groupBy("length", "bucket").agg(F.count("*").alias("n")))
    before = groups.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).select("length", "bucket", "before")
    counts = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most 1024 rows
    plan, first, taken = [], 0, {}
    for pattern, times in [({CAPACITY: 1}, counts.pop(CAPACITY, 0)), *minimum_bin_slack(counts)]:
        offset = 0
        for k, uses in sorted(pattern.items(), reverse=True):
            at = taken.get(k, 0)
            plan.append((k, at, at + uses * times, uses, first, offset))
            taken[k], offset = at + uses * times, offset + k * uses
        first += times
    # The plan is an array of intervals for each length: at most 1024 rows, some thousand intervals.
    by_length: dict[int, list] = {}
    for k, *rest in plan:
        by_length.setdefault(k, []).append(tuple(rest))
    table = spark.createDataFrame([(k, v) for k, v in by_length.items()], "length long, intervals array<struct<low: long, high: long, uses: long, sequence: long, place: long>>")
    flat = table.select("length", F.inline("intervals")).where("high > low")
    inner = Window.partitionBy("length", "bucket").orderBy(*key[1:])
    ranked = spread.withColumn("rank", F.row_number().over(inner) - 1).join(F.broadcast(before) if len(counts) * buckets + rows / FULL_BUCKET_ROWS < 200_000 else before, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("before", "bucket")
    placed = ranked.join(F.broadcast(flat), "length").where("rank >= low and rank < high")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.expr("sequence + (rank - low) div uses").alias("sequence_id"), F.expr("place + ((rank - low) % uses) * length").alias("offset"), *(["ids"] if with_ids else []),
    )
