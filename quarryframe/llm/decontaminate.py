"""Operator 10: benchmark decontamination by a BM25 index of test items, searched with block-max WAND.

The test items are indexed; every passage of every training text is a query. A passage's score for an item is BM25, as a share of
the score that the item's own text would get; all items with at least `LEAST_SCORE` are retrieved. As in block-max WAND, upper
bounds decide what is looked at, in batches of passages: the sum of the terms' largest impacts over all items discards most passages,
the sum of their largest impacts inside a block of items discards most blocks, and only what is left is scored. Both bounds are
never below the score, so nothing above the threshold is lost. A hit is confirmed if the 3-word runs of the item's question
and of its answer both occur in the passage for the most part.

Items are indexed by classes of length, the powers of two from `LEAST_STRIDE` on. A class's passages are two strides long, a stride
being the class's length, and begin at every stride, so an item's whole text lies in at least one of them; how long the passages are
in which an item is looked for thus depends on that item alone. Indexes of about `INDEX_WORDS` words of items travel with the code;
larger benchmarks are searched in as many passes, which changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import Words, chunks, cut, ranges

INDEX_WORDS = 2_000_000
BLOCK = 16
K1, B = 1.2, 0.75
LEAST_SCORE = 0.6
LEAST_OVERLAP = 0.6
RUN = 3
LEAST_STRIDE = 64
_HITS = "doc_id long, item_id long, passages long, score double, question_overlap double, answer_overlap double"


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's parts: the last line is the answer; of a single line the last sentence; else the last third of the words."""
    text = text.strip()
    for cut_at in (text.rfind("\n"), max((m.end() for m in re.finditer(r"[.?!:;](?=\s+\S)", text)), default=-1)):
        if cut_at > 0 and re.search(r"\w", text[:cut_at]) and re.search(r"\w", text[cut_at:]):
            return text[:cut_at], text[cut_at:]
    words = text.split()
    at = max(1, len(words) - max(1, len(words) // 3))
    return " ".join(words[:at]), " ".join(words[at:])


def _runs(h: np.ndarray, size: int = RUN) -> np.ndarray:
    size = min(size, len(h))
    if not size:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - size + 1, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - size + 1 + j]
    return out


class Index:
    """Impacts of terms in items, as arrays sorted by term: for each term its postings (item, impact) and blocks (block, largest).

    All items have at most `stride` words.
    """

    def __init__(self, ids: list[int], texts: list[str], frequency: dict[int, int], items: int, mean_length: float, stride: int):
        parts = [question_and_answer(t.lower()) for t in texts]
        words = Words(pa.array([p for pair in parts for p in pair], pa.string()), letters_only=True)
        h, bounds = words.hashes(lower=False), words.bounds
        self.ids, self.stride = np.array(ids, dtype=np.int64), stride
        self.parts = []
        term, item, impact = [], [], []
        for i in range(len(ids)):
            own = h[bounds[2 * i] : bounds[2 * i + 2]]
            self.parts.append((h[bounds[2 * i] : bounds[2 * i + 1]], h[bounds[2 * i + 1] : bounds[2 * i + 2]]))
            t, tf = np.unique(own, return_counts=True)
            df = np.array([frequency[x] for x in t.view(np.int64).tolist()])
            weight = np.log1p((items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / mean_length))
            term.append(t), item.append(np.full(len(t), i)), impact.append(weight / max(weight.sum(), 1e-12))
        term, item, impact = np.concatenate(term), np.concatenate(item), np.concatenate(impact)
        order = np.lexsort((item, term))
        term, self.item, self.impact = term[order], item[order], impact[order]
        self.terms, first = np.unique(term, return_index=True)
        self.postings = np.append(first, len(term))
        self.most = np.maximum.reduceat(self.impact, first) if len(term) else np.empty(0)
        block = self.item // BLOCK
        new = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (term[1:] != term[:-1])))) if len(term) else np.empty(0, np.int64)
        self.block, self.block_most = block[new], np.maximum.reduceat(self.impact, new) if len(term) else np.empty(0)
        self.blocks = np.append(np.searchsorted(new, first), len(new))
        self.n_blocks = int(-(-len(ids) // BLOCK))

    def hits(self, words: Words, h: np.ndarray) -> list[tuple[int, int, int, float, float, float]]:
        """(row, item, passages, best score, overlaps there) of the rows of one chunk."""
        bounds, counts, stride = words.bounds, words.counts, self.stride
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        place = np.flatnonzero(self.terms[at] == h)  # words that some item has
        if not len(place):
            return []
        term = at[place]
        row = np.searchsorted(bounds, place, side="right") - 1
        strides = -(-counts // stride)
        first_stride = np.concatenate(([0], np.cumsum(strides)))
        inside = place - bounds[row]
        stride_of = first_stride[row] + inside // stride
        # A term counts once in a passage (a stride and the next one): as part of its first half if it wasn't seen in this stride
        # before, as part of its second half if neither in this one nor in the one before.
        order = np.lexsort((place, term, row))
        same = np.zeros(len(place), dtype=bool)
        same[order[1:]] = (term[order[1:]] == term[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        last = np.full(len(place), -(1 << 40))
        last[order[1:]] = np.where(same[order[1:]], inside[order[:-1]], -(1 << 40))
        begin = inside // stride * stride
        as_first, as_second = last < begin, last < begin - stride
        total = int(first_stride[-1])
        bound = np.bincount(stride_of, weights=np.where(as_first, self.most[term], 0), minlength=total)
        second = np.bincount(stride_of, weights=np.where(as_second, self.most[term], 0), minlength=total)
        ends = np.zeros(total + 1, dtype=bool)
        ends[first_stride] = True
        follows = ~ends[1 : total + 1]  # the next stride is of the same row
        follows[-1:] = False
        bound[:-1] += np.where(follows[:-1], second[1:], 0)
        alive = np.flatnonzero(bound >= LEAST_SCORE - 1e-9)
        if not len(alive):
            return []
        found: dict[tuple[int, int], list] = {}
        edge = np.searchsorted(stride_of, np.arange(total + 1))
        for low in range(0, len(alive), 4096):
            self._score(alive[low : low + 4096], edge, term, as_first, as_second, follows, first_stride, bounds, h, found)
        return [(r, i, *v) for (r, i), v in found.items()]

    def _score(self, alive, edge, term, as_first, as_second, follows, first_stride, bounds, h, found) -> None:
        one = ranges(edge[alive], edge[alive + 1] - edge[alive])
        who = np.repeat(np.arange(len(alive)), edge[alive + 1] - edge[alive])
        after = np.flatnonzero(follows[alive])
        n = edge[alive[after] + 2] - edge[alive[after] + 1] if len(after) else np.empty(0, np.int64)
        two, who_two = ranges(edge[alive[after] + 1] if len(after) else n, n), np.repeat(after, n)
        keep, keep_two = as_first[one], as_second[two]
        passage, terms = np.concatenate((who[keep], who_two[keep_two])), np.concatenate((term[one[keep]], term[two[keep_two]]))
        # Block bounds, then exact scores inside the blocks that may reach the threshold.
        n = self.blocks[terms + 1] - self.blocks[terms]
        entry, who = ranges(self.blocks[terms], n), np.repeat(passage, n)
        key = who * self.n_blocks + self.block[entry]
        keys, back = np.unique(key, return_inverse=True)
        open_keys = keys[np.bincount(back, weights=self.block_most[entry]) >= LEAST_SCORE - 1e-9]
        if not len(open_keys):
            return
        some = np.isin(passage, open_keys // self.n_blocks)
        passage, terms = passage[some], terms[some]
        n = self.postings[terms + 1] - self.postings[terms]
        entry, who = ranges(self.postings[terms], n), np.repeat(passage, n)
        live = np.isin(who * self.n_blocks + self.item[entry] // BLOCK, open_keys)
        entry, who = entry[live], who[live]
        keys, back = np.unique(who * len(self.ids) + self.item[entry], return_inverse=True)
        scores = np.bincount(back, weights=self.impact[entry])
        for k, score in zip(keys[scores >= LEAST_SCORE], scores[scores >= LEAST_SCORE]):
            p, i = int(alive[k // len(self.ids)]), int(k % len(self.ids))
            r = int(np.searchsorted(first_stride, p, side="right")) - 1
            start = bounds[r] + (p - first_stride[r]) * self.stride
            passage_words = h[start : min(start + 2 * self.stride, bounds[r + 1])]
            q, a = (float(np.isin(runs, _runs(passage_words, len(part))).mean()) if len(part) < RUN and len(part) else float(np.isin(runs, _runs(passage_words)).mean()) if len(part) else 1.0 for part in self.parts[i] for runs in [_runs(part)])
            if q >= LEAST_OVERLAP and a >= LEAST_OVERLAP:
                best = found.setdefault((r, i), [0, 0.0, 0.0, 0.0])
                best[0] += 1
                if (score, q, a) > tuple(best[1:]):
                    best[1:] = float(score), q, a


def stride_of(words: int) -> int:
    """The length class of an item: the power of two that holds it."""
    return max(LEAST_STRIDE, 1 << max(words - 1, 0).bit_length())


def _search(indexes: list[Index]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column("text"), letters_only=True)
            h, ids = words.hashes(lower=False), batch.column("doc_id").to_pylist()
            for index in indexes:
                hits = index.hits(words, h)
                cols = list(zip(*hits)) if hits else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[r] for r in cols[0]], pa.int64()), pa.array([int(index.ids[i]) for i in cols[1]], pa.int64()), pa.array(cols[2], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[3:]]],
                    names=[x.split()[0] for x in _HITS.split(", ")],
                )

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        words = Words(batch.column("text"), letters_only=True)
        h = words.hashes(lower=False)
        sets = [np.unique(h[a:b]).view(np.int64) for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(words.counts.astype(np.int64)), pa.array(sets, pa.list_(pa.int64()))], names=["item_id", "length", "terms"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents (doc_id, text), benchmark (item_id, text) -> one row for each document and item found in it: doc_id, item_id,
    passages (that hold it), score (best share of the item's own BM25 score), question_overlap, answer_overlap.

    Words are runs of letters, digits and non-ASCII characters, lowered. Null or empty texts and items without words match nothing;
    rows are searched one by one, so repeated rows give repeated results; repeated items count each, a null item_id is given as -1; other columns are ignored; an
    empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    lowered = items.select("item_id", F.lower("text").alias("text")).mapInArrow(_terms, "item_id long, length long, terms array<long>").where("length > 0")
    lowered = cut(lowered)
    n, mean, words = lowered.agg(F.count("*"), F.avg("length"), F.sum("length")).first()
    frequency = lowered.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    passes = max(1, -(-(words or 0) // INDEX_WORDS))
    found = None
    for k in range(passes if n else 0):
        share = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        own = share.select("item_id", F.lower("text").alias("text")).mapInArrow(_terms, "item_id long, length long, terms array<long>").select(F.explode("terms").alias("term")).distinct()
        df = {r.term: r.df for r in own.join(frequency, "term").collect()}  # of about INDEX_WORDS words
        classes: dict[int, list] = {}
        for r in share.collect():  # about INDEX_WORDS words
            length = int(Words(pa.array([" ".join(question_and_answer(r.text.lower()))]), letters_only=True).counts[0])
            if length:
                classes.setdefault(stride_of(length), []).append((r.item_id if r.item_id is not None else -1, r.text))
        indexes = [Index([r[0] for r in sorted(rows)], [r[1] for r in sorted(rows)], df, n, mean, stride) for stride, rows in sorted(classes.items())]
        if indexes:
            hits = slim.mapInArrow(_search(indexes), _HITS)
            found = hits if found is None else found.unionByName(hits)
    return found if found is not None else spark.createDataFrame([], _HITS)
