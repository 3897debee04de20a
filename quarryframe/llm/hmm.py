"""Operator 7: a hidden Markov language model trained by distributed Baum-Welch.

Tokens are the lowered words and one end token for each text. Each state emits every word of the training texts (and one unknown
word): the expected counts by word and state are a Spark table with a row for each word. A text's score is log10 of its forward
probability.

The rounds that find the states run on classes: the `OWN_WORDS` most frequent words are classes of their own, every other word
belongs to the class of its last two bytes. A last E-step then takes the expected counts of the words themselves.

Training: word counts are summed in Spark. The states begin at the shares of all training tokens, with noise that sets them apart; each
Baum-Welch round then runs over all training texts; tasks emit expected counts, Spark sums them. Forward and backward recursions run over
whole texts, in training as in scoring: texts too long to be walked through in step with the others are cut, and what passes a cut is
computed first, from the products of the steps between cuts.

Texts are tokenised twice, to count words and to write them as numbers; all later passes read these.

Counts of single words by state reach the texts in two ways: the most frequent words (at most `HEAVY_WORDS`) travel with the code, a fixed
bound; all others are joined on the word's 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import Words, chunks, cut, free, ranges, tidy

STATES = 8
OWN_WORDS = 4095
ENDINGS = 1024
CLASSES = 1 + OWN_WORDS + ENDINGS  # class 0: end of text
HEAVY_WORDS = 1 << 18
ROUNDS = 5
WHOLE = 1024  # longer sequences are walked through in segments
SEGMENT = 512
STEP_TOKENS = 400_000  # that are walked through in step
SMOOTHING = 50.0
_END = np.uint64(0x1D8AF066)
_S = [f"s{s}" for s in range(STATES)]
_ONES = np.ones(STATES, np.float32)  # x @ _ONES is x.sum(axis=1), several times as fast


def ending_classes(words: Words) -> np.ndarray:
    """The class of each word by its last two bytes, lowered."""
    data = words.data
    last, before = data[words.ends - 1].astype(np.uint32), np.where(words.ends - words.starts > 1, data[np.maximum(words.ends - 2, 0)], 0).astype(np.uint32)
    last, before = (np.where((x >= 0x41) & (x <= 0x5A), x + 32, x) for x in (last, before))
    return (1 + OWN_WORDS + ((last * np.uint32(0x9E3779B1) ^ before * np.uint32(0x85EBCA77)) >> np.uint32(13)) % np.uint32(ENDINGS)).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, ending class, count), summed over some millions of tokens at a time."""
    held, size = [], 0

    def flush():
        h, c = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
        word, at, n = np.unique(h, return_index=True, return_counts=True)
        for a in range(0, len(word), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(word[a : a + 200_000].view(np.int64)), pa.array(c[at][a : a + 200_000]), pa.array(n[a : a + 200_000].astype(np.int64))], names=["word", "ending", "n"])

    for batch in chunks(batches):
        words = Words(batch.column("text"))
        held.append((np.append(words.hashes(lower=True), np.full(batch.num_rows, _END)), np.append(ending_classes(words), np.zeros(batch.num_rows, np.int32))))
        size += len(held[-1][0])
        if size > 3_000_000:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


@dataclass
class Vocabulary:
    """What a task needs: the heavy words with counts and classes, sorted by hash; totals; each class's weight."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray  # a class of its own, or that of its ending
    total: int
    ends: int
    distinct: int
    class_share: np.ndarray  # of the training tokens


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """Totals and heavy words of a count table (word, ending, n); also the least count of a heavy word."""
    totals = {r.ending: (r.n, r.v) for r in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}  # at most CLASSES rows
    total, distinct = sum(x[0] for x in totals.values()), sum(x[1] for x in totals.values())
    floor, seen = 1, 0
    for n, words in sorted(((r.n, r.v) for r in counts.groupBy("n").agg(F.count("*").alias("v")).toLocalIterator()), reverse=True):
        if seen + words > HEAVY_WORDS:
            floor = n + 1
            break
        seen += words
    heavy = counts.where((F.col("n") >= floor) & (F.col("ending") > 0)).toArrow()
    word = heavy.column("word").to_numpy().view(np.uint64) if heavy.num_rows else np.empty(0, np.uint64)
    n = heavy.column("n").to_numpy() if heavy.num_rows else np.empty(0, np.int64)
    ending = heavy.column("ending").to_numpy() if heavy.num_rows else np.empty(0, np.int32)
    own = np.zeros(len(word), np.int32)
    top = np.lexsort((word, -n))[:OWN_WORDS]
    own[top] = np.arange(1, len(top) + 1)
    class_n = np.zeros(CLASSES)
    for k, (a, _) in totals.items():
        class_n[k] = a
    np.subtract.at(class_n, ending[top], n[top])
    class_n[own[top]] = n[top]
    order = np.argsort(word)
    return Vocabulary(word[order], n[order], np.where(own > 0, own, ending)[order].astype(np.int32), int(total), int(totals.get(0, (0, 0))[0]), int(distinct), (class_n + 1) / (class_n + 1).sum()), floor


ENCODED = "doc_id long, held_out boolean, row long, ids binary, rare array<long>, endings binary"


def _encoded(vocab: Vocabulary):
    """Texts, tokenised once for all later passes: `ids` has an int32 for each word, the place of a heavy word or -1 - k for the k-th
    of the row's own other words, whose hashes are in `rare` (sorted, distinct) and ending classes in `endings` (uint16)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            h, counts = words.hashes(lower=True), words.counts
            at = np.minimum(np.searchsorted(vocab.words, h), max(len(vocab.words) - 1, 0))
            other = np.flatnonzero(vocab.words[at] != h) if len(vocab.words) else np.arange(len(h))
            row = np.repeat(np.arange(batch.num_rows), counts)[other]
            order = np.lexsort((h[other].view(np.int64), row))
            place, row = other[order], row[order]
            fresh = np.ones(len(place), dtype=bool)
            fresh[1:] = (h[place[1:]] != h[place[:-1]]) | (row[1:] != row[:-1])
            bounds = np.searchsorted(row[fresh], np.arange(batch.num_rows + 1)).astype(np.int32)
            ids = at.astype("<i4")
            ids[place] = -np.cumsum(fresh) + bounds[row]
            endings = ending_classes(words)[place[fresh]].astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), batch.column("row"), _binary(ids, words.bounds),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(h[place[fresh]].view(np.int64))), _binary(endings, bounds),
                ],
                names=[x.split()[0] for x in ENCODED.split(", ")],
            )

    return run


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary for each row: values[bounds[i]:bounds[i + 1]]."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((np.asarray(bounds) * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _values(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's values laid one after another, and how many each row has."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), kind), np.diff(offsets) // size


@dataclass
class Encoded:
    """The rows of a slice of the encoded table; each row's end token is its last."""

    ids: np.ndarray  # place of a heavy word, or -1
    other: np.ndarray  # of the words that are not heavy: which of `rare` each is, in the order of the places
    lengths: np.ndarray
    rare: np.ndarray | None  # hashes, row by row, if the slice has them
    endings: np.ndarray
    several: np.ndarray  # how many words of its own each row has
    is_word: np.ndarray
    batch: pa.RecordBatch

    @classmethod
    def parts(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[Encoded]:
        for batch in chunks(batches, column="ids", limit=4 * STEP_TOKENS):
            inner, counts = _values(batch.column("ids"), "<i4")
            endings, several = _values(batch.column("endings"), "<u2")
            row = np.repeat(np.arange(batch.num_rows), counts)
            is_word = np.zeros(len(inner) + batch.num_rows, dtype=bool)
            is_word[np.arange(len(inner)) + row] = True
            ids = np.full(len(is_word), -1, np.int32)
            ids[is_word] = np.maximum(inner, -1)
            low = inner < 0
            other = (np.cumsum(several) - several)[row[low]] - 1 - inner[low]
            rare = batch.column("rare").flatten().to_numpy(zero_copy_only=False).view(np.uint64) if "rare" in batch.schema.names else None
            yield cls(ids, other, counts + 1, rare, endings, several, is_word, batch)

    def classes(self, vocab: Vocabulary) -> np.ndarray:
        out = vocab.classes[self.ids] if len(vocab.classes) else np.zeros(len(self.ids), np.int32)
        out[~self.is_word] = 0
        out[self.is_word & (self.ids < 0)] = self.endings[self.other]
        return out


@dataclass
class Model:
    start: np.ndarray  # at a text's first token
    move: np.ndarray
    emit: np.ndarray  # classes x states

    @classmethod
    def first(cls, share: np.ndarray, seed: int = 11) -> Model:
        draw = np.random.default_rng(seed)
        emit = share[:, None] * draw.uniform(0.5, 1.5, (CLASSES, STATES))
        even = np.full(STATES, 1 / STATES)
        return cls(even, np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES), emit / emit.sum(axis=0))

    def update(self, expected: np.ndarray, share: np.ndarray) -> Model:
        """M-step. expected: rows 0..CLASSES-1 emissions, then STATES rows of moves, then starts."""
        emit, move, start = np.split(expected, [CLASSES, CLASSES + STATES])
        occupied = emit.sum(axis=0)
        emit = (emit + SMOOTHING * share[:, None]) / (occupied + SMOOTHING)
        move, start = move + 0.1, start[0] + 0.1
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit)


def _packed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of sequences by falling length, and how many are still running at each time."""
    order = np.argsort(-lengths, kind="stable")
    return order, np.searchsorted(-lengths[order], -np.arange(lengths.max() if len(lengths) else 0), side="left")


@dataclass
class Segments:
    """Sequences laid one after another; those longer than `WHOLE` are cut, so that all parts can be walked through in step.

    enter: the states' distribution before a segment's first token, given all tokens before; leave: the likelihood, up to a
    factor, of all tokens behind its last one, by state. Both are exact: they come from the products of the steps inside the
    segments (`_carry`), so a cut changes no result.
    """

    lengths: np.ndarray
    row: np.ndarray
    first: np.ndarray  # begins its sequence
    enter: np.ndarray
    leave: np.ndarray | None

    @classmethod
    def of(cls, model: Model, flat: np.ndarray, lengths: np.ndarray, backward: bool) -> Segments:
        parts = np.where(lengths > WHOLE, -(-lengths // SEGMENT), 1)
        row, ends = np.repeat(np.arange(len(lengths)), parts), np.cumsum(parts)
        sizes = np.where(parts[row] > 1, SEGMENT, lengths[row])
        sizes[ends - 1] = lengths - np.where(parts > 1, (parts - 1) * SEGMENT, 0)
        first = np.zeros(len(row), dtype=bool)
        first[ends - parts] = True
        enter = np.tile(model.start, (len(row), 1))
        out = cls(sizes, row, first, enter, np.ones_like(enter) if backward else None)
        cut_rows = np.flatnonzero(parts > 1)
        if len(cut_rows):
            out._carry(model, flat, (ends - parts)[cut_rows], parts[cut_rows])
        return out

    def _carry(self, model: Model, flat: np.ndarray, begin: np.ndarray, parts: np.ndarray) -> None:
        """Fill `enter` and `leave` of the segments of cut sequences, which begin at `begin` and have `parts` segments each."""
        own = ranges(begin, parts)
        order, running = _packed(self.lengths[own])
        at = (np.cumsum(self.lengths) - self.lengths)[own][order]
        step = np.zeros((len(own), STATES, STATES))
        for t, n in enumerate(running):
            emit = model.emit[flat[at[:n] + t]][:, None, :]
            if t == 0:
                step[:] = np.eye(STATES) * emit
            else:
                np.multiply((step[:n].reshape(-1, STATES) @ model.move).reshape(n, STATES, STATES), emit, out=step[:n])
            if t % 16 == 15:
                step[:n] /= step[:n].sum(axis=(1, 2), keepdims=True)
        place = np.empty(len(self.lengths), np.int64)
        place[own[order]] = np.arange(len(own))
        for k in range(int(parts.max()) - 1):
            now = begin[parts > k + 1] + k
            end = np.einsum("ni,nij->nj", self.enter[now], step[place[now]])
            self.enter[now + 1] = end / end.sum(axis=1, keepdims=True) @ model.move
        if self.leave is not None:
            for k in range(int(parts.max()) - 1, 0, -1):
                now = begin[parts > k] + k
                ahead = np.einsum("nij,nj->ni", step[place[now]], self.leave[now])
                self.leave[now - 1] = ahead / ahead.sum(axis=1, keepdims=True) @ model.move.T


def log10_likelihoods(model: Model, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Scaled forward recursion over whole class sequences (laid one after another in `flat`), all sequences in step."""
    parts = Segments.of(model, flat, lengths, backward=False)
    order, running = _packed(parts.lengths)
    at, out = (np.cumsum(parts.lengths) - parts.lengths)[order], np.zeros(len(order))
    state = None
    for t, n in enumerate(running):
        state = (parts.enter[order] if t == 0 else state[:n] @ model.move) * model.emit[flat[at[:n] + t]]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        out[:n] += np.log10(scale)
    return np.bincount(parts.row[order], weights=out, minlength=len(lengths))


def expected_counts(model: Model, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """E-step: rows as `Model.update` takes them."""
    out = np.zeros((CLASSES + STATES + 1, STATES))
    if not len(lengths):
        return out
    place, share, moves, start = posteriors(model, flat, lengths)
    at = flat[place]
    for s in range(STATES):
        out[:CLASSES, s] = np.bincount(at, weights=share[:, s], minlength=CLASSES)
    out[CLASSES : CLASSES + STATES], out[-1] = moves, start
    return out


def posteriors(model: Model, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward recursion over whole sequences: places in `flat`, the shares of the states there, the expected moves and
    starts."""
    parts = Segments.of(model, flat, lengths, backward=True)
    order, running = _packed(parts.lengths)
    at = (np.cumsum(parts.lengths) - parts.lengths)[order]
    enter, leave = parts.enter[order].astype(np.float32), parts.leave[order].astype(np.float32)
    move = model.move.astype(np.float32)  # shares need no more digits, and all steps are scaled
    offsets = np.concatenate(([0], np.cumsum(running)))
    place = np.concatenate([at[:n] + t for t, n in enumerate(running)])
    emit = model.emit.astype(np.float32)[flat[place]]
    alpha, scales = np.empty_like(emit), np.empty(len(place), np.float32)
    for t, n in enumerate(running):
        a, b = offsets[t], offsets[t] + n
        now = np.multiply(enter if t == 0 else alpha[offsets[t - 1] : offsets[t - 1] + n] @ move, emit[a:b], out=alpha[a:b])
        scales[a:b] = now @ _ONES
        now /= scales[a:b, None]
    emit /= scales[:, None]  # from here on with the scale, as the backward pass needs it
    moves, later, ends, back = np.zeros((STATES, STATES)), np.empty((0, STATES), np.float32), np.empty_like(enter), np.ascontiguousarray(move.T)
    for t in range(len(running) - 1, -1, -1):
        a, n, m = offsets[t], running[t], len(later)
        ends[m:n] = alpha[a + m : a + n]
        beta = np.empty((n, STATES), np.float32)
        beta[m:] = leave[m:n] / (ends[m:n] * leave[m:n]).sum(axis=1, keepdims=True)
        if m:
            moves += alpha[a : a + m].T @ later
            np.matmul(later, back, out=beta[:m])
        later = np.multiply(emit[a : a + n], beta, out=emit[a : a + n])
        alpha[a : a + n] *= beta
    # Moves from a segment's last token to the first one of the next.
    where = np.empty(len(order), np.int64)
    where[order] = np.arange(len(order))
    follows = np.flatnonzero(~parts.first)
    moves += ends[where[follows - 1]].T @ later[where[follows]]
    alpha /= (alpha @ _ONES)[:, None]
    return place, alpha, moves * model.move, alpha[: len(order)][parts.first[order]].sum(axis=0)


def _expect(model: Model, vocab: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES + STATES + 1, STATES))
        for part in Encoded.parts(batches):
            total += expected_counts(model, part.classes(vocab), part.lengths)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), *[pa.array(total[:, s]) for s in range(STATES)]], names=["at", *[f"s{s}" for s in range(STATES)]])

    return run


def train(learn: DataFrame, vocab: Vocabulary) -> Model:
    """Baum-Welch over encoded rows: ROUNDS rounds, each of them over all rows."""
    model = Model.first(vocab.class_share)
    if learn.isEmpty():
        return model
    for _ in range(ROUNDS):
        rows = learn.mapInArrow(_expect(model, vocab), "at int, " + ", ".join(f"{x} double" for x in _S)).groupBy("at").agg(*[F.sum(x).alias(x) for x in _S]).collect()
        total = np.zeros((CLASSES + STATES + 1, STATES))
        for r in rows:
            total[r.at] = [r[x] for x in _S]
        model = model.update(total, vocab.class_share)
    return model


def _expect_words(model: Model, vocab: Vocabulary):
    """(word, expected count in each state): heavy words once for each task, the others summed over half a million of them at a time."""

    def batches_of(word: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(word), 100_000):
            b = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(word[b].view(np.int64)), *[pa.array(sums[b, s].astype(np.float32)) for s in range(STATES)]], names=["word", *_S])

    def rare(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        h, shares = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
        word, which = np.unique(h, return_inverse=True)
        yield from batches_of(word, np.stack([np.bincount(which, weights=shares[:, s], minlength=len(word)) for s in range(STATES)], axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        sums = np.zeros((len(vocab.words), STATES))
        for part in Encoded.parts(batches):
            place, shares, _, _ = posteriors(model, part.classes(vocab), part.lengths)
            hashes = np.full(len(part.ids), _END)
            hashes[part.is_word & (part.ids < 0)] = part.rare[part.other]
            index, hashes = part.ids[place], hashes[place]
            heavy = index >= 0
            index, own = index[heavy], shares[heavy]
            for s in range(STATES):
                sums[:, s] += np.bincount(index, weights=own[:, s], minlength=len(sums))
            held.append((hashes[~heavy], shares[~heavy]))
            size += len(held[-1][0])
            if size > 500_000:
                yield from rare(held)
                held, size = [], 0
        if held:
            yield from rare(held)
        some = np.flatnonzero(sums.any(axis=1))
        yield from batches_of(vocab.words[some], sums[some])

    return run


def expected_words(learn: DataFrame, model: Model, vocab: Vocabulary) -> DataFrame:
    """One row for each word of the training texts (and the end token): word, its expected count in each state; they add up to the
    word's count."""
    parts = learn.mapInArrow(_expect_words(model, vocab), "word long, " + ", ".join(f"{x} float" for x in _S))
    return parts.groupBy("word").agg(*[F.sum(x).cast("float").alias(x) for x in _S])


@dataclass
class Emission:
    """P(word | state) = (E + a + S p) / (o (N + V + 1) / N + S) with E the expected count, o the state's, a = o / N, p the
    add-one unigram share. Over all words and one unknown it sums to 1; where the states do not differ it is the unigram.
    """

    occupied: np.ndarray
    total: int
    distinct: int

    def __call__(self, n: np.ndarray, expected: np.ndarray) -> np.ndarray:
        whole = self.total + self.distinct + 1
        share = self.occupied / max(self.total, 1) if self.total else np.full(STATES, 1 / STATES)
        return (expected + share + SMOOTHING * ((n + 1) / whole)[:, None]) / (share * whole + SMOOTHING)


def _score(model: Model, vocab: Vocabulary, emission: Emission, heavy: np.ndarray, end: np.ndarray):
    """heavy: expected counts of the heavy words; end: those of the end token."""
    whole = math.log10(vocab.total + vocab.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in Encoded.parts(batches):
            n, expected = np.zeros(len(part.ids), np.int64), np.zeros((len(part.ids), STATES), np.float32)
            is_heavy, is_rare = part.ids >= 0, part.is_word & (part.ids < 0)
            n[is_heavy], expected[is_heavy] = vocab.counts[part.ids[is_heavy]], heavy[part.ids[is_heavy]]
            n[~part.is_word], expected[~part.is_word] = vocab.ends, end
            known = part.batch.column("known")
            entries = known.flatten()
            if len(entries):
                row = np.repeat(np.arange(len(known)), known.value_lengths().to_numpy())
                shares = np.zeros((len(part.endings), STATES), np.float32)
                shares[(np.cumsum(part.several) - part.several)[row] + entries.field("at").to_numpy()] = _values(entries.field("shares"), "<f4")[0].reshape(-1, STATES)
                n[is_rare], expected[is_rare] = np.rint(shares.sum(axis=1, dtype=np.float64)).astype(np.int64)[part.other], shares[part.other]
            score = log10_likelihoods(Model(model.start, model.move, emission(n, expected)), np.arange(len(n)), part.lengths)
            row = np.repeat(np.arange(len(part.lengths)), part.lengths)
            base = np.bincount(row, weights=np.log10(n + 1.0)) - part.lengths * whole
            known = np.bincount(row, weights=n > 0).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.batch.column("doc_id"), part.batch.column("held_out"), pa.array(part.lengths.astype(np.int64)), pa.array(known), pa.array(np.full(len(known), vocab.total, np.int64)), pa.array(base), pa.array(score)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def _in_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, and its expected counts in one binary of float32: half of what they take in a row as columns."""
    for batch in batches:
        shares = np.stack([batch.column(x).to_numpy() for x in _S], axis=1).astype("<f4")
        yield pa.RecordBatch.from_arrays([batch.column("word"), _binary(shares.ravel(), np.arange(batch.num_rows + 1) * STATES)], names=["word", "shares"])


def fit(slim: DataFrame) -> tuple[Vocabulary, int, Model, DataFrame, DataFrame]:
    """Vocabulary, least count of a heavy word, start and moves, the table of all words' expected counts, and the encoded rows."""
    counts = cut(slim.where("not held_out").select("text").mapInArrow(_count, "word long, ending int, n long").groupBy("word", "ending").agg(F.sum("n").alias("n")))
    vocab, floor = vocabulary(counts)
    free(counts)
    encoded = cut(slim.mapInArrow(_encoded(vocab), ENCODED))
    learn = encoded.where("not held_out")
    model = train(learn, vocab)
    expected = cut(expected_words(learn, model, vocab))
    return vocab, floor, model, expected, encoded


def lm_scores(docs: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(doc_id as text) mod 7 is not 2 (null doc_id: held out). A null or empty text is one end token.
    base_score: add-one unigram, the sum of log10((c + 1) / (N + V + 1)). score: the model's log10 probability of the whole text.
    Rows are scored one by one, so repeated rows get equal scores; other columns are ignored; an empty table gives an empty result.
    """
    slim = prepared(docs)
    vocab, floor, model, expected, encoded = fit(slim)
    end_word = int(np.array(_END).view(np.int64))
    occupied = np.array([x or 0.0 for x in expected.agg(*[F.sum(F.col(x).cast("double")) for x in _S]).first()])
    end = expected.where(F.col("word") == end_word).first()
    end = np.array([end[x] for x in _S]) if end else np.zeros(STATES)
    often = expected.where(sum(F.col(x).cast("double") for x in _S) > 0.99 * floor).toArrow()  # the heavy words, and some more by rounding
    heavy = np.zeros((len(vocab.words), STATES), np.float32)
    if often.num_rows and len(heavy):
        word = often.column("word").to_numpy().view(np.uint64)
        at = np.minimum(np.searchsorted(vocab.words, word), len(heavy) - 1)
        there = vocab.words[at] == word
        heavy[at[there]] = np.stack([often.column(x).to_numpy() for x in _S], axis=1)[there]
    tidy(docs.sparkSession)
    # A row's own words leave with their places in it and come back with these, so their hashes make one way only.
    rare = encoded.select("row", F.posexplode("rare").alias("at", "word"))
    found = rare.join(expected.mapInArrow(_in_one, "word long, shares binary"), "word")
    known = found.groupBy("row").agg(F.collect_set(F.struct("at", "shares")).alias("known"))
    rows = encoded.drop("rare").join(known, "row", "left").select("doc_id", "held_out", "ids", "endings", F.coalesce("known", F.array().cast(known.schema["known"].dataType)).alias("known"))
    score = _score(model, vocab, Emission(occupied, vocab.total, vocab.distinct), heavy, end)
    return rows.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, text, and row: a row's key in the join of rare words, shared by equal rows."""
    held = F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(7)) == 2, F.lit(True))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return slim.select("doc_id", held.alias("held_out"), "text", F.xxhash64("doc_id", "text").alias("row"))
