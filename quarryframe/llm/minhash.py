"""Operator 1: near-duplicate documents by min-max hashing.

One multiplication of a shingle's hash stands for one permutation, and both the smallest and the largest value under it are
kept (Ji et al., min-max hash): half the evaluations for a signature whose estimate is unbiased and varies less. Bands of the
signature propose candidates, a byte of each signature entry (b-bit minwise hashing) drops unlikely pairs, and every link is
confirmed on the full shingle sets.

How it scales: documents with equal shingle sets are collapsed first, so exact copies (however many) cost one row each.
In a band bucket each document is tied to the bucket's smallest id only: no pairs of a bucket are emitted. Components
of these ties are candidate groups; a group's texts meet in one task, or, if they have more than `GROUP_SHINGLES` shingles, in
tasks for each pair of blocks, so a task's memory is bounded and no pair of a group is left out. Inside a task pairs meet by the
positional prefix filter, so pages that share a template but are no duplicates are not compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .textkit import Words, chunks, cut, mix, ranges

SHINGLE = 5
PERMUTATIONS = 128  # 256 signature entries
ROWS = 5  # in a band: 51 bands miss a pair of similarity 0.75 with probability 1e-6
BANDS = 2 * PERMUTATIONS // ROWS
LEAST_MATCHES = 0.60  # of 256 entries: 0.75 less 5.5 standard deviations
GROUP_SHINGLES = 1_000_000  # that meet in one task at a time, each block
FEW = 24  # documents that are tried pair by pair
HUBS = 16  # documents of a larger group that all others are tried against first

_FACTORS = np.random.default_rng(75).integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(5).integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = np.random.default_rng(51).integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Entries of the signature (minima, then maxima) in a fixed shuffled order, so that a band mixes both kinds.
_BAND_ORDER = np.random.default_rng(7).permutation(2 * PERMUTATIONS)[: BANDS * ROWS]


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): row i has the distinct shingle hashes hashes[bounds[i]:bounds[i+1]], sorted."""
    words = Words(column)
    h, counts = words.hashes(lower=True), words.counts
    k = SHINGLE
    if len(h) >= k:
        rolled = np.zeros(len(h) - k + 1, dtype=np.uint64)
        for j in range(k):
            rolled += h[j : len(h) - k + 1 + j] * _PLACES[j]
        rolled = mix(rolled)
    else:
        rolled = np.empty(0, np.uint64)
    full = np.maximum(counts - k + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < k))
    total = full.copy()
    total[short] = 1
    bounds = np.concatenate(([0], np.cumsum(total)))
    taken = np.empty(bounds[-1], dtype=np.uint64)
    taken[ranges(bounds[:-1], full)] = rolled[ranges(words.bounds[:-1], full)]
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            whole[has] += h[words.bounds[short[has]] + j] * _PLACES[j]
        taken[bounds[short]] = mix(whole ^ (counts[short].astype(np.uint64) << np.uint64(56)))
    for start, stop in zip(bounds[:-1], bounds[1:]):
        taken[start:stop].sort()
    fresh = np.ones(len(taken), dtype=bool)
    fresh[1:] = taken[1:] != taken[:-1]
    fresh[bounds[:-1][total > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return taken[fresh], kept[bounds]


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima and maxima under each permutation, as uint64, for rows that have at least one shingle."""
    starts = bounds[:-1]
    out = np.empty((len(starts), 2 * PERMUTATIONS), dtype=np.uint64)
    buffer = np.empty_like(hashes)
    for k, factor in enumerate(_FACTORS):
        np.multiply(hashes, factor, out=buffer)
        np.minimum.reduceat(buffer, starts, out=out[:, k])
        np.maximum.reduceat(buffer, starts, out=out[:, PERMUTATIONS + k])
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        hashes, bounds = shingle_sets(batch.column("text"))
        sizes = np.diff(bounds)
        some = np.flatnonzero(sizes)
        print_a, print_b = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
        bands, small = [None] * len(sizes), [None] * len(sizes)
        if len(some):
            inner = np.concatenate((bounds[some], bounds[-1:]))  # rows without shingles take no room between the others
            print_a[some] = np.add.reduceat(hashes, inner[:-1])
            print_b[some] = np.bitwise_xor.reduceat(mix(hashes ^ np.uint64(0xA5A5)), inner[:-1])
            signature = signatures(hashes, inner)
            keys = np.zeros((len(some), BANDS), dtype=np.uint64)
            chosen = (signature >> np.uint64(24))[:, _BAND_ORDER].reshape(len(some), BANDS, ROWS)
            for j in range(ROWS):
                keys += chosen[:, :, j] * _BAND_FACTORS[j]
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            small8 = ((signature * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)
            for i, at in enumerate(some):
                bands[at], small[at] = keys[i], small8[i].tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(print_a.view(np.int64)), pa.array(print_b.view(np.int64)),
                pa.array(bands, pa.list_(pa.int64())), pa.array(small, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "print_a", "print_b", "bands", "sketch"],
        )


class _Group:
    """The documents of one task, joined to components by confirmed links only.

    side: where two blocks of a larger group meet, only links between the blocks count; within each, another task looks.
    """

    def __init__(self, sets: list[np.ndarray], sketch: np.ndarray, side: np.ndarray | None):
        self.sets, self.sketch, self.side = sets, sketch, side
        self.sizes = np.array([len(s) for s in sets])
        self.label = np.arange(len(sets))

    def linked(self, i: int, j: int) -> bool:
        a, b = (self.sets[i], self.sets[j]) if self.sizes[i] <= self.sizes[j] else (self.sets[j], self.sets[i])
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        same = int((b[at] == a).sum())
        return 100 * same >= 75 * (len(a) + len(b) - same)

    def attach(self, i: int, others: np.ndarray) -> None:
        """Try document i against others: those of other components whose size and sketch allow a link, likest first."""
        others = others[self.label[others] != self.label[i]]
        if self.side is not None:
            others = others[self.side[others] != self.side[i]]
        others = others[4 * np.minimum(self.sizes[others], self.sizes[i]) >= 3 * np.maximum(self.sizes[others], self.sizes[i])]
        if len(others) > 2:  # for a pair or two the sets are as quick
            matches = np.concatenate([(self.sketch[part] == self.sketch[i]).sum(axis=1) for part in np.array_split(others, -(-len(others) // 20_000))])
            likely = matches >= LEAST_MATCHES * 2 * PERMUTATIONS
            others = others[likely][np.argsort(-matches[likely], kind="stable")]
        for j in others:
            if self.label[j] != self.label[i] and self.linked(i, j):
                low, high = sorted((self.label[i], self.label[j]))
                self.label[self.label == high] = low

    def attach_by_prefix(self) -> None:
        """Every pair that may be linked meets, by the positional prefix filter (Xiao et al., PPJoin), which loses none.

        In each set the shingles are put in order of their frequency in the group, rare ones first. A linked pair has
        7 * intersection >= 3 * (sum of sizes); all it shares lies at or behind its first common shingle, so in both sets at least
        that many shingles must be left from there on. Documents of a component that most holders of a shingle belong to are
        not tried against each other, so a group of copies costs no pairs.
        """
        n, sizes = len(self.sets), self.sizes
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        _, token, often = np.unique(np.concatenate(self.sets), return_inverse=True, return_counts=True)
        often = often[token]
        order = np.lexsort((token, often, owner))
        token, often = token[order], often[order]
        left = sizes[owner] - (np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
        keep = (often > 1) & (4 * left >= 3 * sizes[owner])
        token, owner, left = token[keep], owner[keep], left[keep]
        order = np.lexsort((owner, sizes[owner], token))
        token, owner, left = token[order], owner[order], left[order]
        if not len(token):
            return
        # The component that most holders of a shingle belong to.
        pairs, first, count = np.unique(token * n + self.label[owner], return_index=True, return_counts=True)
        order = np.lexsort((-count, token[first]))
        most = order[np.concatenate(([True], np.diff(token[first][order]) > 0))]
        major = np.full(int(token[-1]) + 1, -1)
        major[token[first][most]] = np.where(count[most] > 1, self.label[owner[first][most]], -1)
        odd = major[token] != self.label[owner]
        size = sizes[owner]
        reach = np.minimum(4 * size // 3, (7 * left - 3 * size) // 3)  # the largest partner
        key = token << 32 | size
        asks = np.flatnonzero(odd & (4 * reach >= 3 * size))
        asks = asks[np.argsort(owner[asks], kind="stable")]
        low = np.searchsorted(key, token[asks] << 32 | -(-3 * size[asks] // 4), side="left")
        high = np.searchsorted(key, token[asks] << 32 | reach[asks], side="right")
        for mine in np.split(np.arange(len(asks)), np.flatnonzero(np.diff(owner[asks])) + 1):
            i = owner[asks[mine[0]]] if len(mine) else 0
            at = ranges(low[mine], high[mine] - low[mine])
            other = owner[at]
            fits = (size[at] <= reach[asks[np.repeat(mine, high[mine] - low[mine])]]) & (sizes[i] <= reach[at]) & (other != i) & (~odd[at] | (other < i))
            if fits.any():
                self.attach(i, np.unique(other[fits]))


def _links(ids: np.ndarray, sets: list[np.ndarray], sketch: np.ndarray, side: np.ndarray | None) -> np.ndarray:
    """The smallest id that each document of a group reaches over confirmed links."""
    n = len(ids)
    group = _Group(sets, sketch, side)
    if n <= FEW:
        for i in range(n - 1):
            group.attach(i, np.arange(i + 1, n))
    else:
        for i in np.unique(np.linspace(0, n - 1, HUBS, dtype=np.int64)):  # what is like a hub comes together at once
            group.attach(i, np.arange(n))
        group.attach_by_prefix()
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, group.label, ids)
    return least[group.label]


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by task; a task's rows may span batches, so each task waits until the next begins."""
    open_key, held = None, []

    def flush():
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids = rows.column("doc_id").to_numpy()
            sides = rows.column("block").to_numpy()
            sets = []
            for part in rows.to_batches():
                for piece in chunks(iter([part])):
                    hashes, bounds = shingle_sets(piece.column("text"))
                    sets += [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
            task = rows.column("task").to_numpy()
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1), len(ids)]
            out = np.empty(len(ids), np.int64)
            for a, b in zip(cuts[:-1], cuts[1:]):
                one = rows.column("cross")[a].as_py()
                out[a:b] = _links(ids[a:b], sets[a:b], sketch[a:b], sides[a:b] if one else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(out), rows.column("blocks").combine_chunks()], names=["doc_id", "component", "blocks"])

    for batch in chunks(batches, limit=16 << 20):
        task = batch.column("task").to_numpy()
        start, changes = 0, np.flatnonzero(task[1:] != task[:-1]) + 1
        last = int(changes[-1]) if len(changes) else 0  # where the task that may go on in the next batch begins
        if open_key is not None and task[0] != open_key:
            yield from flush()
            held = []
        if last:
            held.append(batch.slice(0, last))
            yield from flush()
            held, start = [], last
        held.append(batch.slice(start))
        open_key = task[-1]
    yield from flush()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> doc_id, n_shingles, component_id, kept.

    A document's set: its distinct 5-word shingles (A-Z lowered), the whole sequence if it has fewer words, empty without
    words or text. Two documents are linked if 100 * |intersection| >= 75 * |union|. component_id is the smallest id
    reachable; kept = it is the document's own. Null or empty texts: n_shingles 0, linked with nothing. Rows that share a
    doc_id are one document in the links, each returned; a null doc_id is returned with a null component_id and kept. Other
    columns are ignored. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = cut(docs.mapInArrow(_sketch, "doc_id long, n_shingles long, print_a long, print_b long, bands array<long>, sketch binary"))
    # Equal sets have one representative: the smallest id.
    known = made.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("n_shingles", "print_a", "print_b").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top"))
    # A key of its own for the join: both sides are dealt out for it, and AQE may split a class that a third of all rows share.
    same = cut(classes.where("top > rep").select(F.xxhash64("n_shingles", "print_a", "print_b").alias("class"), F.col("n_shingles").alias("n"), F.col("print_a").alias("x"), F.col("print_b").alias("y"), "rep"))
    members = known.select("doc_id", "n_shingles", "print_a", "print_b", F.xxhash64("n_shingles", "print_a", "print_b").alias("class"))
    owner = members.join(same, (members["class"] == same["class"]) & (F.col("n_shingles") == F.col("n")) & (F.col("print_a") == F.col("x")) & (F.col("print_b") == F.col("y")), "left")
    owner = cut(owner.select("doc_id", F.coalesce("rep", "doc_id").alias("rep")))
    reps = cut(known.join(owner.where("doc_id <> rep").select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "n_shingles", "bands", "sketch"))
    keys = reps.select("doc_id", F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("top")).where("top > hub")
    ties = keys.join(hubs, "key").where("doc_id > hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    groups = connected_components(ties)
    weights = cut(groups.join(reps.select(F.col("doc_id").alias("id"), "n_shingles", "sketch"), "id"))
    blocks = weights.groupBy("component").agg(F.greatest(F.lit(1), F.ceil(F.sum("n_shingles") / GROUP_SHINGLES)).cast("int").alias("blocks"))
    placed = weights.join(blocks, "component").select(F.col("id").alias("doc_id"), "component", "sketch", "blocks", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"))
    with_text = placed.join(docs, "doc_id")
    met = with_text.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "doc_id", "text", "sketch", "block", "blocks", (F.col("block") != F.col("other")).alias("cross"),
        F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
    )
    # A pair of blocks (i, j) gets the rows of both; (i, i) gets its own.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    linked = cut(met.repartition(parts, "task").sortWithinPartitions("task", "doc_id").mapInArrow(_confirm, "doc_id long, component long, blocks int"))
    one = linked.where("blocks = 1").select(F.col("doc_id").alias("id"), "component")
    many = linked.where("blocks > 1")
    if many.limit(1).count():
        one = one.unionByName(connected_components(many.select(F.col("doc_id").alias("a"), F.col("component").alias("b"))))
    found = one.where("id <> component").groupBy("id").agg(F.min("component").alias("component"))
    whole = owner.join(found, owner.rep == found.id, "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    return made.select("doc_id", "n_shingles").join(whole, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept")
    )
