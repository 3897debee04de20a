"""Masks as run lengths: column-major counts that begin with a run of zeros. Set algebra and areas stay in columns; morphology,
components and boundaries decode to NumPy inside Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def encode(mask: np.ndarray) -> list[int]:
    """Dense 2-d mask -> counts."""
    flat = np.asarray(mask, dtype=bool).ravel(order="F")
    if not flat.size:
        return [0]
    change = np.flatnonzero(flat[1:] != flat[:-1]) + 1
    counts = np.diff(np.concatenate(([0], change, [flat.size]))).tolist()
    return [0, *counts] if flat[0] else counts


def decode(counts: list[int], height: int, width: int) -> np.ndarray:
    values = np.arange(len(counts)) % 2 == 1
    return np.repeat(values, counts).reshape((height, width), order="F")


def to_compressed(counts: list[int]) -> str:
    """Counts as the printable string of COCO-style annotations: differences to two runs before, 5 bits a character."""
    out = []
    for i, count in enumerate(counts):
        x, more = int(count) - (int(counts[i - 2]) if i > 2 else 0), True
        while more:
            bits = x & 31
            x >>= 5
            more = x != (-1 if bits & 16 else 0)
            out.append(chr(bits + 32 * more + 48))
    return "".join(out)


def from_compressed(text: str) -> list[int]:
    counts: list[int] = []
    at = 0
    while at < len(text):
        x, shift, more = 0, 0, True
        while more:
            code = ord(text[at]) - 48
            x |= (code & 31) << shift
            more, at, shift = bool(code & 32), at + 1, shift + 5
        if code & 16:
            x -= 1 << shift
        counts.append(x + (counts[-2] if len(counts) > 2 else 0))
    return counts


def area(counts: Column) -> Column:
    """Sum of the odd runs."""
    odd = F.filter(counts, lambda x, i: i % 2 == 1)
    return F.aggregate(odd, F.lit(0).cast("long"), lambda s, x: s + x)


def runs(masks: DataFrame, keys: list[str], counts: str = "counts") -> DataFrame:
    """(keys, first, last): the one-runs as half-open pixel ranges in column-major order. `keys` tell the masks apart."""
    one = masks.select(*keys, F.posexplode(counts).alias("_i", "_n"))
    ends = one.withColumn("last", F.sum(F.col("_n").cast("long")).over(Window.partitionBy(*keys).orderBy("_i")))
    return ends.where((F.col("_i") % 2 == 1) & (F.col("_n") > 0)).select(*keys, (F.col("last") - F.col("_n")).alias("first"), "last")


def intersections(left: DataFrame, right: DataFrame, keys: list[str], width: int = 256) -> DataFrame:
    """Common pixels of the runs of two sides that share `keys` (other columns must differ in name). Runs meet in pixel buckets."""
    cutting = lambda df: df.withColumn("_b", F.explode(F.sequence(F.floor(F.col("first") / width), F.floor((F.col("last") - 1) / width))))
    l = cutting(left).select(*[c for c in left.columns if c not in ("first", "last")], "_b", F.greatest("first", F.col("_b") * width).alias("_l0"), F.least("last", (F.col("_b") + 1) * width).alias("_l1"))
    r = cutting(right).select(*[c for c in right.columns if c not in ("first", "last")], "_b", F.greatest("first", F.col("_b") * width).alias("_r0"), F.least("last", (F.col("_b") + 1) * width).alias("_r1"))
    met = l.join(r, [*keys, "_b"]).where((F.col("_l0") < F.col("_r1")) & (F.col("_r0") < F.col("_l1")))
    by = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c not in ("first", "last")]
    return met.groupBy(*by).agg(F.sum(F.least("_l1", "_r1") - F.greatest("_l0", "_r0")).alias("common"))


def iou(common: Column, a: Column, b: Column) -> Column:
    """0 without common pixels."""
    return F.when(common > 0, common / (a + b - common)).otherwise(0.0)


def silhouette_metrics(common: Column, rendered: Column, observed: Column) -> Column:
    """(iou, overflow, underfill), every denominator at least 1."""
    one = F.lit(1)
    return F.struct(
        (common / F.greatest(rendered + observed - common, one)).alias("iou"), ((rendered - common) / F.greatest(rendered, one)).alias("overflow"), ((observed - common) / F.greatest(observed, one)).alias("underfill")
    )


def bounding_box(run_rows: DataFrame, keys: list[str], height: Column) -> DataFrame:
    """Inclusive x0, y0, x1, y1 from runs; a run over a column's end touches both the top and the bottom row."""
    top = F.when(F.floor((F.col("last") - 1) / height) > F.floor(F.col("first") / height), 0).otherwise(F.pmod(F.col("first"), height))
    bottom = F.when(F.floor((F.col("last") - 1) / height) > F.floor(F.col("first") / height), height - 1).otherwise(F.pmod(F.col("last") - 1, height))
    return run_rows.groupBy(*keys).agg(F.min(F.floor(F.col("first") / height)).alias("x0"), F.min(top).alias("y0"), F.max(F.floor((F.col("last") - 1) / height)).alias("x1"), F.max(bottom).alias("y1"))


def _shifted(mask: np.ndarray, dy: int, dx: int, fill: bool) -> np.ndarray:
    h, w = mask.shape
    out = np.full_like(mask, fill)
    out[max(dy, 0) : h + min(dy, 0), max(dx, 0) : w + min(dx, 0)] = mask[max(-dy, 0) : h + min(-dy, 0), max(-dx, 0) : w + min(-dx, 0)]
    return out


def disk(radius: int) -> list[tuple[int, int]]:
    """Offsets of an elliptic element of 2 * radius + 1."""
    if radius <= 0:
        return [(0, 0)]
    return [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if abs(dx) <= round(radius * math.sqrt(max(0.0, 1 - (dy / radius) ** 2)))]


def square(size: int) -> list[tuple[int, int]]:
    return [(dy, dx) for dy in range(-(size // 2), size - size // 2) for dx in range(-(size // 2), size - size // 2)]


def dilate(mask: np.ndarray, element: list[tuple[int, int]]) -> np.ndarray:
    return np.logical_or.reduce([_shifted(mask, dy, dx, False) for dy, dx in element])


def erode(mask: np.ndarray, element: list[tuple[int, int]]) -> np.ndarray:
    return np.logical_and.reduce([_shifted(mask, dy, dx, True) for dy, dx in element])


def opened(mask: np.ndarray, element: list[tuple[int, int]]) -> np.ndarray:
    return dilate(erode(mask, element), element)


def closed(mask: np.ndarray, element: list[tuple[int, int]]) -> np.ndarray:
    return erode(dilate(mask, element), element)


def core(mask: np.ndarray, close: int = 3, shrink: int = 8) -> np.ndarray:
    """Close with a square, then erode with a square; a size of 0 leaves a step out."""
    mask = closed(mask, square(close)) if close > 0 else mask
    return erode(mask, square(shrink)) if shrink > 0 else mask


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected components by union of the runs of neighbouring rows; labels from 1 in raster order of their first pixel."""
    labels, parent, before = np.zeros(mask.shape, dtype=np.int32), [0], []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for y in range(mask.shape[0]):
        edge = np.flatnonzero(np.diff(np.concatenate(([False], mask[y], [False])).astype(np.int8)))
        now = []
        for a, b in zip(edge[::2], edge[1::2]):
            found = sorted({root(k) for c, d, k in before if c <= b and d >= a})
            if not found:
                parent.append(len(parent))
                found = [len(parent) - 1]
            for other in found[1:]:
                parent[other] = found[0]
            now.append((a, b, found[0]))
            labels[y, a:b] = found[0]
        before = now
    names: dict[int, int] = {}
    table = np.zeros(len(parent), dtype=np.int32)
    for x in range(1, len(parent)):
        table[x] = names.setdefault(root(x), len(names) + 1)
    return table[labels], len(names)


def without_small_regions(mask: np.ndarray, least: int, holes: bool) -> tuple[np.ndarray, bool]:
    """Fill holes, or drop islands, smaller than `least`; if all islands are small the largest stays. Also whether anything changed."""
    labels, n = components(~mask if holes else mask)
    sizes = np.bincount(labels.ravel(), minlength=n + 1)[1:]
    small = [i + 1 for i, s in enumerate(sizes) if s < least]
    if not small:
        return mask, False
    if holes:
        return mask | np.isin(labels, small), True
    keep = [i + 1 for i in range(n) if i + 1 not in small] or [int(np.argmax(sizes)) + 1]
    return np.isin(labels, keep), True


def boundary(mask: np.ndarray) -> np.ndarray:
    """Pixels that differ from the right, lower or lower right neighbour (the last row and column compare with themselves)."""
    m = np.asarray(mask, dtype=bool)
    e, s = np.pad(m[:, 1:], ((0, 0), (0, 1)), mode="edge"), np.pad(m[1:], ((0, 1), (0, 0)), mode="edge")
    d = np.pad(m[1:, 1:], ((0, 1), (0, 1)), mode="edge")
    out = (m ^ e) | (m ^ s) | (m ^ d)
    out[-1] = (m ^ e)[-1]
    out[:, -1] = (m ^ s)[:, -1]
    out[-1, -1] = False
    return out


def boundary_f(prediction: np.ndarray, truth: np.ndarray, share: float = 0.008) -> float:
    """Boundary F: matches within ceil(share * diagonal) pixels. One side without boundary: precision 1, recall 0 or the reverse."""
    radius = math.ceil(share * math.hypot(*truth.shape))
    p, t = boundary(prediction), boundary(truth)
    if not p.any() or not t.any():
        precision, recall = (1.0, 1.0) if p.any() == t.any() else (1.0, 0.0) if t.any() else (0.0, 1.0)
    else:
        element = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]
        precision, recall = float((p & dilate(t, element)).sum() / p.sum()), float((t & dilate(p, element)).sum() / t.sum())
    return 0.0 if precision + recall == 0 else 2 * precision * recall / (precision + recall)


def contact_boundary(hands: np.ndarray, objects: np.ndarray) -> np.ndarray:
    """Where hands and objects meet: both dilated int(width / 456) times by a 3 x 3 square (narrow masks: not at all)."""
    for _ in range(hands.shape[1] // 456):
        hands, objects = dilate(hands, square(3)), dilate(objects, square(3))
    return hands & objects


def map_masks(masks: DataFrame, change, height: str = "h", width: str = "w", counts: str = "counts") -> DataFrame:
    """Apply a NumPy function mask -> mask to every row's run-length mask, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch[counts] = [encode(change(decode(c, h, w))) for c, h, w in zip(batch[counts], batch[height], batch[width])]
            yield batch

    return masks.mapInPandas(run, masks.schema)


def stability(logits: Column, threshold: float, offset: float) -> Column:
    """Pixels above threshold + offset over pixels above threshold - offset, of an array of logits."""
    return F.try_divide(F.size(F.filter(logits, lambda x: x > threshold + offset)).cast("double"), F.size(F.filter(logits, lambda x: x > threshold - offset)).cast("double"))
