"""Operator 5: hierarchical language identification.

First the language family is predicted, then, inside the family, one-versus-one linear support vector machines tell the closely
related languages apart. Both levels are one-versus-one votes of linear SVMs on hashed character 1- to 4-grams. The SVMs are
fitted on a bounded sample of labelled rows (`SAMPLE` for each language, chosen by a hash of doc_id); prediction runs over every
row's whole text. The model's size depends on the number of languages only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import chunks, text_buffers

SAMPLE = 400
DIMS = 1 << 13
GRAMS = (1, 2, 3, 4)
#: Families of ISO 639-1 codes. A code that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af fy lb sv da no nb nn is",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "semitic": "ar he mt am",
    "indic": "hi mr ne bn gu pa ur",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20
_LOWER[[*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 0x20  # ASCII digits and marks: no language's own


def family(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].split("_")[0].lower(), lang)


def features(column: pa.Array) -> np.ndarray:
    """Rows of square-rooted, L2-normalised hashed n-gram counts (float32, DIMS wide) of the lowered letters of each whole text."""
    data, offsets = text_buffers(column)
    data, offsets = _LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
    out = np.empty((len(column), DIMS), dtype=np.float32)
    n = len(data)
    codes = np.zeros((len(GRAMS), n), dtype=np.uint32)
    wide = data.astype(np.uint32) + np.uint32(1)
    for g, size in enumerate(GRAMS):
        h = np.zeros(max(n - size + 1, 0), dtype=np.uint32)
        for j in range(size):
            h = h * np.uint32(0x01000193) + wide[j : n - size + 1 + j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        codes[g, : len(h)] = (h ^ np.uint32(g * 0x9E37)) >> np.uint32(19)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        counts = np.zeros(DIMS, dtype=np.int64)
        for g, size in enumerate(GRAMS):
            if b - a >= size:
                counts += np.bincount(codes[g, a : b - size + 1], minlength=DIMS)
        row = np.sqrt(counts, dtype=np.float64)
        out[i] = row / max(np.sqrt(counts.sum()), 1e-9)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, steps: int = 200, penalty: float = 1e-3) -> np.ndarray:
    """Weights (last: bias) of an L2-regularised squared-hinge SVM for labels +1 and -1, by accelerated gradient steps."""
    x = np.hstack((x.astype(np.float64), np.ones((len(x), 1))))
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))  # classes weigh alike
    w = np.zeros(x.shape[1])
    ahead, rate = w.copy(), 1 / (4.0 + penalty)  # rows have a norm of sqrt(2), so this is below the inverse curvature
    for t in range(steps):
        gap = np.maximum(1 - y * (x @ ahead), 0)
        fresh = ahead - rate * (penalty * ahead - 2 * ((share * y * gap) @ x))
        ahead, w = fresh + t / (t + 3) * (fresh - w), fresh
    return w


@dataclass
class Votes:
    """One-versus-one SVMs over `names`."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Votes:
        names = sorted(set(y.tolist()))
        pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
        weights = []
        for i, j in pairs:
            rows = (y == names[i]) | (y == names[j])
            weights.append(linear_svm(x[rows], np.where(y[rows] == names[i], 1.0, -1.0)))
        return cls(names, pairs, np.array(weights).reshape(len(pairs), DIMS + 1))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner by votes (ties: larger sum of margins, then the first name) and its mean probability in its pairs."""
        if len(self.names) == 1:
            return np.zeros(len(x), dtype=np.int64), np.ones(len(x))
        margin = x @ self.weights[:, :-1].T.astype(np.float32) + self.weights[:, -1]
        votes, total, chance = (np.zeros((len(x), len(self.names))) for _ in range(3))
        for k, (i, j) in enumerate(self.pairs):
            m = margin[:, k].astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(4 * m, -30, 30)))
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            total[:, i] += np.clip(m, -2, 2)
            total[:, j] -= np.clip(m, -2, 2)
            chance[:, i] += p
            chance[:, j] += 1 - p
        best = np.argmax(votes + total * 1e-3 / len(self.names), axis=1)
        return best, chance[np.arange(len(x)), best] / (len(self.names) - 1)


@dataclass
class LanguageModel:
    families: Votes
    members: dict[str, Votes]

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> LanguageModel:
        groups = np.array([family(v) for v in langs], dtype=object)
        return cls(Votes.fit(x, groups), {g: Votes.fit(x[groups == g], langs[groups == g]) for g in sorted(set(groups.tolist()))})

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        group, chance = self.families.predict(x)
        names, scores = np.empty(len(x), dtype=object), np.empty(len(x))
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            member = self.members[self.families.names[g]]
            best, p = member.predict(x[rows])
            names[rows] = np.array(member.names, dtype=object)[best]
            scores[rows] = chance[rows] * p
        return names, np.clip(scores, 0, 1)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        x = features(batch.column("text")).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary()), batch.column("lang")], names=["x", "lang"])


def fit(docs: DataFrame, lang: str = "lang", sample: int = SAMPLE) -> LanguageModel | None:
    """Fit on about `sample` rows of each language: those with the smallest hash of doc_id; None without labelled rows.

    Texts longer than their features in the mean are turned into features where they lie, so the sample's size does not
    depend on the length of texts, and no language has fewer rows for it.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull() & (F.length(F.btrim("text")) > 0))
    sizes = labelled.groupBy(lang).agg(F.count("*").alias("n"), F.avg(F.octet_length("text")).alias("bytes")).collect()
    if not sizes:
        return None
    share = {r[lang]: min(1.0, sample / r["n"]) for r in sizes}
    least = F.create_map(*[F.lit(v) for pair in share.items() for v in pair])
    spot = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    rows = labelled.where(spot < least[F.col(lang)]).select("text", F.col(lang).cast("string").alias("lang"))
    far = [str(r[lang]) for r in sizes if r["bytes"] > 4 * DIMS]
    near = rows.where(~F.col("lang").isin(far)).toArrow()
    x = [features(part.column("text")) for part in chunks(iter(near.to_batches()))]
    langs = near.column("lang").to_pylist()
    if far:
        sent = rows.where(F.col("lang").isin(far)).mapInArrow(_feature_rows, "x binary, lang string").toArrow()
        x += [np.frombuffer(v, np.float32)[None] for v in sent.column("x").to_pylist()]
        langs += sent.column("lang").to_pylist()
    x = np.concatenate(x) if x else np.empty((0, DIMS), np.float32)
    langs = np.array(langs, dtype=object)
    return LanguageModel.fit(x, langs) if len(langs) else None


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, held_out, text, has_letter) -> doc_id, held_out, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=1 << 20):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                letters = part.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
                names, scores = (np.full(part.num_rows, "und", dtype=object), np.zeros(part.num_rows)) if model is None else model.predict(features(part.column("text")))
                names[~letters], scores[~letters] = "und", 0.0
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names.tolist(), pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """documents (doc_id, text, lang) -> doc_id, held_out, lang_pred, score.

    Learns from rows with a lang whose crc32(doc_id as text) mod 5 is not 0 (a null doc_id is held out); lang, source and doc_id
    are no inputs of a prediction. Null texts and texts without a letter: `und`, score 0; likewise everything if no row can be
    learned from. Equal texts get equal predictions; other columns are ignored; an empty table gives an empty result.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    held = F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(True))
    model = fit(slim.where(~held))
    rows = slim.select("doc_id", held.alias("held_out"), "text", F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("has_letter"))
    return identify(rows, model)
