"""Quality classifier: similarity-weighted votes of labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.bytesops import U64, blocks, byte_view, mix, randoms, words

#: Labelled rows that the classifier is fitted on at most (those of smallest hash), and what is broadcast of them.
SAMPLE, TERMS, DIMENSIONS, NEIGHBOURS = 4000, 2048, 64, 15
FOLDS, ACCEPT = 5, 0.3
#: Texts that are scored at once: 8 MB of term counts.
ROWS = 512
#: Weight of a trait of the whole text against the sum of its words.
TRAIT = 2
_KIND = np.ones(256, np.int64)  # 1 letters and the bytes of other scripts
_KIND[65:91] = 2
_KIND[48:58] = 3
for _c in b".,;:!?'\"()-":
    _KIND[_c] = 4
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and _KIND[c] == 1]] = 5
_SALT = randoms(21, 4)


def term_frequencies(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows of hashed term shares (square roots): folded words, word shapes, repeats of the word before, traits."""
    n = len(bounds) - 1
    hashes, rows, starts, ends = words(data, bounds)
    if not len(hashes):
        return np.zeros((n, TERMS), np.float32)
    kinds = _KIND[data]
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kinds == 5, out=odd[1:])
    length = np.minimum((ends - starts + 2) // 3, 6)
    shape = ((kinds[starts] * 8 + kinds[ends - 1]) * 8 + np.minimum(odd[ends] - odd[starts], 4)) * 8 + length
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    terms = [hashes ^ _SALT[0], mix(shape.astype(U64) * _SALT[1]), mix(again.astype(U64) + _SALT[2])]
    counts = np.zeros(n * TERMS)
    for values in terms:
        counts += np.bincount(rows * TERMS + (mix(values) % U64(TERMS)).astype(np.int64), minlength=n * TERMS)
    counts = counts.reshape(n, TERMS)
    # Traits of the whole text, as terms that weigh as much as all its words: shares of repeats, of words with odd signs and of upper case, and length.
    total = np.bincount(rows, minlength=n)
    strange = (odd[ends] - odd[starts]) > 0
    high = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kinds == 2, out=high[1:])
    loud = (high[ends] - high[starts]) > 1
    for salt, marks in enumerate((again, strange, loud, None)):
        if marks is None:
            grade = np.searchsorted([4, 12, 50], total)
        else:
            grade = np.searchsorted([0.02, 0.1, 0.3, 0.6], np.bincount(rows, marks, n) / np.maximum(total, 1))
        term = (mix((grade + 8 * salt).astype(U64) + _SALT[3]) % U64(TERMS)).astype(np.int64)
        counts[np.arange(n), term] += TRAIT * total
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    weights: np.ndarray  # of terms
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # of the labelled texts, unit length
    labels: np.ndarray

    def project(self, frequencies: np.ndarray) -> np.ndarray:
        return _unit(_unit(frequencies * self.weights) @ self.axes)

    def score(self, frequencies: np.ndarray) -> np.ndarray:
        """0 for texts without words, 0.5 for all others if nothing is labelled."""
        empty = ~frequencies.any(1)
        if not len(self.labels):
            return np.where(empty, 0.0, 0.5)
        near = self.project(frequencies) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        last = -np.partition(-near, k - 1, axis=1)[:, k - 1 : k]
        sure, tied = near > last, near == last
        taken = sure | (tied & (np.cumsum(tied, axis=1) <= k - sure.sum(1, keepdims=True)))
        best = np.nonzero(taken)[1].reshape(-1, k)
        share = np.maximum(np.take_along_axis(near, best, 1).astype(np.float64), 1e-6) ** 4
        return np.where(empty, 0.0, np.clip((share * self.labels[best]).sum(1) / share.sum(1), 0, 1))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = byte_view(batch.column(2))
        for a, b in blocks(offsets, rows=ROWS):
            x = term_frequencies(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            at = [np.flatnonzero(r) for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(at, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(x, at, strict=True)], pa.list_(pa.float32()))],
                ["doc_id", "quality", "at", "share"],
            )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled documents outside the held-out fold (crc32 of doc_id mod 5 is 0).

    Only sparse term shares of the sampled texts, one for each doc_id (the smallest of several), reach the driver, where the latent axes are found by a
    randomised singular value decomposition.
    """
    held = F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held)
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")  # `sample` rows of two numbers
        .groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text"))
        .select("doc_id", "quality", "text").mapInArrow(_features, "doc_id long, quality int, at array<int>, share array<float>").toArrow()
    )
    x = np.zeros((rows.num_rows, TERMS), np.float32)
    for r, (at, share) in enumerate(zip(rows["at"].to_pylist(), rows["share"].to_pylist(), strict=True)):
        x[r, at] = share
    y = np.array(rows["quality"].to_pylist(), np.float64)
    order = np.argsort(rows["doc_id"].to_numpy())  # rows arrive in any order
    x, y = x[order], y[order]
    some = x.any(1)
    x, y = x[some], y[some]
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 0.1
    if not len(x):
        return Model(weights, np.zeros((TERMS, DIMENSIONS), np.float32), np.zeros((0, DIMENSIONS), np.float32), y)
    w = _unit(x * weights)
    q = np.linalg.qr(w.T @ (w @ np.random.default_rng(7).standard_normal((TERMS, DIMENSIONS + 16)).astype(np.float32)))[0]
    for _ in range(2):
        q = np.linalg.qr(w.T @ (w @ q))[0]
    axes = (q @ np.linalg.svd(w @ q, full_matrices=False)[2].T)[:, :DIMENSIONS].astype(np.float32)
    return Model(weights, axes, _unit(w @ axes), y)


def classify_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Score every document: (doc_id, held_out, score, predicted).

    docs: doc_id, text; labels: doc_id, quality (0/1). Whole texts become shares of 2048 hashed terms (words,
    word shapes, immediate repeats), weighted by rarity and projected on 64 latent axes. The cosine to every
    one of the broadcast labelled vectors (at most `sample`, 1 MB at 4000) is computed in blocks; the 15
    nearest vote with the fourth power of their cosine. predicted is 1 from a score of 0.3 up.

    Null text or one without words scores 0. A null doc_id isn't held out. Labels that are null, not 0/1 or
    without document are passed over, several for one doc_id count as the smallest. Without any usable label
    every text with words scores 0.5. Rows, repeated ones too, come back one for one. Where several labelled vectors
    tie for the last place among the neighbours, equal cosines weigh the same and the earlier ones in doc_id order are
    taken. A very long text is one step of a task, and other columns aren't read. Empty input: no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_view(batch.column(1))
            for a, b in blocks(offsets, rows=ROWS):
                scores = model.value.score(term_frequencies(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(scores, pa.float64())], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return texts.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )


def keep_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs`, with all their columns, whose predicted quality is 1 (see `classify_quality`); no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_view(batch.column(at))
            for a, b in blocks(offsets, rows=ROWS):
                scores = model.value.score(term_frequencies(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                yield batch.slice(a, b - a).filter(pa.array(scores >= ACCEPT))

    return docs.mapInArrow(keep, docs.schema)
