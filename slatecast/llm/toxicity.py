"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features are single words (and their first bytes), word pairs and pairs that
skip a word, hashed to
2^bits coordinates, each counted once a document. Training takes one document
at a time with a rate per coordinate (alpha / (beta + sqrt of the sum of its
squared gradients)); the L1 term leaves most weights at exactly zero, so what
is broadcast is the list of the others.

Fitting reads a bounded sample: the ``max_rows`` labelled rows with the least
hash of doc_id, and of these no more than ``max_features`` feature values in
all (a bound for very long texts). Scoring reads every text whole.

Defined cases: a null or empty text has only the intercept; labels other than
0 and 1 are ignored, a document with both counts as 1; a labelled doc_id with
several rows is learned from once, by its least text; without training rows
every score is 0.5; repeated rows, and those without a doc_id, are scored each;
an empty table gives an empty result. Other columns are not read, whatever their
names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.llm.common import hash60
from slatecast.llm.licenses import words_of

BITS = 20
MAX_ROWS = 20_000
MAX_FEATURES = 60_000_000
#: A word is also counted under its first bytes, which inflected and compound forms share.
STEM = 5
_A, _B, _C, _D, _E = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                            0x27D4EB2F165667C5, 0x9FB21C651E98DF25))


class WordHashes(dict):
    """64-bit hashes of words, the common ones remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = ((zlib.crc32(word) << 32) | zlib.adler32(word[::-1] + b"#")) & 0xFFFFFFFFFFFFFFFF
        value = (value * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
        self[word] = value ^ (value >> 32)
        return self[word]


def features(text: bytes | None, hashes: WordHashes, bits: int = BITS) -> np.ndarray:
    """Coordinates of a text, repeats included; 0 is the intercept's and is never hashed to."""
    words = words_of(text or b"")
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    stems = np.fromiter(map(hashes.__getitem__, [w[:STEM] for w in words]), np.uint64, len(words))
    parts = [h * _A, h[:-1] * _B + h[1:] * _C, h[:-2] * _C + h[2:] * _D, stems * _E]
    joined = np.concatenate(parts) * _A
    return np.maximum((joined >> np.uint64(64 - bits)).astype(np.int32), 1)


class Ftrl:
    def __init__(self, size: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: float) -> None:
        """One step on a document; ``at`` holds distinct coordinates."""
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", doc_id: str = "doc_id",
        bits: int = BITS, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
        epochs: int = 4) -> dict[int, float]:
    """Non-zero weights by coordinate (0: intercept), at most 2^bits of them."""
    rows = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter(
        "id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    sample = rows.withColumn("order", hash60(F.col("id").cast("string"))).orderBy("order", "id").limit(max_rows)
    # at most max_rows narrow rows; a labelled id with several rows counts with its least text
    body = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")) \
        .join(F.broadcast(sample), "id").groupBy("order", "id", "label").agg(F.min("text").alias("text")) \
        .select("order", "label", "text")

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in parts:
            for at in range(0, part.num_rows, 200):
                piece = part.slice(at, 200)
                lists = [np.unique(features(t, hashes, bits)) for t in piece.column(2).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(lists, pa.list_(pa.int32()))],
                    names=["order", "label", "at"])

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen, total = Ftrl(1 << bits), [], 0
        zero = np.zeros(1, np.int32)
        for part in parts:
            for lab, at in zip(part.column(1).to_pylist(), part.column(2)):
                if total < max_features:
                    at = np.concatenate([zero, at.values.to_numpy()])
                    total += len(at)
                    seen.append((float(lab), at))
        for _ in range(epochs):
            for lab, at in seen:
                model.learn(at, lab)
        used = np.flatnonzero(np.abs(model.z) > model.l1)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(model.weights(used))],
                                         names=["at", "weight"])

    learned = body.mapInArrow(hashed, "order long, label int, at array<int>") \
        .repartition(1).sortWithinPartitions("order", "at").mapInArrow(learn, "at long, weight double")
    return {r["at"]: r["weight"] for r in learned.collect()}


def score(docs: DataFrame, weights: dict[int, float], text: str = "text", doc_id: str = "doc_id",
          bits: int = BITS) -> DataFrame:
    """(doc_id, score): the probability of label 1 for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)   # at most 2^bits entries, a few hundred as a rule
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << bits)
        for at, w in shared.value.items():
            dense[at] = w
        hashes, used = WordHashes(), dense != 0
        for part in parts:
            sums = []
            for t in part.column(1).cast(pa.binary()).to_pylist():
                at = features(t, hashes, bits)
                sums.append(dense[0] + dense[np.unique(at[used[at]])].sum())
            p = 1.0 / (1.0 + np.exp(-np.clip(np.array(sums, np.float64), -35, 35)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p)], names=["doc_id", "score"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
