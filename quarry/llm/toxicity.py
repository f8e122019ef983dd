"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text (present or not): its words, the starts of its words, word
bigrams and skip-grams (words i and i+2), hashed to ``2**BITS`` coordinates.
Training takes a bounded, documented sample of labelled rows (``max_fit``, by a
hash of the id): its ids are broadcast to the texts, whose features are worked out
where they lie, and one task runs FTRL-proximal over the features, with
per-coordinate rates and L1. L1 leaves few weights other than 0; those are the
model. Scoring reads every whole text once, with the weights in the task closure
(at most ``2**BITS``).

Defined results: null and empty texts have the bias only, so every text gets a
score; labels that are null and rows with a null id are not learned from, a null
id is not held out, several labels of one id count as toxic if any is; without
labels all scores are 0; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import id_bucket, staged

BITS = 20
BIAS = 1 << BITS
STARTS = (5, 7)  # lengths of the word starts
MAX_FIT = 20_000
_WORD = re.compile(r"\w+")


def features(text: str | None) -> np.ndarray:
    """Sorted distinct coordinates, the bias last."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.array([BIAS], np.int64)
    crc = zlib.crc32
    one = np.fromiter((crc(w.encode()) for w in words), np.uint64, len(words))
    distinct = set(words)
    starts = [crc(w[:n].encode()) + n for w in distinct for n in STARTS if len(w) > n]
    mix = np.uint64(0x9E3779B97F4A7C15)
    keys = [one * mix, np.array(starts, np.uint64) * np.uint64(0xD6E8FEB86659FD93)]
    for gap, salt in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB)):
        keys.append((one[:-gap] * mix ^ one[gap:] * np.uint64(salt)) * mix)
    at = np.unique(np.concatenate(keys) >> np.uint64(64 - BITS))
    return np.append(at.astype(np.int64), BIAS)


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = 8, alpha: float = 1.0, beta: float = 1.0,
         l1: float = 8.0, l2: float = 1.0) -> np.ndarray:
    """Weights after FTRL-proximal passes over (coordinates, label) rows."""
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(epochs):
        for at, y in rows:
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(BIAS + 1))


def learn(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> dict[int, float]:
    """Weights other than 0 of (doc_id, text) and (doc_id, toxic) rows."""
    marks = (labels.where("toxic is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.max("toxic").alias("y")))
    n = marks.count()
    if not n:
        return {}
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("toxic-fit")), 11) / F.lit(float(1 << 53))
    sample = staged(marks.where(u < min(1.0, max_fit / n)).select(F.col("doc_id"), F.col("y").cast("int")), "toxic_sample")

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [features(t).astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(at, pa.list_(pa.int32()))], ["doc_id", "y", "at"])

    # about max_fit ids and labels: the broadcast is bounded by the parameter
    rows = staged(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")
                  .mapInArrow(prepare, "doc_id long, y int, at array<int>"), "toxic_features")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for b in batches:
            for i, y, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                found.append((i, at.values.to_numpy().astype(np.int64), y))
        # an order that doesn't depend on the partition's
        found.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], len(r[1])))
        w = ftrl([(at, y) for _, at, y in found])
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["at", "w"])

    return {r["at"]: r["w"] for r in rows.coalesce(1).mapInArrow(train, "at long, w double").collect()}


def score(docs: DataFrame, weights: dict[int, float]) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    at = np.array(sorted(weights), np.int64)
    values = np.array([weights[i] for i in at.tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros(BIAS + 1)
        w[at] = values
        for b in batches:
            total = np.array([w[features(t)].sum() for t in b.column(2).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(total, -35, 35))) if len(at) else np.zeros(len(total))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def held_out():
    return F.coalesce(id_bucket(5) == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels.where(~held_out())))
