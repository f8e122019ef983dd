"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes hashed counts of its letter bigrams and trigrams (lower case,
each run of other characters is one blank), log-scaled, weighted by inverse
document frequency and normalised. Document frequencies are counted over all
learning documents; centroids come from a bounded sample of them (``max_fit`` a
language, chosen by a hash of the id): spherical k-means inside each language
gives ``clusters`` centroids. A text gets the language of the most similar
centroid. ``rejected`` marks texts that lie further from it than all but
``reject_share`` of the learning texts of that centroid.

Defined results: ``und`` and score 0 for a null text, a text without letters,
and for all texts when nothing could be learned. Labels that are null and rows
with a null id are not learned from; a null id is not held out. Equal
similarities: the alphabetically first language. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import id_bucket, staged

DIMS = 4096
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Hashed bigram and trigram counts; None without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return None
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first blank after a letter
    c = np.concatenate([[0], np.where(is_letter, codes, 0)[keep], [0]]).astype(np.uint32)
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
    three = (two[:-1] ^ c[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    two = two * np.uint32(0x165667B1)
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    return np.bincount(two >> shift, minlength=DIMS) + np.bincount(three >> shift, minlength=DIMS)


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return (v / np.linalg.norm(v)).astype(np.float32)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each hashed n-gram, and documents with letters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS + 1, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                if (c := ngram_counts(t)) is not None:
                    df[:DIMS] += c > 0
                    n += 1
        df[DIMS] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["dim", "df"])

    out = np.zeros(DIMS + 1, np.int64)
    for r in docs.select("text").mapInArrow(run, "dim long, df long").groupBy("dim").agg(F.sum("df").alias("df")).collect():
        out[r["dim"]] = r["df"]
    return out[:DIMS], int(out[DIMS])


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts at the mean's nearest vector, then farthest ones."""
    seeds = [int(np.argmax(vectors @ vectors.mean(0)))]
    near = vectors @ vectors[seeds[0]]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[seeds[-1]])
    centres = vectors[seeds]
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        new = np.stack([vectors[own == i].sum(0) if (own == i).any() else centres[i] for i in range(len(centres))])
        new /= np.linalg.norm(new, axis=1, keepdims=True)
        if np.allclose(new, centres, atol=1e-6):
            break
        centres = new
    return centres


def learn(docs: DataFrame, max_fit: int = 1500, clusters: int = 4, reject_share: float = 0.005) -> dict | None:
    """Model of (doc_id, text, lang) rows: idf, centroids, their languages and similarity bounds."""
    known = docs.where("lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    df, n = document_frequencies(known)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)) + 1
    # one number a language; a join by language would send all texts of one to a task
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    share = F.create_map(*[F.lit(x) for k, c in sorted(sizes.items()) for x in (k, min(1.0, max_fit / c))])
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("lang-fit")), 11) / F.lit(float(1 << 53))
    sample = known.where(u < F.element_at(share, F.col("lang"))).select("lang", "doc_id", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(lang, i, unit(c, idf).tobytes()) for lang, i, t in zip(*(x.to_pylist() for x in b.columns), strict=True)
                    if (c := ngram_counts(t)) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary())], ["lang", "doc_id", "v"])

    table = staged(sample.mapInArrow(vectors, "lang string, doc_id long, v binary"), "lang_vectors")

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "v"])
        x = np.stack([np.frombuffer(v, np.float32) for v in pdf["v"]])
        centres = cluster(x, clusters)
        near = x @ centres.T
        own = near.argmax(1)
        return pd.DataFrame([
            {"lang": pdf["lang"].iloc[0], "centre": c.astype(np.float32).tobytes(),
             "bound": float(np.quantile(near[own == i, i], reject_share)) if (own == i).any() else 0.0}
            for i, c in enumerate(centres)])

    # a group holds about max_fit rows, whatever the table holds
    rows = table.groupBy("lang").applyInPandas(centroids, "lang string, centre binary, bound double").collect()
    rows.sort(key=lambda r: (r["lang"], r["centre"]))
    return {"idf": idf, "langs": [r["lang"] for r in rows], "bounds": np.array([r["bound"] for r in rows]),
            "centres": np.stack([np.frombuffer(r["centre"], np.float32) for r in rows])} if rows else None


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine), rejected for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, far = [], [], []
            for t in b.column(2).to_pylist():
                c = ngram_counts(t) if model else None
                if c is None:
                    lang.append(UNKNOWN), score.append(0.0), far.append(True)
                    continue
                near = model["centres"] @ unit(c, model["idf"])
                i = int(np.argmax(near))
                lang.append(model["langs"][i])
                score.append(float(np.clip(near[i], 0, 1)))
                far.append(bool(near[i] < model["bounds"][i]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(far, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def held_out():
    return F.coalesce(id_bucket(4) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(docs.where(~held_out())))
