"""Operator 6: document quality by hashed word n-grams and logistic regression with FTRL updates.

Tokens are runs of word characters and runs of other visible characters. A
document's features are its hashed single tokens, pairs and triples, each
counted and scaled by the square root of their number; a pair of equal tokens
also counts in one feature of its own. Training walks a bounded sample of
labelled documents in a fixed order with follow-the-regularised-leader steps; a
score is the sigmoid of a sparse dot product, corrected to the classes' shares
among all training labels.

Defined results: null, empty and blank texts have no features and score the
corrected intercept; without labels of both classes every score is the share of
the class (0.5 without labels); repeated rows each get their score, equal texts
equal ones; a null doc_id is never held out; texts of any length are read whole;
columns besides doc_id and text are not read and may have any name; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import bucket_of, slices, small_batches, table
from .labelled import class_counts, training_sample

TOKEN = re.compile(r"\w+|[^\w\s]+")
#: 2 ** 18 weights of 4 bytes: the model is 1 MB.
BITS = 18
#: The most documents of each class that training reads.
PER_CLASS = 5000
MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.7
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


class TokenHashes(dict):
    """Token to 64-bit hash, filled on demand and emptied when it has grown large."""

    def __missing__(self, token: str) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[token] = xxhash.xxh3_64_intdigest(token)
        return value


def features(texts: list[str | None], hashes: TokenHashes) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices of all texts, one after another, and the offset of each text (one more than texts)."""
    per = [[hashes[t] for t in TOKEN.findall(x)] if x else [] for x in texts]
    sizes = np.array([len(p) for p in per], dtype=np.int64)
    flat = np.fromiter((h for p in per for h in p), dtype=np.uint64, count=int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    shift = np.uint64(64 - BITS)
    parts, owners = [(flat * MULTIPLIER) >> shift], [doc]
    if len(flat) > 1:
        same = doc[1:] == doc[:-1]
        pair = flat[:-1] * SECOND + flat[1:]
        index = (pair * MULTIPLIER) >> shift
        parts += [index[same], np.full(int((same & (flat[1:] == flat[:-1])).sum()), 0, np.uint64)]
        owners += [doc[1:][same], doc[1:][same & (flat[1:] == flat[:-1])]]
        if len(flat) > 2:
            same = doc[2:] == doc[:-2]
            triple = (pair[:-1] * SECOND + flat[2:]) * MULTIPLIER >> shift
            parts.append(triple[same])
            owners.append(doc[2:][same])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(texts))
    return np.concatenate(parts)[order].astype(np.int64), np.concatenate(([0], np.cumsum(counts)))


def margins(index: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0.0], np.cumsum(weights[index].astype(np.float64))))
    n = np.maximum(np.diff(offsets), 1)
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.sqrt(n)


def ftrl(docs: list[tuple[np.ndarray, int]], alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 3) -> tuple[np.ndarray, float]:
    """Weights and intercept after FTRL-proximal steps over the documents, in the order given."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(i: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for index, y in docs:
            i, counts = np.unique(index, return_counts=True)
            i, x = np.append(i, size), np.append(counts / math.sqrt(max(1, len(index))), 1.0)
            w = weight(i)
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ x)))))
            g = (p - y) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    w = weight(np.arange(size + 1))
    return w[:-1].astype(np.float32), float(w[-1])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, docs = TokenHashes(), []
    for b in batches:
        ids, texts, labels = (b.column(c).to_pylist() for c in ("doc_id", "text", "label"))
        for lo, hi in slices([len(t) for t in texts], 1_000_000):
            index, offsets = features(texts[lo:hi], hashes)
            docs += [(xxhash.xxh3_64_intdigest(f"{i}:{t}"), index[a:c].astype(np.int32), y) for i, t, a, c, y in zip(ids[lo:hi], texts[lo:hi], offsets[:-1], offsets[1:], labels[lo:hi])]
    docs.sort(key=lambda d: (d[0], d[2]))  # the same order in every run
    weights, intercept = ftrl([(i, y) for _, i, y in docs])
    used = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1)), pa.array(np.append(weights[used].astype(np.float64), intercept))], ["feature", "weight"]
    )


def train(sample: DataFrame) -> tuple[np.ndarray, float]:
    """The sample is bounded and lies in one partition, so one task walks it; 2 ** BITS weights at most come back."""
    model = small_batches(sample).mapInArrow(_train, "feature long, weight double").toPandas()
    weights, intercept = np.zeros(1 << BITS, np.float32), 0.0
    for f, w in zip(model["feature"], model["weight"]):
        if f < 0:
            intercept = float(w)
        else:
            weights[f] = w
    return weights, intercept


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = MODULUS, held_out: int = HELD_OUT, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    n0, n1 = class_counts(labels, label, modulus, held_out)
    weights, intercept = np.zeros(1, np.float32), 0.0
    if n0 and n1:
        weights, intercept = train(training_sample(docs, labels, label, modulus, held_out, per_class))
        # The sample has min(n, per_class) of each class; all labels have other shares.
        intercept += math.log(n1 / n0) - math.log(min(n1, per_class) / min(n0, per_class))
    elif n0 + n1:
        intercept = 35.0 if n1 else -35.0
    model = docs.sparkSession.sparkContext.broadcast((weights, intercept))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (w, b0) = TokenHashes(), model.value
        for b in batches:
            texts = b.column("text").to_pylist()
            out = [np.zeros(0)]
            for lo, hi in slices([len(t or "") for t in texts], 1_000_000):
                part = texts[lo:hi]
                m = margins(*features(part, hashes), w) if len(w) > 1 else np.zeros(len(part))
                out.append(1 / (1 + np.exp(-np.clip(m + b0, -35, 35))))
            scores = np.concatenate(out)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (bucket_of(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    return small_batches(rows).mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
