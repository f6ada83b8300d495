"""Quality classifier with supervised subword embeddings.

A document's features are its words, its pairs of neighbouring words (a word
that follows itself is one feature of its own, whatever the word) and its
character n-grams, all hashed to rows of one embedding table.  Their vectors
are averaged and a softmax layer gives the two classes.  Table and layer are
trained by stochastic gradient descent in numpy, in one task over a bounded
sample of labelled rows.  To score, the table is multiplied by the layer
once, so that a feature costs one look-up.

Cases: null and empty texts have no features and get the layer's bias; very
long texts are read whole; rows and repeats stay; other columns are ignored;
without rows of both labels every score is 0.5; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import SpanHash, byte_view, slices, word_spans
from tributary.llm.labelled import fit_in_task, fold, sample

BITS, DIM = 18, 8
NGRAMS = (3, 4)
# Bounds of the training sample: rows of each class, bytes of a text.
PER_CLASS = {0: 2000, 1: 4000}
MAX_BYTES = 20_000
EPOCHS, RATE = 6, 2.0

NOT_SPACE = np.array([b not in (32, 9, 10, 11, 12, 13) for b in range(256)])
_SHIFT = np.uint32(32 - BITS)


def _gram_buckets(buf: np.ndarray, n: int) -> np.ndarray:
    packed = np.zeros(max(0, len(buf) - n + 1), np.uint32)
    for j in range(n):
        packed |= buf[j:j + len(packed)].astype(np.uint32) << np.uint32(8 * j)
    packed += np.uint32(n)
    packed *= np.uint32(2654435761)
    packed ^= packed >> np.uint32(15)
    packed *= np.uint32(2246822519)
    return packed >> _SHIFT


def features(buf: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of features (buckets, first, last): text k has the buckets
    first[k]..last[k] of each group."""
    groups = []
    for n in NGRAMS:
        first = np.minimum(offsets[:-1], max(0, len(buf) - n + 1))
        groups.append((_gram_buckets(buf, n), first, np.maximum(first, offsets[1:] - n + 1)))
    starts, ends, first = word_spans(buf, offsets, NOT_SPACE)
    words = SpanHash(buf)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    low = np.uint64(64 - BITS)
    groups.append(((words >> low).astype(np.uint32), first[:-1], first[1:]))
    pairs = (words[:-1] * np.uint64(3) + words[1:]) * np.uint64(0x9E3779B97F4A7C15)
    pairs[words[:-1] == words[1:]] = 0
    groups.append(((pairs >> low).astype(np.uint32), np.minimum(first[:-1], len(pairs)), np.maximum(np.minimum(first[:-1], len(pairs)), first[1:] - 1)))
    return groups


def train(rows: list[tuple[str, int]]) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias) of the logit of class 1."""
    rng = np.random.default_rng(7)
    table = (rng.standard_normal((1 << BITS, DIM)) * 0.1).astype(np.float32)
    layer, bias = (rng.standard_normal((DIM, 2)) * 0.5).astype(np.float32), np.zeros(2, np.float32)
    docs = []
    for text, label in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        parts = [b[f[0]:e[0]] for b, f, e in features(raw, np.array([0, len(raw)]))]
        bucket, count = np.unique(np.concatenate(parts), return_counts=True)
        docs.append((bucket, (count / max(1, count.sum())).astype(np.float32), label))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(docs)):
            bucket, share, label = docs[i]
            rows_of = table[bucket]
            mean = share @ rows_of
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= rate * 0.1 * np.outer(mean, p)
            bias -= rate * 0.02 * p
            table[bucket] = rows_of - (rate * len(bucket) ** 0.5) * share[:, None] * back
    slope = layer[:, 1] - layer[:, 0]
    return table @ slope, float(bias[1] - bias[0])


def text_scores(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    buf, offsets = byte_view(column)
    total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    for bucket, first, last in features(buf, offsets):
        sums = np.concatenate([[0.0], np.cumsum(weights[bucket], dtype=np.float64)])
        total += sums[last] - sums[first]
        count += last - first
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> tuple[np.ndarray, float]:
    model = fit_in_task(sample(docs, labels, "quality", fold(folds) != held_out, PER_CLASS, MAX_BYTES), train)
    return model or (np.zeros(1 << BITS, np.float32), 0.0)


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.7, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one float for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text_scores(batch.column("text"), *shared.value))],
                                             names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")) \
        .mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (fold(folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
