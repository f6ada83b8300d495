"""Bounded samples of labelled documents, and models fitted on them in one
task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import release


def fold(folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds`` (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: dict[int, int], max_bytes: int) -> DataFrame:
    """(text, label) of labelled documents: of each class at most so many
    rows as ``per_class`` says, the first by a hash of doc_id, among rows where
    ``learn`` holds and whose text has at most ``max_bytes`` bytes; of a repeated
    doc_id the least text.  Texts that
    nobody labelled, null labels and null texts are left out."""
    short = docs.where(F.octet_length("text") <= max_bytes).where(learn)
    known = labels.where(learn).select("doc_id", F.col(label).cast("int").alias("label")).distinct().join(short, "doc_id", "left_semi")
    chosen = None
    for value, most in sorted(per_class.items()):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    # At most sum(per_class) ids, and of each one text, so that rows of a repeated id don't add up.
    rows = short.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")


def fit_in_task(rows: DataFrame, train: Callable[[list[tuple[str, int]]], object]):
    """The model that ``train`` makes of (text, label) rows, in a fixed order,
    or None without rows of two labels.  One task: the rows are a bounded
    sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted({r for b in batches for r in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True)})
        model = train(held) if len({y for _, y in held}) > 1 else None
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})
        del held, model
        release()

    made = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0].model) if made else None
