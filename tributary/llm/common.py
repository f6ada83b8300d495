"""Helpers shared by the operators: bounded slices of Arrow batches, byte
views of text columns, vectorised span hashes, and shared-folder staging."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import cut_lineage

# Text held by one numpy pass; a single longer text is a pass of its own.
SLICE_BYTES = 1 << 20
# Pairs of blocks that a Python worker gets at a time.
PAIR_BYTES = 8 << 20

_LIBC = ctypes.CDLL(None)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def batches_of(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Jobs started inside send their Python workers Arrow batches of at most
    about ``size`` bytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    if size:
        spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, then let
    Spark drop the shuffle files of the finished job (it does so when the
    plan objects behind them are collected).  ``batch_bytes`` bounds the Arrow
    batches that its Python workers are sent meanwhile."""
    with batches_of(df.sparkSession, batch_bytes):
        out = cut_lineage(df)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return out


def paired(blocks: DataFrame, given: DataFrame, on: str) -> DataFrame:
    """Each row of ``blocks`` with each of ``given`` that is equal in ``on``, both
    read from files: a task reads a part of each and pairs them, so a pair is
    neither shuffled nor broadcast."""
    return blocks.join(given.hint("shuffle_replicate_nl"), on)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The batch's rows; binary values are views of its buffers."""
    names = batch.schema.names
    binary = [pa.types.is_binary(t) or pa.types.is_large_binary(t) for t in batch.schema.types]
    for i in range(batch.num_rows):
        yield {name: column[i].as_buffer() if b else column[i].as_py() for name, column, b in zip(names, batch.columns, binary, strict=True)}


def with_row(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the whole row as the struct ``row``: columns that a
    step adds can't clash with the row's own.  ``row_again`` undoes it."""
    return docs.select("doc_id", "text", F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"))


def row_again(df: DataFrame, columns: list[str], changed: dict | None = None) -> DataFrame:
    """The rows' own ``columns``, with ``changed`` (name to Column) in their places."""
    return df.select(*[((changed or {}).get(c, F.col(f"row.{_quoted(c)}"))).alias(c) for c in columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_partitions(df: DataFrame, columns: list[str], bytes_each: int, factor: float = 1.0) -> int:
    """How many partitions hold ``factor`` times the bytes of ``columns`` at
    ``bytes_each`` bytes a partition; at least the session's parallelism."""
    total = df.select(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0).cast("long")).alias("n"))
    n = total.agg(F.sum("n")).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-int(n * factor) // bytes_each))


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column without copying the bytes;
    a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    dtype = np.int64 if wide else np.int32
    offsets = (np.frombuffer(offs, dtype)[column.offset:column.offset + len(column) + 1].astype(np.int64)
               if len(column) else np.zeros(1, np.int64))
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return raw[lo:hi], offsets - lo


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each
    (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = byte_view(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    release()


def release() -> None:
    """Give freed memory back to the system, which a reused worker keeps otherwise."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def _powers(base: np.uint64, n: int, kept: dict = {}) -> np.ndarray:  # noqa: B006 - one table per worker
    table = kept.get(int(base))
    if table is None or len(table) < n:
        size = max(n, SLICE_BYTES + 1)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        if size <= SLICE_BYTES + 1:
            kept[int(base)] = table
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class SpanHash:
    """64-bit polynomial hashes of any spans of one byte buffer."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.sums = np.zeros(n + 1, np.uint64)
        terms = buf.astype(np.uint64)
        terms += np.uint64(1)
        terms *= _powers(_BASE, n + 1)[:n]
        np.cumsum(terms, out=self.sums[1:])
        self.inverse = _powers(_BASE_INV, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def every(self, length: int) -> np.ndarray:
        """Hash of each span of ``length`` bytes, by start."""
        n = len(self.sums) - 1
        if n < length:
            return np.zeros(0, np.uint64)
        return mix((self.sums[length:] - self.sums[:n - length + 1]) * self.inverse[:n - length + 1])


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[buf]


def word_spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes that don't cross texts: (starts, ends,
    first): ``first[k]`` is the number of words before text ``k``.
    ``is_word`` has a flag for each of the 256 byte values."""
    inside = is_word[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    if len(buf):
        edge[0] = edge[-1] = True
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = inside[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(starts, offsets)
