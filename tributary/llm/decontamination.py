"""Benchmark decontamination as a prefix-filtered set join.

A benchmark text is cut into windows of ``window`` consecutive words; a text
of fewer words is one window.  A document word is hit if it lies in any
occurrence of a window.  A window is the set of its shingles (``shingle``
words each, with their positions).  It is wholly contained in a document only
if each of its shingles is, so one shingle is a sufficient prefix: the window's
rarest by its count over all documents.

1. Shingles of the benchmark, as 64-bit hashes, set the bits of a bitmap of at
   least 16 bits a shingle, from 2 MB up to 64 MB (beyond four million shingles a
   hash has to pass a fuller bitmap: more is shuffled, nothing is lost).
2. A pass over all documents counts the shingles that the bitmap lets
   through, summed inside each task before the shuffle: the rarity order.
3. A second pass emits the occurrences of prefix shingles (again behind a
   bitmap), each with the words around it, and they join the windows on the
   hash.  The place of the shingle in the window gives the window's start;
   starts before the document or ends beyond it are dropped (positional and
   length bounds), and the window's words are compared with the document's.
4. Occurrences become intervals, merged within a document.

Both passes read only a text's bytes in numpy; what is shuffled grows with
the contaminated passages, not with the corpus.  A passage that many
documents share is spread by document.

Cases: null texts and texts without a word have no words and are never hit;
items without a word have no window; a null item_id marks words but is not
listed; rows with the same doc_id are judged one by one; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import byte_view, lower_ascii, mix, row_again, slices, SpanHash, stage, with_row, word_spans

# Bits of the bitmap: least, most, and for each different hash.
BITMAP_LEAST, BITMAP_MOST, BITS_EACH = 1 << 24, 1 << 29, 16

# Word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` word hashes, by its first word."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, length, np.uint64)
    for j in range(length):
        h = mix(h + words[j:j + n])
    return h


def _words(batch: pa.RecordBatch):
    buf, offsets = byte_view(batch.column("text"))
    buf = lower_ascii(buf)
    starts, ends, first = word_spans(buf, offsets, IS_WORD)
    hashes = SpanHash(buf)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return buf, starts, ends, first, hashes


def windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """A row for each shingle of each window of each item: item_id, words (the
    window's words, one blank between), n (how many), at (the shingle's place
    in the window), length (words of the shingle), hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            buf, starts, ends, first, hashes = _words(batch)
            rows = []
            for k, item in enumerate(batch.column("item_id").to_pylist()):
                a, b = int(first[k]), int(first[k + 1])
                w = [bytes(buf[s:e]).decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)]
                n = min(window, len(w))
                if not n:
                    continue
                size = min(shingle, n)
                h = shingle_hashes(hashes[a:b], size).view(np.int64).tolist()
                rows += [(item, " ".join(w[i:i + n]), n, j, size, h[i + j])
                         for i in range(len(w) - n + 1) for j in range(n - size + 1)]
            if rows:
                item, words, n, at, size, h = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int64()), pa.array(words), pa.array(n, pa.int32()), pa.array(at, pa.int32()),
                     pa.array(size, pa.int32()), pa.array(h, pa.int64())], names=["item_id", "words", "n", "at", "length", "hash"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "item_id long, words string, n int, at int, length int, hash long")


def bitmap_of(hashes: DataFrame):
    """(bitmap, shingle lengths) of the column ``hash``: bounded by
    BITMAP_MOST bits, built by Spark in blocks of 32,768 bits."""
    wanted, size = BITS_EACH * hashes.agg(F.approx_count_distinct("hash")).first()[0], BITMAP_LEAST
    while size < min(wanted, BITMAP_MOST):
        size *= 2
    bit = F.pmod("hash", F.lit(size)) + 1  # blocks count from 1
    blocks = (hashes.groupBy(F.bitmap_bucket_number(bit).alias("block"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))).collect()
    out = np.zeros(size // 8, np.uint8)
    for row in blocks:
        out[(row.block - 1) * 4096:row.block * 4096] = np.frombuffer(row.bits, np.uint8)
    return out, sorted(r[0] for r in hashes.select("length").distinct().collect())  # at most ``shingle`` lengths


def _in_bitmap(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counts(docs: DataFrame, bitmap, lengths: list[int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

        for batch in slices(batches, "text"):
            *_, first, hashes = _words(batch)
            last = np.repeat(first[1:], np.diff(first))
            for length in lengths:
                h = shingle_hashes(hashes, length)
                h = h[np.arange(len(h)) + length <= last[:len(h)]]
                held.append(h[_in_bitmap(bitmap.value, h)])
            if sum(map(len, held)) > 500_000:
                yield flush()
        if sum(map(len, held)):
            yield flush()

    return docs.select("text").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


DOC = "row_key binary, doc_id long, n_words long, hash long, pos int, ctx_pos int, ctx string"


def _occurrences(docs: DataFrame, bitmap, lengths: list[int], window: int) -> DataFrame:
    """A row for each document (hash null), and one for each place where a
    shingle of the bitmap starts, with the words that a window around it can
    hold.  ``row_key`` is doc_id and a 128-bit digest of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            buf, starts, ends, first, hashes = _words(batch)
            ids, keys = batch.column("doc_id"), batch.column("row_key")
            counts = np.diff(first)
            n = len(counts)
            none = lambda kind, size: pa.nulls(size, kind)
            yield pa.RecordBatch.from_arrays([keys, ids, pa.array(counts), none(pa.int64(), n), none(pa.int32(), n),
                                              none(pa.int32(), n), none(pa.string(), n)],
                                             names=["row_key", "doc_id", "n_words", "hash", "pos", "ctx_pos", "ctx"])
            last = np.repeat(first[1:], counts)
            begin = np.repeat(first[:-1], counts)
            for length in lengths:
                h = shingle_hashes(hashes, length)
                at = np.flatnonzero((np.arange(len(h)) + length <= last[:len(h)]) & _in_bitmap(bitmap.value, h))
                for part in np.array_split(at, max(1, len(at) // 50_000)):
                    if not len(part):
                        continue
                    lo = np.maximum(part - (window - length), begin[part])
                    hi = np.minimum(part + window, last[part])
                    raw = buf.tobytes()
                    ctx = [b" ".join(raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)).decode()
                           for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                    doc = np.searchsorted(first, part, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(doc)), ids.take(pa.array(doc)), pa.array(counts[doc]), pa.array(h[part].view(np.int64)),
                         pa.array((part - begin[part]).astype(np.int32)), pa.array((lo - begin[part]).astype(np.int32)), pa.array(ctx)],
                        names=["row_key", "doc_id", "n_words", "hash", "pos", "ctx_pos", "ctx"])

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(row_key().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, DOC)


def row_key():
    """A document row's key: doc_id and a 128-bit digest of the text."""
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(" "), digest).cast("binary")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items
    (their ids) and row_key of every document."""
    spark = docs.sparkSession
    parts = stage(windows(items, window, shingle))
    bits, lengths = bitmap_of(parts)
    rarity = stage(_counts(docs, spark.sparkContext.broadcast(bits), lengths))

    # The prefix of each different window: its rarest shingle.  A shingle that
    # no document holds rules its window out.
    ranked = (parts.select("words", F.col("n").alias("size"), "at", "length", "hash").distinct()
              .join(rarity, "hash", "left").groupBy("words", "size")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "at", "length")).alias("least")))
    prefixes = stage(ranked.where("least.n > 0").select("words", "size", "least.hash", "least.at", "least.length"))
    bits, lengths = bitmap_of(prefixes)
    found = stage(_occurrences(docs, spark.sparkContext.broadcast(bits), lengths, window))

    start = F.col("pos") - F.col("at")
    near = found.where("hash is not null").join(prefixes, "hash").withColumn("start", start) \
        .where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    hits = near.where(F.array_join(F.slice(F.split("ctx", " "), F.col("start") - F.col("ctx_pos") + 1, F.col("size")), " ") == F.col("words")) \
        .select("row_key", "start", (F.col("start") + F.col("size")).alias("end"), "words").distinct()

    w = Window.partitionBy("row_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(w), F.lit(0))))
    n_hit = hits.select("row_key", new.alias("new")).groupBy("row_key").agg(F.sum("new").cast("long").alias("n_hit"))

    # Pairs of document and item, each once, before any list is made of them.
    owners = parts.where("item_id is not null").select("words", "item_id").distinct()
    listed = hits.select("row_key", "words").distinct().join(owners, "words").select("row_key", "item_id").distinct() \
        .groupBy("row_key").agg(F.collect_list("item_id").alias("items"))
    per_doc = n_hit.join(listed, "row_key", "left")

    none = F.array().cast("array<bigint>")
    items_col = F.coalesce("items", none)
    text_ids = F.array_sort(F.transform(items_col, lambda i: i.cast("string")))
    return found.where("hash is null").join(per_doc, "row_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_col).cast("long").alias("n_items"), F.sha2(F.array_join(text_ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.array_sort(items_col).alias("items"), "row_key")


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """The documents that hold no window of any item, with all columns."""
    found = contamination(docs.select("doc_id", "text"), items, window, shingle)
    bad = found.where("contaminated").select(F.col("row_key").alias("bad_key")).distinct()
    return row_again(with_row(docs).join(bad, row_key() == F.col("bad_key"), "left_anti"), docs.columns)
