"""Token ids in binary files of independent zstandard frames.

File layout (the public seekable zstandard format): one frame for each
document (its ids as little-endian unsigned 32-bit integers, with a content
checksum), a skippable frame with the document ids, and a trailing skippable
frame with the seek table: compressed size, decompressed size and checksum
(low half of XXH64) of each frame.  A reader takes the table from the end of
the file, seeks to the frames it needs and decompresses only those; any zstd
tool decompresses the whole file to the plain id stream.

Documents are written in ascending ``doc_id`` order: a range shuffle makes
each partition a run of ids, and a task writes its run to one file under a
fresh name.  The manifest (a table with one row for each file) is written by
Spark's commit protocol and names only the files of the attempts that
counted, so that lost executors and repeated tasks leave no trace but unused
files.

Cases: null and empty texts hold the end id alone; a null doc_id sorts first;
repeated doc_ids are kept, in order of their texts' hash, and equal rows in that of
their places in the input (so that many of them are several files); an added token's
string in a text (as ``<|endoftext|>``) gives its id with ``added``; an empty table gives
no file and no rows; other columns are not stored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm.bpe import byte_characters
from tributary.llm.common import batches_of, slices, text_partitions
from tributary.llm.pretokens import splitter
from tributary.session import checkpoint_dir

# Magic numbers of the public zstandard seekable format.
SKIPPABLE, SEEK_FRAME, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1

# Matches in each of the two generations that a worker remembers.
GENERATION = 700_000
# Longer matches (characters) are encoded anew each time.
REMEMBERED = 64
# Size of the Arrow batches that the encoding tasks read.
BATCH_BYTES = 4 << 20
FILE_TEXT_BYTES = 64 << 20
# Files whose first positions one task adds up.
FILE_GROUP = 1000
MANIFEST = "file string, part int, first_doc long, docs long, tokens long"
READ_BYTES = 8 << 20


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = re.sub(r"^file:/+", "file:///", uri)
    return pafs.FileSystem.from_uri(uri)


class _Ids(dict):
    """Packed ids by match: looked up in C, encoded when met first.  What the
    last generation held moves over."""

    def __init__(self, encode, old: dict):
        super().__init__()
        self.encode, self.old = encode, old

    def __missing__(self, match: str) -> bytes:
        ids = self.old.get(match)
        if ids is None:
            ids = self.encode(match)
        if len(match) <= REMEMBERED:
            self[match] = ids
        return ids


class TextEncoder:
    """Ids of whole texts by the tokenizers library.  The tokenizer's own
    pattern cuts a text into matches that its model encodes independently of
    each other, so each different match is encoded once and remembered.

    With ``added``, the definition's added tokens are found first, as the
    library's ``encode(text, add_special_tokens=False)`` does: each gives its
    own id, and the pieces between them are cut by the pattern.  Without, they
    are plain text (the library's ``encode_special_tokens``)."""

    def __init__(self, definition: str, pattern: str, added: bool):
        self.tokenizer, chars = Tokenizer.from_str(definition), dict(enumerate(byte_characters()))
        model = self.tokenizer.model

        def ids(match: str) -> bytes:
            return array("I", [t.id for t in model.tokenize(match.encode().decode("latin-1").translate(chars))]).tobytes()

        self.find, self.memory = splitter(pattern), _Ids(ids, {})
        tokens = [t for t in json.loads(definition).get("added_tokens") or () if t["content"]] if added else []
        self.ids = {t["content"]: struct.pack("<I", self.tokenizer.token_to_id(t["content"])) for t in tokens}
        # The longest of those that begin at one place, as in the library.
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(self.ids, key=len, reverse=True))) + ")") if tokens else None
        # Tokens that look at or take in their neighbours are left to the library.
        self.plain = not any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip"))

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without added tokens; text by text, so that a text's
        matches are still in the cache when they are looked up."""
        if len(self.memory) > GENERATION:
            self.memory = _Ids(self.memory.encode, dict(self.memory))
        get, find = self.memory.__getitem__, self.find
        return [b"".join(map(get, find(t))) for t in texts]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        held = [k for k, t in enumerate(texts) if self.added.search(t)] if self.added else []
        if not held:
            return self._pieces(texts)
        if not self.plain:
            own = {k: np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, "<u4").tobytes() for k in held}
            coded = self._pieces(["" if k in own else t for k, t in enumerate(texts)])
            return [own.get(k, c) for k, c in enumerate(coded)]
        cut = {k: self.added.split(texts[k]) for k in held}  # piece, token, piece, ...
        coded = self._pieces([*("" if k in cut else t for k, t in enumerate(texts)), *(p for k in held for p in cut[k][::2])])
        out, rest = coded[:len(texts)], iter(coded[len(texts):])
        for k in held:
            out[k] = b"".join(self.ids[p] if i % 2 else next(rest) for i, p in enumerate(cut[k]))
        return out


_ENCODERS: dict[int, TextEncoder] = {}


def _encoder(shared, pattern: str, added: bool) -> TextEncoder:
    key = hash((shared.value, pattern, added))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TextEncoder(shared.value, pattern, added)
    return _ENCODERS[key]


class FrameWriter:
    """Writes one file; frames go out as they are made, only the table waits."""

    def __init__(self, stream):
        self.stream, self.entries, self.ids, self.tokens = stream, [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.stream.write(frame)
        self.entries.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.tokens += len(ids) // 4

    def finish(self) -> None:
        index = np.array([i or 0 for i in self.ids], "<i8").tobytes() + bytes(i is not None for i in self.ids)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.entries.append(struct.pack("<III", len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), 0x80, SEEK_FOOTER)
        self.stream.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEK_FOOTER or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        table = np.frombuffer(source.read_at(12 * count, size - 9 - 12 * count), "<u4").reshape(-1, 3)
        self.size, self.raw_size, self.check = (table[:, i].astype(np.int64) for i in range(3))
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        n = count - 1
        index = source.read_at(int(self.size[-1]) - 8, int(self.at[-2]) + 8)
        ids, known = np.frombuffer(index[:8 * n], "<i8"), np.frombuffer(index[8 * n:], np.uint8)
        self.ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.first = np.concatenate([[0], np.cumsum(self.raw_size[:n] // 4)])
        self.decompressor = zstandard.ZstdDecompressor()

    def ids_of(self, k: int) -> bytes:
        raw = self.decompressor.decompress(self.source.read_at(int(self.size[k]), int(self.at[k])),
                                           max_output_size=max(1, int(self.raw_size[k])))
        if len(raw) != self.raw_size[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.check[k]:
            raise ValueError(f"checksum mismatch in frame {k}")
        return raw


def write(df: DataFrame, folder: str, tokenizer_path: str, pattern: str, end_id: int = 0, added: bool = False) -> DataFrame:
    """Encode ``text`` of every row and write the files below ``folder``;
    returns the manifest: file, part (files in document order), first_doc
    (documents before it are in earlier files), docs, tokens.  ``added``: the
    tokenizer's added tokens in a text get their own ids."""
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # bounded by the vocabulary
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, stream, first = _encoder(shared, pattern, added), None, None, None
        for batch in slices(batches, "text"):
            coded = encode.many([t or "" for t in batch.column("text").to_pylist()])
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                if writer is None:
                    fs, base = open_folder(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zst"
                    stream, first = fs.open_output_stream(f"{base}/{name}", compression=None), doc_id
                    writer = FrameWriter(stream)
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.finish()
            stream.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "first_doc": pa.array([first], pa.int64()),
                                              "docs": [len(writer.ids)], "tokens": [writer.tokens]})

    n = text_partitions(df, ["text"], FILE_TEXT_BYTES)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("place")]
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("place"))
    runs = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    path = f"{folder.rstrip('/')}/manifest"
    with batches_of(spark, BATCH_BYTES):
        runs.mapInArrow(run, MANIFEST).write.parquet(path)
    return spark.read.parquet(path)


def read(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and token_ids
    (binary) of all documents, or of ``doc_ids`` alone: then only their frames
    are decompressed.  The first position of each file comes from the manifest (a
    row a file) by prefix sums in two levels: over groups of FILE_GROUP files, and
    inside each."""
    manifest = spark.read.parquet(f"{folder.rstrip('/')}/manifest") \
        .select("file", "part", "tokens", F.floor(F.col("part") / FILE_GROUP).alias("group"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    groups = manifest.groupBy("group").agg(F.sum("tokens").alias("n")) \
        .select("group", F.coalesce(F.sum("n").over(earlier.orderBy("group")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("tokens").over(earlier.partitionBy("group").orderBy("part")), F.lit(0))
    listed = manifest.withColumn("inside", inside).join(groups, "group") \
        .select("file", "part", (F.col("base") + F.col("inside")).cast("long").alias("start"))
    wanted = None if doc_ids is None else frozenset(doc_ids)
    schema = "doc_id long, start long, n_tokens long, token_ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            cols = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 3 + (pa.binary(),), strict=True)],
                                              names=["doc_id", "start", "n_tokens", "token_ids"])

        for batch in batches:
            for name, base_start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                fs, base = open_folder(folder)
                with fs.open_input_file(f"{base}/{name}") as source:
                    reader, rows, held = FrameReader(source), [], 0
                    for k, doc_id in enumerate(reader.ids):
                        if wanted is not None and doc_id not in wanted:
                            continue
                        ids = reader.ids_of(k)
                        rows.append((doc_id, base_start + int(reader.first[k]), len(ids) // 4, ids))
                        held += len(ids)
                        if held > READ_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    return listed.repartitionByRange(max(1, manifest.count()), "part").select("file", "start").mapInArrow(run, schema)


def digests(df: DataFrame, tokenizer_path: str, pattern: str, added: bool = False) -> DataFrame:
    """Write every text, read the files back: doc_id, start, n_tokens and the
    crc32 of the ids."""
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write(df, folder, tokenizer_path, pattern, added=added)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))
