"""Byte-level BPE encoding and decoding with a sentencepiece model that is
serialised here straight from a rank file.

Each of the 256 bytes is written as one printable character, so that every
vocabulary entry (a byte string) becomes a piece; a piece's score is its
negative rank, so that sentencepiece merges the pair of lowest rank first,
leftmost among equals, as the rank-based encoder does.  The normaliser is the
identity: no dummy prefix, no white-space handling.  Texts are cut by the
tokenizer's pattern and each match is encoded alone; a match that is itself a
vocabulary entry is that entry.  Decoding maps ids back to pieces and pieces
back to bytes.

Token ids travel as BINARY: little-endian unsigned 32-bit integers.

Cases: null and empty texts have no ids and decode to no bytes; rows, repeats
and other columns are kept as they are; a column that has the output's name is
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import slices
from tributary.llm.pretokens import Memory


# Matches in each of the two generations that a worker remembers.
GENERATION = 150_000


def read_ranks(path: str) -> list[bytes]:
    """Byte strings by rank, of a file with a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def byte_characters() -> list[str]:
    """A printable character for each byte: Latin-1 letters and marks stand
    for themselves, all others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def piece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model: piece ``r`` is the token of rank
    ``r``, and the unknown piece is the last."""
    # Field numbers and enum values of the public model format.
    unknown_type, bpe_type = 2, 2
    chars = byte_characters()
    out = []
    for rank, token in enumerate(tokens):
        piece = "".join(chars[b] for b in token).encode()
        out.append(_field(1, _field(1, piece) + _field(2, float(-rank))))
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown_type)))
    trainer = _field(3, bpe_type) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(i, -1) for i in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(i, 0) for i in (3, 4, 5))
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one model in one process."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        chars = byte_characters()
        self.to_chars = dict(enumerate(chars))
        back = {c: b for b, c in enumerate(chars)}
        self.token = [bytes(back[c] for c in self.processor.id_to_piece(i)) for i in range(self.processor.get_piece_size() - 1)]
        self.rank = {t: i for i, t in enumerate(self.token)}
        self.memory = Memory(self._ids, pattern, GENERATION)

    def _ids(self, matches: list[str]) -> list[list[int]]:
        raw = [m.encode() for m in matches]
        ids = self.processor.encode([r.decode("latin-1").translate(self.to_chars) for r in raw], out_type=int, num_threads=1)
        return [[r] if (r := self.rank.get(b)) is not None else i for b, i in zip(raw, ids, strict=True)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(model, pattern: str) -> Codec:
    key = (model.value[0], pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model.value[1], pattern)
    return _CODECS[key]


def load(spark, path: str):
    """The model of a rank file as a broadcast (bounded by the vocabulary)."""
    model = piece_model(read_ranks(path))
    return spark.sparkContext.broadcast((hash(model), model))


def encode(df: DataFrame, model, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """``df`` with the token ids of ``text`` (binary, 4 bytes an id)."""
    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        codec, out = _codec(model, pattern), []
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for part in slices(iter([batch]), "text"):
            out += codec.memory.many(part.column("text").to_pylist())
        return pa.array(out, pa.binary())

    return df.withColumn(out, ids(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, model, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the token ids stand for."""
    @F.arrow_udf("binary")
    def raw(blobs: pa.Array) -> pa.Array:
        codec = _codec(model, pattern)
        return pa.array([codec.decode(b.as_py() or b"") for b in blobs], pa.binary())

    return df.withColumn(out, raw(F.col(ids)))


def round_trip(df: DataFrame, model, pattern: str) -> DataFrame:
    """doc_id, token_ids and decoded of each text, by one worker a task that
    forgets its matches at the task's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, pattern)
        for part in slices(batches, "text"):
            ids = codec.memory.many(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.binary())],
                                             names=["doc_id", "token_ids", "decoded"])
        codec.memory.forget()

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")) \
        .mapInArrow(run, "doc_id long, token_ids binary, decoded binary")


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    coded = round_trip(df, load(df.sparkSession, path), pattern)
    return coded.select("doc_id", (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
