"""Byte-level BPE and token files against the public libraries."""

import base64
import json
import random
import sys
import zlib

import numpy as np
import pyarrow.fs as pafs
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from tributary.llm import bpe, pretokens, queries, token_files

TEXTS = ["Hello world's  end\n\n it'll 've\tdo", "", None, "naïve café — ½ ² Ⅷ ١٢ 漢字 🙂 x\x1cy", "''s  'station _a_b __ 12a", " " * 300 + "x",
         "word " * 3000, "<|endoftext|> is text", "x" * 5000, "a b\u0085c"]
SCHEMA = "doc_id long, text string, token_ids string"


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_fast_cut_is_the_pattern_below_0250():
    latin, every = pretokens.splitter(pretokens.PUBLIC), regex.compile(P.PATTERN).findall
    assert pretokens.PUBLIC == P.PATTERN
    rng = random.Random(1)
    chars = [chr(c) for c in range(0x300)]
    for text in [*(f"a{c} {c}{c}1{c}'s" for c in chars), *("".join(rng.choices(chars + [" "] * 300 + ["'"] * 50, k=80)) for _ in range(500))]:
        assert latin(text) == every(text)
    assert sys.maxunicode == 0x10FFFF


def test_bpe_round_trip(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "again"), (None, "null id", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = bpe.load(spark, P.path("byte_bpe_50k.tiktoken"))
    coded = bpe.decode(bpe.encode(df, model, P.PATTERN), model, P.PATTERN)
    assert coded.columns == ["doc_id", "text", "token_ids", "decoded"]
    for r in coded.collect():
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    whole = {(r.doc_id, bytes(r.token_ids), bytes(r.decoded)) for r in bpe.round_trip(df, model, P.PATTERN).collect()}
    assert whole == {(r.doc_id, bytes(r.token_ids), bytes(r.decoded)) for r in coded.collect()}
    assert bpe.digests(df.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_memory_forgets_without_changing_results(reference):
    codec = bpe.Codec(bpe.piece_model(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))), P.PATTERN)
    codec.memory.generation = 3
    for _ in range(3):
        for t in TEXTS:
            assert np.frombuffer(codec.memory.many([t or ""])[0], "<u4").tolist() == reference.encode_ordinary(t or "")


def test_token_files(spark, tmp_path):
    rows = [(9 - i, t, "x") for i, t in enumerate(TEXTS)] + [(4, "same id", "x"), (None, "no id", "x")]
    folder = f"file://{tmp_path}/out"
    df = spark.createDataFrame(rows, SCHEMA)
    token_files.write(df, folder, P.path("byte_bpe_50k.json"), P.PATTERN)
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tk.encode_special_tokens = True
    want = {}
    for d, t, _ in rows:
        want.setdefault(d, []).append(tk.encode(t or "", add_special_tokens=False).ids + [0])
    got = sorted(token_files.read(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(want, key=lambda d: (d is not None, d))[:1] + sorted(d for d, *_ in rows if d is not None)
    at = 0
    for r in got:
        ids = np.frombuffer(bytes(r.token_ids), "<u4").tolist()
        assert ids in want[r.doc_id] and r.start == at and r.n_tokens == len(ids)
        at += len(ids)
    some = token_files.read(spark, folder, [4, 9, 12345]).collect()
    assert sorted((r.doc_id, r.start) for r in some) == sorted((r.doc_id, r.start) for r in got if r.doc_id in (4, 9))
    crc = {(r.start, r.ids_crc32) for r in token_files.digests(df, P.path("byte_bpe_50k.json"), P.PATTERN).collect()}
    assert crc == {(r.start, zlib.crc32(bytes(r.token_ids))) for r in got}
    assert token_files.digests(df.limit(0), P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


def test_equal_rows_fill_several_files(spark, tmp_path, monkeypatch):
    """A third of the rows equal in id and text: spread over files, positions right."""
    monkeypatch.setattr(token_files, "FILE_TEXT_BYTES", 2000)
    monkeypatch.setattr(token_files, "FILE_GROUP", 3)
    rows = [(5, "the same row " * 8)] * 100 + [(i, f"row {i} " * (i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    folder = str(tmp_path / "files")
    manifest = token_files.write(df, folder, P.path("byte_bpe_50k.json"), P.PATTERN)
    assert manifest.where("first_doc = 5").count() > 2
    got = sorted(token_files.read(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    lone = token_files.TextEncoder(open(P.path("byte_bpe_50k.json"), encoding="utf-8").read(), P.PATTERN, False)
    texts = sorted((lone.many([t])[0] + bytes(4) for _, t in rows))
    assert sorted(bytes(r.token_ids) for r in got) == texts


def test_added_tokens_get_their_ids(spark, tmp_path):
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert tk.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    end = "<|endoftext|>"
    texts = [*TEXTS, f"a {end} b", end, f"{end}{end}", f"  {end}\n\n{end} é漢 <|endoftext|", f"<|{end}x{end}", "none"]
    want = [tk.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    got = sorted(queries.QUERIES["op9_token_files"](spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    assert len(got) == len(texts)
    for r, ids in zip(got, want, strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_added_tokens_with_flags_are_the_librarys():
    definition = json.load(open(P.path("byte_bpe_50k.json"), encoding="utf-8"))
    strip = {**definition["added_tokens"][0], "content": "<s>", "id": 50257, "lstrip": True, "rstrip": True}
    longer = {**definition["added_tokens"][0], "content": "<|endoftext|>s", "id": 50258}  # the library numbers it 50257
    texts = ["a <s> b", "a<s>", "<|endoftext|>s <|endoftext|> t", "plain", ""]
    for tokens in ([strip], [longer]):
        text = json.dumps({**definition, "added_tokens": definition["added_tokens"] + tokens})
        tk = Tokenizer.from_str(text)
        got = [np.frombuffer(b, "<u4").tolist() for b in token_files.TextEncoder(text, P.PATTERN, True).many(texts)]
        assert got == [tk.encode(t, add_special_tokens=False).ids for t in texts]


def test_damaged_frame_is_found(tmp_path):
    fs, path = pafs.LocalFileSystem(), str(tmp_path / "one.zst")
    with fs.open_output_stream(path, compression=None) as out:
        writer = token_files.FrameWriter(out)
        for i in range(3):
            writer.add(i, np.arange(50 * (i + 1), dtype="<u4").tobytes())
        writer.finish()
    with fs.open_input_file(path) as source:
        reader = token_files.FrameReader(source)
        assert reader.ids == [0, 1, 2] and len(reader.ids_of(2)) == 600
        reader.check = reader.check + 1
        with pytest.raises(ValueError):
            reader.ids_of(1)
