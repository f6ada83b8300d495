"""SimHash and suffix dedup, decontamination and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from tributary.llm import decontamination, simhash, suffix_dedup
from tributary.llm.components import connected_components
from tributary.llm.suffix_array import suffix_ranks

DOCS = "doc_id long, text string, lang string, _key string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    words = ["alpha", "Ärger", "be", "c", "delta!", "Epsilon,", "zeta", "été", "theta", "iota", "k2", "lambda", "mu", "nu"]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage, line = text(25), text(14)
    rows = [(i, text(rng.randint(1, 60))) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(5)]                                   # copies
    rows += [(n + 10 + i, line + "\n" + text(30) + " " + passage + " " + text(5)) for i in range(8)]
    rows += [(n + 30, None), (n + 31, ""), (n + 32, "  \t "), (n + 33, "word " * 5000), (None, rows[3][1]), (7, rows[7][1]), (7, text(40))]
    return [(d, t, "en", "x") for d, t in rows], passage


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_matches_brute_force(spark):
    rows, _ = corpus()
    rows += [(200 + i, "one two three four five six seven eight nine ten " * 30 + f"tail{i}", "en", "x") for i in range(20)]
    got = sorted((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect())
    fps = np.array([fingerprint(t) for _, t, *_ in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(rows))
    while not np.array_equal(label, new := np.array([label[near[i]].min() for i in range(len(rows))])):
        label = new
    least = {k: min((rows[i][0] for i in np.flatnonzero(label == k) if rows[i][0] is not None), default=None) for k in set(label)}
    want = sorted((r[0] is None, r[0], f"{int(fps[i]):016x}", least[label[i]]) for i, r in enumerate(rows))
    assert got == want


def test_simhash_links_through_many_leaves_and_cells(spark, monkeypatch):
    """The tree, cut cells and the sample by hash, end to end against brute force."""
    for name, size in {"HOMES": 40, "VISITORS": 150, "LEAST_SAMPLE": 64, "LEAF_SAMPLE": 2}.items():
        monkeypatch.setattr(simhash, name, size)
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    steps = [base]
    for _ in range(4):
        steps.append(steps[-1] ^ (np.uint64(1) << rng.integers(0, 62, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 62, 300, dtype=np.uint64)))
    dense = np.uint64(99) ^ (np.uint64(1) << rng.integers(0, 62, 400, dtype=np.uint64))
    fps = np.unique(np.concatenate([*steps, dense]))
    edges = simhash.links(spark.createDataFrame([(int(x),) for x in fps], "fp long"), 4)
    labels = {r.node: r.component for r in simhash.connected_components(edges).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    want = np.arange(len(fps))
    while not np.array_equal(want, new := np.array([want[near[i]].min() for i in range(len(fps))])):
        want = new
    assert [labels.get(int(x), int(x)) for x in fps] == [int(fps[k]) for k in want]


def test_simhash_keeps_one_of_each_group(spark):
    rows, _ = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == groups and len([i for i in ids if i != 7]) == len({i for i in ids if i != 7})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("leaves", [1, 4, 32])
def test_tree_meets_every_near_pair(leaves):
    rng = np.random.default_rng(leaves)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near]))
    tree = simhash.VantageTree(fps, leaves, 4)
    homes = tree.homes(fps)
    meets = {(int(i), leaf) for leaf, idx in tree.visits(fps, homes) for i in idx} | {(i, int(h)) for i, h in enumerate(homes)}
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    assert all((i, homes[j]) in meets or (j, homes[i]) in meets for i, j in zip(a.tolist(), b.tolist(), strict=True))


def test_dense_cells_give_a_forest():
    rng = np.random.default_rng(1)
    fps = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)))
    a, b = simhash.cell_links(fps, fps, 4)
    assert len(a) == len(fps) - 1 and set(b.tolist()) == {int(fps.min())}


def test_bitmap_grows_with_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BITMAP_LEAST", 1 << 15)
    hashes = spark.range(20000).selectExpr("xxhash64(id) AS hash", "5 AS length")
    bits, lengths = decontamination.bitmap_of(hashes)
    assert lengths == [5] and 16 * 20000 <= 8 * len(bits) * 1.1 and len(bits) * 8 <= 1 << 20
    held = np.array([r.hash for r in hashes.collect()], np.int64).view(np.uint64)
    assert decontamination._in_bitmap(bits, held).all()
    assert decontamination._in_bitmap(bits, np.random.default_rng(1).integers(0, 1 << 63, 20000, dtype=np.uint64)).mean() < 0.1
    assert decontamination.bitmap_of(hashes.limit(0))[1] == []


def brute_spans(rows, length=50):
    first: dict = {}
    raws = [(t or "").encode() for _, t, *_ in rows]
    for (d, *_), raw in zip(rows, raws, strict=True):
        for i in range(len(raw) - length + 1) if d is not None else ():
            s = raw[i:i + length]
            first[s] = min(first.get(s, d), d)
    out = []
    for (d, *_), raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1) if d is not None else ():
            if first[raw[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d is None, d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [100_000, 2])
def test_suffix_dedup_matches_brute_force(spark, hot):
    rows, _ = corpus(seed=hot)
    spans = suffix_dedup.cut_spans(spark.createDataFrame(rows, DOCS), hot=hot)
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in spans.collect())
    assert got == brute_spans(rows)


def test_suffix_shards_do_not_grow_with_one_gram(spark):
    rule = "-" * 100
    rng = random.Random(8)
    text = lambda: "".join(rng.choices("abcdefghij ", k=150))
    alone = "=" * 3000  # hot, but in one text only
    rows = [(i, f"{text()}\n{rule}\n{text()}", "en", "x") for i in range(300)] + [(900 + i, alone, "en", "x") for i in range(3)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {}
    for hot in (50, suffix_dedup.HOT):
        spans = suffix_dedup.cut_spans(docs, hot=hot)
        got[hot] = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in spans.collect())
        assert got[hot] == brute_spans(rows)
    base = suffix_dedup._keyed(docs).selectExpr("doc_id", "_key key", "_text text").repartition(4)
    sent = suffix_dedup.sent_hashes(base, 64, suffix_dedup.LENGTH, suffix_dedup.GRAM, 50)
    places = {}
    for r in sent.collect():
        places[r.shard] = places.get(r.shard, 0) + len(r["hash"]) // 8
    every = sum(places.values())
    assert every > 300 * 50 and max(places.values()) < 3 * every / 64
    table, shared = suffix_dedup.hot_hashes(base, 300 * 402 + 9000, 50, suffix_dedup.LENGTH, suffix_dedup.GRAM)
    assert len(table) >= 2 and shared.any() and not shared.all()


def test_suffix_dedup_cuts_whole_characters_and_recounts(spark):
    shared = "é" * 40
    rows = [(1, shared + "ab", 42), (2, "ü" + shared, 41), (3, "short", 5), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in suffix_dedup.cut_repeats(docs).collect()}
    assert got == {1: (shared + "ab", 42), 2: ("ü", 1), 3: ("short", 5), 4: (None, None)}
    assert suffix_dedup.digests(docs.limit(0)).count() == 0


def test_suffix_ranks_agree_with_prefixes():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 50, 1000):
        for k in (1, 2, 40):
            s = rng.integers(1, k + 1, n)
            wanted = np.flatnonzero(rng.random(n) < 0.5)
            order = np.argsort(suffix_ranks(s, 20, wanted), kind="stable")
            prefixes = [s[wanted[i]:wanted[i] + 20].tolist() for i in order]
            assert prefixes == sorted(prefixes)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_contamination_matches_brute_force(spark):
    rows, passage = corpus()
    items = [(1, passage), (10, "k2 mu nu"), (2, "alpha"), (3, None), (4, "!!"), (None, "lambda mu"), (5, passage)]
    got = decontamination.contamination(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect())
    windows = [(i, w[k:k + 10]) for i, t in items if (w := words(t)) for k in range(max(1, len(w) - 9))]
    want = []
    for d, t, *_ in rows:
        w = words(t)
        hit, ids = set(), set()
        for i, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k:k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    ids |= {str(i)} - {"None"}
        want.append((d is None, d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    assert got == sorted(want)


def test_contamination_of_empty_tables(spark):
    rows, _ = corpus()
    docs, items = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, "no such words here")], "item_id long, text string")
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    assert decontamination.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    kept = decontamination.remove_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(5, 5), (None, 3), (31, None)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
