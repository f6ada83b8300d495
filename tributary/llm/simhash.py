"""SimHash near-duplicates: fingerprints of word shingles, linked within a
Hamming distance by a vantage-point tree.

The tree is grown on the driver from a sample of different fingerprints,
LEAF_SAMPLE for each leaf wanted (one leaf for 4,096 fingerprints) and a million,
8 MB, at most: an inner node is a vantage point and the median distance to it;
a leaf is a shard.  Each fingerprint has one home shard, and visits every
later shard that the triangle bound leaves open (its ball of radius
``distance`` reaches over the boundary), so that each pair within the distance
meets in exactly the home shard of one of them.  Shards over a fixed size are
cut into cells (a chunk of homes times a block of visitors), which bounds every
group whatever the data.  A cell compares all its pairs with XOR and bit
counts and emits a spanning forest of the links, never the pairs themselves.
Components over those links come from distributed star steps, and equal
fingerprints are one node throughout.

Cases: null texts and texts without words have fingerprint 0 and are linked
like any other; a text of fewer words than a shingle is one shingle; repeated
doc_ids and rows stay; null doc_ids take part and are the component's id only
if all are null (then null); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import byte_view, lower_ascii, mix, row_again, slices, stage, with_row, word_spans
from tributary.llm.components import connected_components

# Fingerprints that the tree is grown from, at least and at most; a leaf keeps LEAF_SAMPLE.
LEAST_SAMPLE, TREE_SAMPLE, LEAF_SAMPLE = 1 << 14, 1 << 20, 8
# Homes of a cell and visitors of a cell, in the mean at most.
HOMES, VISITORS = 4096, 1 << 17
SEED = 42  # of the shingle hash

NOT_SPACE = np.array([b not in (32, 9, 10, 11, 12, 13) for b in range(256)])


def text_fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    """The 64-bit fingerprint of each text of a column."""
    buf, offsets = byte_view(column)
    buf = lower_ascii(buf)
    starts, ends, first = word_spans(buf, offsets, NOT_SPACE)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out
    # One blank after each word: a shingle is then one slice of the bytes.
    sizes = ends - starts + 1
    place = np.concatenate([[0], np.cumsum(sizes)])
    joined = np.full(place[-1], 32, np.uint8)
    word = np.ones(len(joined), bool)
    word[place[1:] - 1] = False
    joined[word] = buf[NOT_SPACE[buf]]
    raw = joined.tobytes()
    words = np.diff(first)
    n = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    last = np.repeat(first[1:], n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1], n)
    begin, end = place[at], place[np.minimum(at + shingle, last)] - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(raw[a:b], SEED) for a, b in zip(begin.tolist(), end.tolist(), strict=True)], "<u8")
    full = np.flatnonzero(n)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, (np.cumsum(n) - n)[full], axis=0, dtype=np.int32)
    out[full] = np.packbits(ones * 2 > n[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_key, fp) of every row; text_key is a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = text_fingerprints(batch.column("text"), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "text_key", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, text_key long, fp long")


def text_key():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


class VantageTree:
    """Inner nodes (vantage, radius, inside, outside) and leaves (a number)."""

    def __init__(self, sample: np.ndarray, leaves: int, distance: int):
        self.distance, self.leaves = distance, 0
        depth = max(0, math.ceil(math.log2(max(1, leaves))))
        self.root = self._grow(np.unique(sample), depth)

    def _grow(self, points: np.ndarray, depth: int):
        if depth == 0 or len(points) < 2 * LEAF_SAMPLE:
            self.leaves += 1
            return self.leaves - 1
        tried = points[np.linspace(0, len(points) - 1, 16).astype(int)]
        d = np.bitwise_count(tried[:, None] ^ points[None, :]).astype(int)
        middle = np.median(d, axis=1).astype(int)
        # The vantage point whose boundary the fewest balls reach over.
        best = int(np.argmin((np.abs(d - middle[:, None]) <= self.distance).sum(axis=1)))
        inside = d[best] <= middle[best]
        if inside.all():
            middle[best] -= 1
            inside = d[best] <= middle[best]
        if not inside.any() or inside.all():
            self.leaves += 1
            return self.leaves - 1
        low = self._grow(points[inside], depth - 1)
        return tried[best], int(middle[best]), low, self._grow(points[~inside], depth - 1)

    def homes(self, fps: np.ndarray) -> np.ndarray:
        out = np.zeros(len(fps), np.int32)
        todo = [(self.root, np.arange(len(fps)))]
        while todo:
            node, idx = todo.pop()
            if isinstance(node, int):
                out[idx] = node
                continue
            inside = np.bitwise_count(fps[idx] ^ node[0]) <= node[1]
            todo += [(node[2], idx[inside]), (node[3], idx[~inside])]
        return out

    def visits(self, fps: np.ndarray, homes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, indices of the fingerprints that visit it from an earlier leaf)."""
        todo = [(self.root, np.arange(len(fps)))]
        while todo:
            node, idx = todo.pop()
            if isinstance(node, int):
                if len(idx := idx[homes[idx] < node]):
                    yield node, idx
                continue
            d = np.bitwise_count(fps[idx] ^ node[0]).astype(int)
            todo += [(node[2], idx[d <= node[1] + self.distance]), (node[3], idx[d > node[1] - self.distance])]


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each node 0..n-1 the least node that the edges (a, b) lead to."""
    label = np.arange(n)
    while len(a):
        m = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, before[a], m)
        np.minimum.at(label, before[b], m)
        np.minimum.at(label, a, m)
        np.minimum.at(label, b, m)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
        if np.array_equal(label, before):
            break
    return label


def cell_links(homes: np.ndarray, visitors: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between homes and visitors of a cell."""
    nodes = np.unique(np.concatenate([homes, visitors]))
    h, v = np.searchsorted(nodes, homes), np.searchsorted(nodes, visitors)
    ea, eb, held = [], [], 0
    step = max(1, (1 << 20) // max(1, len(homes)))
    for at in range(0, len(visitors), step):
        near = np.bitwise_count(visitors[at:at + step, None] ^ homes[None, :]) <= distance
        r, c = np.nonzero(near)
        a, b = v[at + r], h[c]
        a, b = a[a != b], b[a != b]
        ea.append(a)
        eb.append(b)
        held += len(a)
        if held > 1 << 20:
            label = least_labels(len(nodes), np.concatenate(ea), np.concatenate(eb))
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            ea, eb, held = [moved], [label[moved]], 0
    label = least_labels(len(nodes), np.concatenate(ea or [np.zeros(0, int)]), np.concatenate(eb or [np.zeros(0, int)]))
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(fps: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (column fp, all
    different) that chains of steps of at most ``distance`` bits connect."""
    spark = fps.sparkSession
    n = fps.count()
    leaves = -(-n // HOMES)
    size = min(max(LEAST_SAMPLE, 2 * LEAF_SAMPLE * leaves), TREE_SAMPLE)
    # A random share by hash (somewhat too large, then cut to size): no sort of all.
    share = F.lit(min(1.0, 1.2 * size / max(n, 1)) * 2.0**62)
    part = fps.where(F.shiftrightunsigned(F.xxhash64("fp"), 2) <= share)
    sample = [r.fp for r in part.orderBy(F.xxhash64("fp"), "fp").limit(size).collect()]
    tree = VantageTree(np.array(sample, np.int64).view(np.uint64), leaves, distance)
    shared = spark.sparkContext.broadcast(tree)

    def batch_fps(batch):
        fp = np.asarray(batch.column("fp").to_numpy()).astype(np.int64).view(np.uint64)
        return fp, shared.value.homes(fp)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, visit = np.zeros(shared.value.leaves, np.int64), np.zeros(shared.value.leaves, np.int64)
        for batch in batches:
            fp, homes = batch_fps(batch)
            home += np.bincount(homes, minlength=len(home))
            for leaf, idx in shared.value.visits(fp, homes):
                visit[leaf] += len(idx)
        used = np.flatnonzero(home + visit)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(home[used]), pa.array(visit[used])],
                                         names=["leaf", "homes", "visits"])

    # One row a leaf: at most TREE_SAMPLE / LEAF_SAMPLE.
    sizes = fps.mapInArrow(count, "leaf int, homes long, visits long").groupBy("leaf").agg(F.sum("homes").alias("h"), F.sum("visits").alias("v"))
    chunks, blocks = {}, {}
    for r in sizes.collect():
        chunks[r.leaf], blocks[r.leaf] = -(-r.h // HOMES) or 1, -(-(r.h + r.v) // VISITORS) or 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, homes = batch_fps(batch)
            if not len(fp):
                continue
            chunk_hash, block_hash = mix(fp) >> np.uint64(1), mix(fp ^ np.uint64(SEED)) >> np.uint64(1)
            order = np.argsort(homes, kind="stable")
            found, at = np.unique(homes[order], return_index=True)
            parts = [*zip(found.tolist(), np.split(order, at[1:]), strict=True)]
            cells: dict = defaultdict(lambda: ([], []))
            for leaf, idx in parts:
                for c in range(chunks[leaf]):
                    mine = fp[idx[chunk_hash[idx] % np.uint64(chunks[leaf]) == c]]
                    for j in range(blocks[leaf]) if len(mine) else ():
                        cells[leaf, c, j][0].append(mine)
            for leaf, idx in [*parts, *shared.value.visits(fp, homes)]:
                for j in range(blocks[leaf]):
                    some = fp[idx[block_hash[idx] % np.uint64(blocks[leaf]) == j]]
                    for c in range(chunks[leaf]) if len(some) else ():
                        cells[leaf, c, j][1].append(some)
            keys = list(cells)
            pack = lambda k, i: b"".join(x.tobytes() for x in cells[k][i])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k in keys], pa.int32()) for i in range(3)), pa.array([pack(k, 0) for k in keys], pa.binary()),
                 pa.array([pack(k, 1) for k in keys], pa.binary())], names=["leaf", "chunk", "block", "homes", "visitors"])

    def compare(cell: pa.Table) -> pa.Table:
        read = lambda name: np.frombuffer(b"".join(cell.column(name).to_pylist()), "<u8")
        a, b = cell_links(read("homes"), read("visitors"), distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (fps.mapInArrow(deal, "leaf int, chunk int, block int, homes binary, visitors binary")
            .groupBy("leaf", "chunk", "block").applyInArrow(compare, "a long, b long"))


def groups(docs: DataFrame, shingle: int = 4, distance: int = 4) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints (doc_id, text_key, fp), and of each different
    fingerprint (fp, label, component_id): its component and the component's
    smallest doc_id."""
    rows = stage(fingerprints(docs, shingle))
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = connected_components(stage(links(nodes.select("fp"), distance)))
    named = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("component", "fp").alias("label"))
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return rows, stage(named.join(ids, "label").select("fp", "label", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    rows, named = groups(docs, shingle, distance)
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all
    its columns; of repeated rows with this id and text, one."""
    rows, named = groups(docs.select("doc_id", "text"), shingle, distance)
    order = Window.partitionBy("label").orderBy(F.col("doc_id").asc_nulls_last(), "text_key")
    keyed = rows.groupBy("doc_id", "text_key", "fp").agg(F.count("*").alias("copies")).join(named, "fp")
    kept = stage(keyed.withColumn("place", F.row_number().over(order)).where("place = 1")
                 .select(F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key"), "copies"))
    is_kept = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & (text_key() == F.col("_kept_key"))
    whole = with_row(docs)
    once = whole.join(kept.where("copies = 1"), is_kept, "left_semi")
    many = whole.join(kept.where("copies > 1"), is_kept).dropDuplicates(["_kept_id", "_kept_key"])
    return row_again(once.select("row").unionAll(many.select("row")), docs.columns)
