"""Hard negatives by exact integer inner products, scored with subset-sum tables
(the Method of Four Russians).

A component x counts as the integer floor(256 x).  Candidate rows are packed
in blocks: each bit plane of eight neighbouring dimensions is one byte.  For a
block of anchors and each group of eight dimensions a table holds the sums of
all 256 subsets of the anchors' components, so that a candidate's byte looks up
the group's share of one plane for all anchors at once; planes are added from
the highest down with a shift between them, the sign plane is subtracted.  The
sums are exact: 32 or 64 bits where a bound on the block's components shows
that they suffice, Python integers else.

Anchors are a stated part of the rows (vec_id divisible by ``every``) and meet
every block of rows, a block of anchors at a time:

1. each pair of blocks gives each anchor's best rows of its own label; the
   best of all blocks are its positives;
2. each pair of blocks scores the rows of other labels, sorts them once per
   anchor, and cuts a run of them for each positive out of the score range that
   the positive allows; the first of all blocks are its negatives.

A task reads a part of the blocks of rows and a part of the blocks of anchors,
pairs them, and returns the first of its rows for each anchor (or positive): what
it holds and returns is bounded by the anchors, not by the rows.

Cases: rows whose vec_id, label or vector is null, or whose vector is empty or
holds a null or non-finite component take no part; a row repeated in vec_id,
label and vector counts once; rows that share a vec_id only are rows of their
own; vectors of another length than an anchor's are no candidates of it; an
anchor without a row of its label, or a positive without a row in its range,
gives no rows; a negative positive score allows none; scores beyond 64 bits
are an error; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import PAIR_BYTES, paired, release, rows_of, stage

SCALE = 256
BLOCK, ANCHOR_BLOCK = 8192, 512
# Candidates scored at a time: one lookup's rows stay in the processor's cache.
CHUNK = 512


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each component, as 64-bit integers if all fit."""
    scaled = np.floor(vectors * float(scale))
    if scaled.size and np.abs(scaled).max() >= 2.0 ** 62:
        return np.array([[int(x) for x in row] for row in scaled], object).reshape(scaled.shape)
    return scaled.astype(np.int64)


def grouped(values: np.ndarray) -> np.ndarray:
    """(rows, groups, 8): components in groups of eight, the last padded with 0."""
    n, dim = values.shape
    groups = -(-dim // 8)
    out = np.zeros((n, groups * 8), values.dtype)
    out[:, :dim] = values
    return out.reshape(n, groups, 8)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes: bit j of a byte is the plane's bit of the
    group's component j, in two's complement; the last plane is the sign."""
    parts = grouped(values)
    top = max((int(x) if x >= 0 else ~int(x) for x in (values.max(), values.min())), default=0) if values.size else 0
    planes = [np.packbits(((parts >> b) & 1).astype(np.uint8), axis=2, bitorder="little")[:, :, 0].T for b in range(top.bit_length() + 1)]
    return np.ascontiguousarray(np.stack(planes))


def sum_type(anchors: np.ndarray, planes: int):
    """The narrowest type that holds every partial sum."""
    bound = anchors.shape[1] * int(np.abs(anchors).max()) * 2 ** (planes + 1) if anchors.size else 0
    return np.int32 if bound < 2 ** 31 else np.int64 if bound < 2 ** 63 else object


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): entry s of a group is the sum of the anchor's
    components whose bits are set in s."""
    parts = np.moveaxis(grouped(anchors), 0, 2).astype(dtype)
    tables = np.zeros((parts.shape[0], 256, parts.shape[2]), dtype)
    for j in range(8):
        tables[:, 1 << j:2 << j] = tables[:, :1 << j] + parts[:, j:j + 1]
    return tables


def scores(planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products."""
    tables = subset_sums(anchors, sum_type(anchors, len(planes)))
    n = planes.shape[2]
    out = np.zeros((n, tables.shape[2]), tables.dtype)
    for at in range(0, n, CHUNK):
        acc = out[at:at + CHUNK]
        for b in range(len(planes) - 1, -1, -1):
            acc += acc
            for table, byte in zip(tables, planes[b, :, at:at + CHUNK], strict=True):
                if b == len(planes) - 1:
                    acc -= table[byte]
                else:
                    acc += table[byte]
    return out


def usable(rows: DataFrame) -> DataFrame:
    """uid, vec_id, label and vector of the rows that take part, each once.
    ``uid`` tells rows of one vec_id apart."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    each = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("vector")) \
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite & (F.size("vector") > 0)).distinct()
    return each.select(F.xxhash64("vec_id", "label", "vector").alias("uid"), "*", F.size("vector").alias("dim"))


def _matrix(group: pa.Table, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in group.column("vector").chunks]).reshape(-1, dim)


def _longs(group: pa.Table, name: str) -> np.ndarray:
    return group.column(name).to_numpy().astype("<i8")


CANDIDATES = "block int, dim int, n int, uids binary, ids binary, labels binary, planes binary"


def candidate_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows in packed blocks, ordered by vec_id inside each."""
    count = max(1, -(-rows.count() // block))

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        dim, uids, ids = key[1].as_py(), _longs(group, "uid"), _longs(group, "vec_id")
        order = np.lexsort((uids, ids))
        planes = bit_planes(integers(_matrix(group, dim)[order]))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
                         "uids": [uids[order].tobytes()], "ids": [ids[order].tobytes()], "labels": [_longs(group, "label")[order].tobytes()],
                         "planes": [planes.tobytes()]})

    return stage(rows.withColumn("block", F.pmod(F.col("uid"), F.lit(count)).cast("int")).groupBy("block", "dim").applyInArrow(pack, CANDIDATES))


def _meet(candidates: DataFrame, anchors: DataFrame, block: int) -> DataFrame:
    """Each block of anchors (columns uid, vec_id, label, vector, dim and
    ``given``, an array of structs uid, vec_id, score) with each block of candidates."""
    count = max(1, -(-anchors.count() // block))

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        given = group.column("given").combine_chunks()
        counts = np.diff(given.offsets.to_numpy()).astype("<i8") if len(given) else np.zeros(0, "<i8")
        pairs = given.flatten()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([key[1].as_py()], pa.int32()),
                         "a_uids": [_longs(group, "uid").tobytes()],
                         "a_ids": [_longs(group, "vec_id").tobytes()], "a_labels": [_longs(group, "label").tobytes()],
                         "vectors": [_matrix(group, key[1].as_py()).astype("<f8").tobytes()], "counts": [counts.tobytes()],
                         "p_uids": [pairs.field("uid").to_numpy(zero_copy_only=False).astype("<i8").tobytes()],
                         "p_ids": [pairs.field("vec_id").to_numpy(zero_copy_only=False).astype("<i8").tobytes()],
                         "p_scores": [pairs.field("score").to_numpy(zero_copy_only=False).astype("<i8").tobytes()]})

    packed = anchors.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(count)).cast("int")).groupBy("part", "dim").applyInArrow(
        pack, "part int, dim int, a_uids binary, a_ids binary, a_labels binary, vectors binary, counts binary, p_uids binary, p_ids binary, p_scores binary")
    # A stated set of anchors against all rows, a pair of blocks at a time.
    return paired(candidates, stage(packed), "dim")


OWN = ("a_uids", "a_ids", "a_labels", "counts", "p_uids", "p_ids", "p_scores")


def _unpack(row: dict) -> tuple[dict, dict, np.ndarray]:
    """(candidate columns, anchor columns, anchors' integers) of a pair of blocks."""
    dim, n = row["dim"], row["n"]
    own = {k: np.frombuffer(row[k], "<i8") for k in OWN}
    other = {k: np.frombuffer(row[k], "<i8") for k in ("uids", "ids", "labels")}
    other["planes"] = np.frombuffer(row["planes"], np.uint8).reshape(-1, -(-dim // 8), n)
    return other, own, integers(np.frombuffer(row["vectors"], "<f8").reshape(-1, dim))


class Best:
    """The first ``k`` rows of each group by falling score, then vec_id and uid."""

    def __init__(self, k: int):
        self.k, self.parts, self.n, self.kept = k, [], 0, 0

    def add(self, *columns: np.ndarray) -> None:
        """Group, score, vec_id and uid of more rows."""
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n > 4 * self.kept + 10_000:
            self.first()

    def first(self) -> list[np.ndarray]:
        """Group, score, vec_id and uid of the rows that stay."""
        if len(self.parts) > 1 or self.n > self.kept:
            group, score, vec_id, uid = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            order = np.lexsort((uid, vec_id, ~score, group))  # ~: falls as the score rises, without overflow
            starts = np.searchsorted(group[order], group[order], side="left")
            order = order[np.arange(len(order)) - starts < self.k]
            self.parts = [(group[order], score[order], vec_id[order], uid[order])]
            self.n = self.kept = len(order)
        return list(self.parts[0]) if self.parts else [np.zeros(0, np.int64)] * 4


def _first_of_pairs(batches: Iterator[pa.RecordBatch], k: int, found) -> Iterator[tuple[dict, list[np.ndarray]]]:
    """For each block of anchors its columns and the first ``k`` rows of each
    group; ``found`` yields a pair's rows as (group, scores, places in the block)."""
    best: dict[tuple[int, int], tuple[dict, Best]] = {}
    for batch in batches:
        for row in rows_of(batch):
            other, own, values = _unpack(row)
            key = row["part"], row["dim"]
            if key not in best:
                best[key] = {name: v.copy() for name, v in own.items()}, Best(k)
            more = [(np.full(len(at), group), score.astype(np.int64), at) for group, score, at in found(other, own, values)]
            if more:
                group, score, at = (np.concatenate(c) for c in zip(*more, strict=True))
                best[key][1].add(group, score, other["ids"][at], other["uids"][at])
    for own, b in best.values():
        yield own, b.first()
    release()


FOUND = "anchor_uid long, anchor_id long, uid long, vec_id long, score long"


def positives(candidates: DataFrame, anchors: DataFrame, k: int, block: int = ANCHOR_BLOCK) -> DataFrame:
    """The first ``k`` other rows of each anchor's label."""
    def of_label(other: dict, own: dict, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for label in np.intersect1d(other["labels"], own["a_labels"]):
            rows, mine = np.flatnonzero(other["labels"] == label), np.flatnonzero(own["a_labels"] == label)
            got = np.ascontiguousarray(scores(other["planes"][:, :, rows], values[mine]).T)
            for column, a in zip(got, mine, strict=True):
                there = other["uids"][rows] != own["a_uids"][a]
                column, left = column[there], rows[there]
                top = np.argsort(-column, kind="stable")[:k]
                yield a, column[top], left[top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, (a, score, vec_id, uid) in _first_of_pairs(batches, k, of_label):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (own["a_uids"][a], own["a_ids"][a], uid, vec_id, score)],
                                             names=["anchor_uid", "anchor_id", "uid", "vec_id", "score"])

    nothing = F.array().cast("array<struct<uid:bigint,vec_id:bigint,score:bigint>>")
    found = stage(_meet(candidates, anchors.withColumn("given", nothing), block).mapInArrow(run, FOUND), PAIR_BYTES)
    w = Window.partitionBy("anchor_uid", "anchor_id").orderBy(F.col("score").desc(), "vec_id", "uid")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def negatives(candidates: DataFrame, anchors: DataFrame, chosen: DataFrame, k: int, low: int, high: int, block: int = ANCHOR_BLOCK) -> DataFrame:
    """The first ``k`` rows of other labels for each anchor and positive whose
    score is at least ``low`` and at most ``high`` percent of the positive's."""
    # At most as many positives as asked for: a bounded list of each anchor.
    lists = chosen.groupBy(F.col("anchor_uid").alias("uid"), F.col("anchor_id").alias("vec_id")) \
        .agg(F.collect_list(F.struct("uid", "vec_id", "score")).alias("given"))
    names = ["anchor_uid", "anchor_id", "positive_uid", "positive_id", "uid", "vec_id", "positive_score", "score"]

    def in_range(other: dict, own: dict, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        first = np.concatenate([[0], np.cumsum(own["counts"])])
        got = np.ascontiguousarray(scores(other["planes"], values).T)
        for a, column in enumerate(got):
            ranges = [(p, -(-int(own["p_scores"][p]) * low // 100), int(own["p_scores"][p]) * high // 100) for p in range(first[a], first[a + 1])]
            ranges = [x for x in ranges if x[1] <= x[2]]
            if not ranges:
                continue
            # Only rows that some positive allows are sorted.
            rows = np.flatnonzero((column >= min(x[1] for x in ranges)) & (column <= max(x[2] for x in ranges)) & (other["labels"] != own["a_labels"][a]))
            rows = rows[np.argsort(-column[rows], kind="stable")]
            falling = -column[rows]
            for p, least, most in ranges:
                lo = int(np.searchsorted(falling, -most, side="left"))
                hi = min(lo + k, int(np.searchsorted(falling, -least, side="right")))
                if hi > lo:
                    yield p, -falling[lo:hi], rows[lo:hi]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, (p, score, vec_id, uid) in _first_of_pairs(batches, k, in_range):
            a = np.repeat(np.arange(len(own["counts"])), own["counts"])[p]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (own["a_uids"][a], own["a_ids"][a], own["p_uids"][p], own["p_ids"][p], uid, vec_id,
                                                                                  own["p_scores"][p], score)], names=names)

    found = stage(_meet(candidates, anchors.join(lists, ["uid", "vec_id"]), block).mapInArrow(run, ", ".join(f"{n} long" for n in names)), PAIR_BYTES)
    w = Window.partitionBy("anchor_uid", "anchor_id", "positive_uid", "positive_id").orderBy(F.col("score").desc(), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(rows: DataFrame, label: Column, every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
         block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score of the rows (columns vec_id, embedding); ``label`` gives a
    row's label."""
    each = stage(usable(rows.withColumn("label", label)))
    anchors = each.where(F.col("vec_id") % every == 0)
    candidates = candidate_blocks(each, block)
    chosen = stage(positives(candidates, anchors, n_positives, anchor_block))
    found = negatives(candidates, anchors, chosen, n_negatives, low, high, anchor_block)
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
