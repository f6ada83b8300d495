"""Approximate nearest neighbours by cosine with robust-pruned directed graphs.

Vectors are dealt to shards of about ``shard`` different vectors by a hash.
Each shard's graph is built in one task: greedy beam searches from the medoid
propose neighbours for a block of nodes, relaxed distance pruning keeps a
candidate unless a kept neighbour is ``alpha`` times closer to it, and reverse
edges are added under the same pruning.  The index is a table with one row a
shard (vectors, ids and graph as binary columns) in the shared folder.  Queries
go in blocks of bounded size to every shard, where one vectorised beam search
serves the whole block; the found vectors' cosines are then computed in double
precision from the original components, and each query keeps its best.  A task
reads a part of the shards and a part of the query blocks, pairs them, and
returns the best of its shards for each query.

Equal vectors are one node that lists its ``k + 1`` smallest ids (more can't be
among the k nearest of a query), so a vector that very many rows share neither
breaks the graph nor fills a shard.

Cases: vectors that are null, zero, empty, or hold null or non-finite
components take no part, as queries or candidates; vectors of another length
than a query's are no candidates of it; a repeated (vec_id, vector) row counts
once; ties go to the smaller vec_id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import PAIR_BYTES, paired, release, rows_of, stage

SHARD, QUERY_BLOCK = 4096, 2048
DEGREE, BUILD_BEAM, ALPHA = 32, 64, 1.2
SEARCH_BEAM = 96
# Stands for no id; sorts after every id.
ABSENT = np.iinfo(np.int64).max


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the last axes in double precision; the same pair of vectors
    gives the same bits wherever it stands."""
    return (a * b).sum(-1) / (np.sqrt((a * a).sum(-1)) * np.sqrt((b * b).sum(-1)))


def beam_search(unit: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes found for each query (node, similarity), best
    first; -1 where fewer were found.  Each step expands the best node that
    isn't expanded yet, of all queries at once."""
    n, q = len(unit), len(queries)
    rows = np.arange(q)
    node = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), -np.inf, np.float32)
    done = np.ones((q, beam), bool)
    node[:, 0], near[:, 0], done[:, 0] = entry, queries @ unit[entry], False
    seen = np.zeros((q, n + 1), bool)  # the last column takes the absent neighbours
    seen[:, entry] = seen[:, n] = True
    while True:
        open_near = np.where(done, -np.inf, near)
        best = open_near.argmax(1)
        live = np.flatnonzero(open_near[rows, best] > -np.inf)
        if not len(live):
            return node, near
        at = best[live]
        done[live, at] = True
        to = graph[node[live, at]]
        to = np.where(to < 0, n, to)
        cell = to + (live * (n + 1))[:, None]
        new = ~seen.take(cell)
        seen.put(cell, True)
        # Only what wasn't seen before is compared.
        sims = np.full(to.size, -np.inf, np.float32)
        here = np.flatnonzero(new)
        sims[here] = np.einsum("md,md->m", queries.take(live.take(here // to.shape[1]), 0), unit.take(to.take(here), 0))
        sims = sims.reshape(to.shape)
        all_near = np.concatenate([near[live], sims], axis=1)
        top = np.argsort(-all_near, axis=1, kind="stable")[:, :beam] + (np.arange(len(live)) * all_near.shape[1])[:, None]
        near[live] = all_near.take(top)
        node[live] = np.concatenate([node[live], to], axis=1).take(top)
        done[live] = np.concatenate([done[live], ~new], axis=1).take(top)
        node[near == -np.inf] = -1


def robust_prune(unit: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of the nodes ``own`` out of their ``candidates`` (-1: none):
    nearest first, dropping each that a kept one is ``alpha`` times closer to."""
    vec = unit[np.maximum(candidates, 0)]
    d = 2 - 2 * np.einsum("bd,bcd->bc", unit[own], vec)
    d[(candidates < 0) | (candidates == own[:, None])] = np.inf
    out = np.full((len(own), degree), -1, np.int64)
    rows = np.arange(len(own))
    for k in range(degree):
        best = d.argmin(1)
        ok = np.isfinite(d[rows, best])
        if not ok.any():
            break
        out[ok, k] = candidates[rows, best][ok]
        # Squared distances: alpha counts squared.  The kept one is at distance 0 of itself.
        far = alpha * alpha * (2 - 2 * np.einsum("bd,bcd->bc", vec[rows, best], vec)) <= d
        far[rows, best] = True
        d[far & ok[:, None]] = np.inf
    return out


def build_graph(unit: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(neighbours by node, -1 where fewer, entry node) of unit vectors."""
    n = len(unit)
    entry = int((unit @ unit.mean(0)).argmax())
    rng = np.random.default_rng(n)
    graph = np.full((n, degree), -1, np.int64)
    if n > 1:
        links = rng.integers(0, n - 1, (n, min(degree, n - 1)))
        graph[:, :links.shape[1]] = links + (links >= np.arange(n)[:, None])
    for relaxed in (1.0, alpha):
        for block in np.array_split(rng.permutation(n), -(-n // 256)):
            found, _ = beam_search(unit, graph, entry, unit[block], min(beam, n))
            graph[block] = robust_prune(unit, block, np.concatenate([found, graph[block]], axis=1), degree, relaxed)
            # Reverse edges, pruned where a node has too many.
            a, b = np.repeat(block, degree), graph[block].ravel()
            a, b = a[b >= 0], b[b >= 0]
            order = np.argsort(b, kind="stable")
            a, b = a[order], b[order]
            targets, start, count = np.unique(b, return_index=True, return_counts=True)
            width = int(min(count.max(), 2 * degree)) if len(count) else 0
            for lo in range(0, int(count.max()) if len(count) else 0, max(1, width)):
                part = count > lo
                place = start[part, None] + lo + np.arange(width)
                extra = np.where(np.arange(width) + lo < count[part, None], a[np.minimum(place, len(a) - 1)], -1)
                own = targets[part]
                extra = np.where((extra[:, :, None] == graph[own][:, None, :]).any(2), -1, extra)
                full = np.concatenate([graph[own], extra], axis=1)
                over = (full >= 0).sum(1) > degree
                packed = np.take_along_axis(full, np.argsort(full < 0, axis=1, kind="stable"), 1)[:, :degree]
                graph[own[~over]] = packed[~over]
                if over.any():
                    graph[own[over]] = robust_prune(unit, own[over], full[over], degree, relaxed)
    return graph, entry


def first_of(ids: np.ndarray, scores: np.ndarray, more_ids: np.ndarray, more_scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best of both sets of each query, as many as the first set has places;
    an id with the same score counts once."""
    all_ids, all_scores = np.concatenate([ids, more_ids], axis=1), np.concatenate([scores, more_scores], axis=1)
    all_scores[~(all_scores > -np.inf)] = -np.inf
    order = np.lexsort((all_ids, -all_scores))
    all_ids, all_scores = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_scores, order, 1)
    again = (all_ids[:, 1:] == all_ids[:, :-1]) & (all_scores[:, 1:] == all_scores[:, :-1])
    all_scores[:, 1:][again] = -np.inf
    order = np.argsort(-all_scores, axis=1, kind="stable")[:, :ids.shape[1]]
    return np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_scores, order, 1)


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and vector (array of doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


INDEX = "shard int, dim int, n int, entry int, vectors binary, graph binary, ids binary, per int"


def build_index(rows: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """The index over all usable rows, a row for each shard and vector length."""
    w = Window.partitionBy("vector").orderBy("vec_id")
    each = usable(rows).distinct().withColumn("place", F.row_number().over(w)).where(F.col("place") <= k + 1)
    nodes = stage(each.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    n_shards = max(1, -(-nodes.count() // shard))
    dealt = nodes.select(F.pmod(F.xxhash64("vector"), F.lit(n_shards)).cast("int").alias("shard"), F.size("vector").alias("dim"), "vector", "ids")

    def build(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        dim, n = key[1].as_py(), group.num_rows
        vectors = np.concatenate([c.flatten().to_numpy() for c in group.column("vector").chunks]).reshape(n, dim)
        order = np.lexsort(vectors.T)  # the same graph whatever order the rows come in
        vectors = vectors[order]
        ids = np.full((n, k + 1), -1, np.int64)
        lists = group.column("ids").to_pylist()
        for i, o in enumerate(order):
            ids[i, :len(lists[o])] = lists[o]
        unit = (vectors / np.sqrt((vectors * vectors).sum(1))[:, None]).astype(np.float32)
        graph, entry = build_graph(unit)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([dim], pa.int32()), "n": pa.array([n], pa.int32()),
                         "entry": pa.array([entry], pa.int32()), "vectors": [vectors.tobytes()], "graph": [graph.astype("<i4").tobytes()],
                         "ids": [ids.tobytes()], "per": pa.array([k + 1], pa.int32())})

    return stage(dealt.groupBy("shard", "dim").applyInArrow(build, INDEX))


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each query
    (columns vec_id, embedding); a row with the query's own id is not one."""
    asked = usable(queries).distinct().withColumn("dim", F.size("vector"))
    n_blocks = max(1, -(-asked.count() // block))

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        vectors = np.concatenate([c.flatten().to_numpy() for c in group.column("vector").chunks])
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([key[1].as_py()], pa.int32()),
                         "query_ids": [group.column("vec_id").to_numpy().astype("<i8").tobytes()], "queries": [vectors.astype("<f8").tobytes()]})

    blocks = stage(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_blocks)).cast("int"))
                   .groupBy("block", "dim").applyInArrow(pack, "block int, dim int, query_ids binary, queries binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in rows_of(batch):
                dim, n = row["dim"], row["n"]
                vectors = np.frombuffer(row["vectors"], "<f8").reshape(n, dim)
                graph = np.frombuffer(row["graph"], "<i4").reshape(n, -1)
                ids = np.frombuffer(row["ids"], "<i8").reshape(n, row["per"])
                query_ids = np.frombuffer(row["query_ids"], "<i8")
                queries = np.frombuffer(row["queries"], "<f8").reshape(len(query_ids), dim)
                unit = (vectors / np.sqrt((vectors * vectors).sum(1))[:, None]).astype(np.float32)
                asked_unit = (queries / np.sqrt((queries * queries).sum(1))[:, None]).astype(np.float32)
                if (row["block"], dim) not in best:
                    best[row["block"], dim] = query_ids.copy(), np.full((len(queries), k), ABSENT), np.full((len(queries), k), -np.inf)
                _, best_id, best_score = best[row["block"], dim]
                for at in range(0, len(queries), 256):
                    part = slice(at, at + 256)
                    node, _ = beam_search(unit, graph, row["entry"], asked_unit[part], min(beam, n))
                    score = np.where(node >= 0, cosines(queries[part, None, :], vectors[np.maximum(node, 0)]), -np.inf)
                    own, cand = query_ids[part, None, None], np.where((node >= 0)[:, :, None], ids[np.maximum(node, 0)], -1)
                    flat = np.where((cand < 0) | (cand == own), ABSENT, cand).reshape(len(node), -1)
                    rank_by = np.where(flat == ABSENT, -np.inf, np.repeat(score, ids.shape[1], axis=1))
                    top = np.lexsort((flat, -rank_by))[:, :k]
                    best_id[part], best_score[part] = first_of(best_id[part], best_score[part], np.take_along_axis(flat, top, 1), np.take_along_axis(rank_by, top, 1))
        for query_ids, best_id, best_score in best.values():
            found = best_score > -np.inf
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, found.sum(1))), pa.array(best_id[found]), pa.array(best_score[found])],
                                             names=["query_id", "vec_id", "score"])
        release()

    # A stated set of queries against all rows, a pair of blocks at a time.
    found = stage(paired(index, blocks, "dim").mapInArrow(run, "query_id long, vec_id long, score double").distinct(), PAIR_BYTES)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k nearest rows found of each row whose vec_id is divisible by ``every``."""
    return search(build_index(rows, k), rows.where(F.col("vec_id") % every == 0), k)
