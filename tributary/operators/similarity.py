"""Top-k cosine similarity per row.

Exact form.  Cosines come from blocks of about ``block_size`` vectors: a group of
``applyInPandas`` is a pair of blocks, one matrix product scores it in query
chunks, and only the best ``k`` of each query row leave the task.  Pairs are never
rows, and a group's size is fixed whatever the data or its skew.

Blocks are not compared blindly.  A bounded sample gives pivots (spherical
k-means); a vector belongs to the cell of its nearest pivot, and a cell of many
vectors is cut into blocks.  Of every cell the least and largest angle to each
pivot are known, so that the triangle inequality bounds a query's best cosine
there.  A query first meets its own block; its k-th score there, or ``min_score``,
then rules out all cells whose bound is lower.  ``related_pairs`` reports how
many pairs are left.  Vectors that form groups leave few; for vectors without
any structure angles concentrate, no bound excludes anything, and the work stays
quadratic (as in the reference).

What a task holds does not grow with the table: of a chunk of scores only those
that reach the query's threshold are sorted, and visits are made in slices.

``append_related`` keeps a table of results and adds those of new ids only.
``approx_related`` has random-projection LSH candidates, scored exactly in the same
blocks (a pair that shares no bucket is passed over there); it may miss pairs and
is therefore not the default.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.keyed_table import KeyedTable
from tributary.session import cut_lineage

__all__ = ["related_top_k", "related_pairs", "append_related", "approx_related"]

OUT_SCHEMA = "news_id long, related_news_id long, score double"
# Sampled vectors that pivots are chosen from, and pivots, at most.
PIVOT_SAMPLE, PIVOTS = 4096, 64
# Angles are compared with this slack (arccos loses digits near 1), thresholds of scores
# with this one (a product's last bits depend on the block's shape).
SLACK, SCORE_SLACK = 1e-6, 1e-9
# Scores, or visits, that a task holds at once.
CELLS = 1 << 21


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack(vectors.to_numpy()).astype(np.float64)


def _best_of(q: pd.DataFrame, c: pd.DataFrame, k: int, min_score: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, row of ``c``, score) of each query's best ``k``: score descending, candidate
    id ascending.  Scores come in chunks of about CELLS; those under the query's threshold
    (its ``__least``, or ``min_score``) go before anything is sorted.  Where rows have
    buckets (``__hash``), a candidate shares one at least."""
    cv, cid = _matrix(c["__vec"]), c["__id"].to_numpy()
    cn = np.linalg.norm(cv, axis=1)
    hashes = _matrix(c["__hash"]) if "__hash" in c else None
    need = k + int(np.unique(cid, return_counts=True)[1].max())  # the best k, and the row's own copies
    need *= 1 if hashes is None else 4
    rows, cols, scores = [], [], []
    chunk = max(1, CELLS // len(c))
    for lo in range(0, len(q), chunk):
        qq = q.iloc[lo:lo + chunk]
        qv = _matrix(qq["__vec"])
        least = np.maximum(min_score, qq["__least"].to_numpy() - SCORE_SLACK) if "__least" in qq else np.full(len(qq), min_score)
        with np.errstate(invalid="ignore", divide="ignore"):
            s = qv @ cv.T
            s /= np.outer(np.linalg.norm(qv, axis=1), cn)
        known = np.isfinite(s)

        def reach(at, bar):  # (row, candidate) of the rows ``at`` that reach their bar, and share a bucket
            r, j = np.nonzero((s[at] >= bar[:, None]) & known[at])
            r = at[r]
            ok = qid[r] != cid[j]  # drop self by id
            if hashes is not None:
                for lo_pair in range(0, len(r), CELLS // hashes.shape[1]):
                    part = slice(lo_pair, lo_pair + CELLS // hashes.shape[1])
                    ok[part] &= (own[r[part]] == hashes[j[part]]).any(axis=1)
            return r[ok], j[ok]

        qid, own = qq["__id"].to_numpy(), None if hashes is None else _matrix(qq["__hash"])
        every = np.arange(len(qq))
        if "__least" not in qq and len(c) > 4 * need:  # first those over the best ``need``; rows with too few of them again
            bar = least.copy()
            for at in range(0, len(qq), 64):
                part = np.partition(np.where(known[at:at + 64], s[at:at + 64], -np.inf), len(c) - need, axis=1)[:, len(c) - need]
                bar[at:at + 64] = np.maximum(bar[at:at + 64], part)
            r, j = reach(every, bar)
            few = np.flatnonzero((np.bincount(r, minlength=len(qq)) < k) & (bar > least))
            if len(few):
                kept = ~np.isin(r, few)
                more = reach(few, least[few])
                r, j = np.concatenate([r[kept], more[0]]), np.concatenate([j[kept], more[1]])
        else:
            r, j = reach(every, least)
        v = s[r, j]
        order = np.lexsort((cid[j], -v, r))
        r, j, v = r[order], j[order], v[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        best = place < k
        rows.append(r[best] + lo)
        cols.append(j[best])
        scores.append(v[best])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)


def _block_topk(k: int, min_score: float):
    """Per (query block, candidate block) group: each query's best ``k`` there."""
    empty = pd.DataFrame({"news_id": pd.Series([], dtype="int64"),
                          "related_news_id": pd.Series([], dtype="int64"),
                          "score": pd.Series([], dtype="float64")})

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        q = pdf[pdf["__role"] == 0]
        c = pdf[pdf["__role"] == 1]
        if q.empty or c.empty:
            return empty
        r, j, v = _best_of(q, c, k, min_score)
        return pd.DataFrame({"news_id": q["__id"].to_numpy()[r].astype("int64"),
                             "related_news_id": c["__id"].to_numpy()[j].astype("int64"), "score": v})
    return fn


def _unit(vectors: pd.Series) -> np.ndarray:
    v = np.vstack(vectors.to_numpy()).astype(np.float64)
    return v / np.linalg.norm(v, axis=1)[:, None]


def _angles(vectors: pd.Series, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(vectors) @ pivots.T, -1.0, 1.0))


def _choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` unit vectors at most: farthest-first points of the sample, then moved
    to the middles of their cells."""
    chosen = [0]
    near = sample @ sample[0]
    for _ in range(1, min(n, len(sample))):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, sample @ sample[chosen[-1]])
    pivots = sample[chosen]
    for _ in range(5):
        cell = np.argmax(sample @ pivots.T, axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, cell, sample)
        size = np.linalg.norm(sums, axis=1)
        pivots = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1.0)[:, None], pivots)
    return pivots


class _Layout:
    """Cells and blocks of a table of vectors (columns __id, __vec).  What the driver holds is
    bounded by PIVOT_SAMPLE vectors and PIVOTS squared angles."""

    def __init__(self, v: DataFrame, block_size: int):
        self.n = v.count()
        b = max(1, math.ceil(self.n / block_size))
        self.blocks = 1
        if b == 1:
            return
        rows = v.orderBy(F.xxhash64("__id"), "__id").select("__vec").limit(PIVOT_SAMPLE).collect()
        self.pivots = pivots = _choose_pivots(_unit(pd.Series([r[0] for r in rows])), min(PIVOTS, b))
        p = len(pivots)

        def ranges(batches):
            for pdf in batches:
                a = _angles(pdf["__vec"], pivots)
                cell = np.argmin(a, axis=1)
                for c in np.unique(cell):
                    mine = a[cell == c]
                    yield pd.DataFrame({"cell": int(c), "pivot": np.arange(p), "n": len(mine),
                                        "lo": mine.min(axis=0), "hi": mine.max(axis=0)})

        found = v.select("__vec").mapInPandas(ranges, "cell int, pivot int, n long, lo double, hi double") \
            .groupBy("cell", "pivot").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
        self.lo, self.hi, size = np.full((p, p), np.inf), np.full((p, p), -np.inf), np.zeros(p, np.int64)
        for r in found:
            self.lo[r.cell, r.pivot], self.hi[r.cell, r.pivot], size[r.cell] = r.lo, r.hi, r.n
        self.parts = -(-size // block_size)
        self.first = np.cumsum(self.parts) - self.parts
        self.blocks = int(self.parts.sum())

    def place(self, v: DataFrame) -> DataFrame:
        """__id, __vec (and __hash, where there) and the block of every vector."""
        if self.blocks == 1:
            return v.select(*v.columns, F.lit(0).alias("__block"))
        kept, types = v.columns, ", ".join(f"{n} {t}" for n, t in v.dtypes)
        pivots, parts, first = self.pivots, np.maximum(self.parts, 1), self.first

        def run(batches):
            for pdf in batches:
                cell = np.argmin(_angles(pdf["__vec"], pivots), axis=1)
                at = first[cell] + pdf["__h"].to_numpy() % parts[cell]
                yield pdf[kept].assign(__block=at.astype("int32"))

        return v.select(*kept, F.xxhash64("__id").alias("__h")).mapInPandas(run, f"{types}, __block int")

    def visits(self, own: DataFrame, k: int, min_score: float) -> DataFrame:
        """Of every query row the other blocks (__cb) that may hold a better one
        than its k-th so far."""
        pivots, lo, hi, parts, first = self.pivots, self.lo, self.hi, self.parts, self.first
        kept = [c for c in own.columns if c in ("__id", "__vec", "__hash")]
        step = max(1, CELLS // 8 // max(1, int(parts.sum()), len(pivots)))  # rows whose visits are held at once

        def slices(batches):
            for pdf in batches:
                for lo_row in range(0, len(pdf), step):
                    yield pdf.iloc[lo_row:lo_row + step]

        def run(batches):
            for pdf in slices(batches):
                a = _angles(pdf["__vec"], pivots)
                worst = np.array([max(min_score, min(s)) if len(s) >= k else min_score for s in pdf["scores"]])
                least = np.zeros((len(pdf), len(parts)))  # angle to a cell's nearest vector, at least
                for c in range(len(parts)):
                    least[:, c] = np.maximum(0.0, np.maximum(lo[c] - a, a - hi[c]).max(axis=1))
                reach = (least <= np.arccos(np.clip(worst, -1.0, 1.0))[:, None] + SLACK) & (parts > 0)
                rows, cells = np.nonzero(reach)
                times = parts[cells]
                rows = np.repeat(rows, times)
                block = np.repeat(first[cells], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                other = block != pdf["__block"].to_numpy()[rows]
                for at in range(0, len(rows), 8192):
                    r, to = rows[at:at + 8192], block[at:at + 8192]
                    r, to = r[other[at:at + 8192]], to[other[at:at + 8192]]
                    yield pd.DataFrame({**{c: pdf[c].to_numpy()[r] for c in kept}, "__least": worst[r],
                                        "__qb": pdf["__block"].to_numpy()[r], "__cb": to.astype("int32")})

        types = ", ".join(f"{n} {t}" for n, t in own.dtypes if n in kept)
        return own.select(*kept, "__block", "scores").mapInPandas(run, f"{types}, __least double, __qb int, __cb int")


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """__id and __vec of the rows that have a direction: no null or not finite
    component, not all zero."""
    vec = F.col(vec_col).cast("array<double>")
    square = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x)
    return df.select(F.col(id_col).cast("long").alias("__id"), vec.alias("__vec")) \
        .filter(F.col("__id").isNotNull() & (square > 0) & (square < F.lit(float("inf"))))


def _own_block(k: int, min_score: float, kept: list[str], by_row: bool):
    """Per block: every query row with its best ``k`` candidates there; rows of one
    id share theirs unless ``by_row``."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        q, c = pdf[pdf["__role"] == 0], pdf[pdf["__role"] == 1]
        found = {}
        name = np.arange(len(q)) if by_row else q["__id"].to_numpy()
        if len(q) and len(c):
            r, j, v = _best_of(q, c, k, min_score)
            tops = pd.DataFrame({"q": name[r], "id": c["__id"].to_numpy()[j], "score": v})
            found = {i: (g["id"].tolist(), g["score"].tolist()) for i, g in tops.groupby("q", sort=False)}
        tops = [found.get(i, ([], [])) for i in name]
        return q[kept].assign(ids=pd.Series([t[0] for t in tops], q.index, object),
                              scores=pd.Series([t[1] for t in tops], q.index, object))
    return fn


def _own(layout: _Layout, v: DataFrame, q: DataFrame, k: int, min_score: float, by_row: bool = False) -> DataFrame:
    both = layout.place(q).withColumn("__role", F.lit(0)).unionByName(layout.place(v).withColumn("__role", F.lit(1)))
    kept = [c for c in both.columns if c != "__role"]
    types = ", ".join(f"{n} {t}" for n, t in both.dtypes if n != "__role")
    return both.groupBy("__block").applyInPandas(_own_block(k, min_score, kept, by_row), f"{types}, ids array<long>, scores array<double>")


def _queries(v: DataFrame, queries: DataFrame | None, id_col: str) -> DataFrame:
    return v if queries is None else v.join(queries.select(F.col(id_col).cast("long").alias("__id")), "__id", "left_semi")


def related_top_k(vectors: DataFrame, id_col: str, vec_col: str, queries: DataFrame | None = None,
                  k: int = 5, min_score: float = 0.2, digits: int = 4, block_size: int = 8192) -> DataFrame:
    """For each query row (all rows by default, or the ids in ``queries``,
    e.g. the unprocessed ones from an anti join), the ``k`` most similar
    other rows with cosine >= ``min_score``; score rounded to ``digits``.
    Vectors that are null, zero or not finite have no score and no part."""
    v = _vectors(vectors, id_col, vec_col)
    return _top_k(v, _queries(v, queries, id_col), k, min_score, digits, block_size)


def _top_k(v: DataFrame, q: DataFrame, k: int, min_score: float, digits: int, block_size: int, by_row: bool = False) -> DataFrame:
    layout = _Layout(v, block_size)
    own = _own(layout, v, q, k, min_score, by_row)
    if layout.blocks > 1:
        own = cut_lineage(own)
    part = own.select(F.col("__id").alias("news_id"), F.inline(F.arrays_zip("ids", "scores"))) \
        .toDF("news_id", "related_news_id", "score")
    if layout.blocks > 1:
        visits = layout.visits(own, k, min_score)
        live = visits.select("__qb", "__cb").distinct()
        cs = layout.place(v).join(live, F.col("__block") == F.col("__cb")).drop("__block") \
            .withColumn("__least", F.lit(0.0)).withColumn("__role", F.lit(1))
        both = visits.withColumn("__role", F.lit(0)).unionByName(cs)
        part = part.unionByName(both.groupBy("__qb", "__cb").applyInPandas(_block_topk(k, min_score), OUT_SCHEMA))
    if layout.blocks > 1 or by_row:
        w = Window.partitionBy("news_id").orderBy(F.col("score").desc(), F.col("related_news_id"))
        part = part.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")
    return part.withColumn("score", F.bround("score", digits))


def related_pairs(vectors: DataFrame, id_col: str, vec_col: str, queries: DataFrame | None = None,
                  k: int = 5, min_score: float = 0.2, block_size: int = 8192) -> DataFrame:
    """One row: scored, the pairs (query, candidate) that ``related_top_k`` scores,
    and pairs, all there are."""
    v = _vectors(vectors, id_col, vec_col)
    q, layout = _queries(v, queries, id_col), _Layout(v, block_size)
    placed = layout.place(v)
    sizes = placed.groupBy("__block").agg(F.count(F.lit(1)).alias("n"))
    met = layout.place(q).select("__block")
    if layout.blocks > 1:
        own = cut_lineage(_own(layout, v, q, k, min_score))
        met = met.unionAll(layout.visits(own, k, min_score).select(F.col("__cb").alias("__block")))
    times = met.groupBy("__block").agg(F.count(F.lit(1)).alias("q"))
    scored = times.join(sizes, "__block").agg(F.coalesce(F.sum(F.col("q") * F.col("n")), F.lit(0)).alias("scored"))
    return scored.withColumn("pairs", F.lit(layout.n) * F.lit(q.count()))


def append_related(vectors: DataFrame, id_col: str, vec_col: str, path: str, k: int = 5, min_score: float = 0.2,
                   digits: int = 4, block_size: int = 8192) -> KeyedTable:
    """The related rows of the ids that the keyed table at ``path`` has none of
    yet, found among all vectors and added; rows of earlier ids stay as they are.
    An id without any related row is looked up again in the next run."""
    t = KeyedTable(vectors.sparkSession, path, ["news_id", "related_news_id"])
    new = vectors.select(id_col)
    if t.version():
        done = t.read().select(F.col("news_id").alias(id_col)).distinct()
        new = new.join(done, id_col, "left_anti")
    t.upsert(related_top_k(vectors, id_col, vec_col, new, k, min_score, digits, block_size), order=["score"])
    return t


def approx_related(vectors: DataFrame, id_col: str, vec_col: str, k: int = 5, min_score: float = 0.2,
                   digits: int = 4, bucket_length: float = 0.5, tables: int = 8, block_size: int = 8192) -> DataFrame:
    """Candidates from ``BucketedRandomProjectionLSH`` on unit vectors (Euclidean
    distance d maps to cosine 1 - d^2/2): rows that share a bucket of one of the
    ``tables`` at least, scored exactly; approximate recall.

    Buckets are not joined: of wide buckets a join makes nearly all pairs, several
    times, as rows.  Rows carry their buckets into the blocks of ``related_top_k``,
    where pairs are scored by matrix product and those without a common bucket fall out."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = _vectors(vectors, id_col, vec_col)
    norm = F.sqrt(F.aggregate("__vec", F.lit(0.0), lambda a, x: a + x * x))
    u = v.withColumn("features", array_to_vector(F.transform("__vec", lambda x: x / norm)))
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=7)
    if u.isEmpty():
        return v.sparkSession.createDataFrame([], OUT_SCHEMA)
    hashed = lsh.fit(u).transform(u).select("__id", "__vec", F.transform("hashes", lambda h: vector_to_array(h)[0]).alias("__hash"))
    hashed = hashed.dropDuplicates(["__id", "__vec"])
    return _top_k(hashed, hashed, k, min_score, digits, block_size, by_row=True)
