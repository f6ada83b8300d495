"""Top-k similarity and distributed ranks/quantiles against brute force."""

import numpy as np
import pandas as pd
import pytest

from tributary.operators.ranking import average_rank, exact_quantiles
from tributary.operators.similarity import related_top_k


def test_related_against_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 8)).astype("float32")
    v[5] = v[4]  # identical vectors: self must be the one dropped
    df = spark.createDataFrame([(i, v[i].tolist()) for i in range(60)], "id long, e array<float>")
    got = related_top_k(df, "id", "e", k=5, min_score=0.2, block_size=7).toPandas()
    vv = v.astype("float64")
    s = vv @ vv.T / np.outer(np.linalg.norm(vv, axis=1), np.linalg.norm(vv, axis=1))
    exp = []
    for i in range(60):
        c = sorted(((-s[i, j], j) for j in range(60) if j != i and s[i, j] >= 0.2))[:5]
        exp += [(i, j, round(-ns, 4)) for ns, j in c]
    assert sorted(map(tuple, got[["news_id", "related_news_id", "score"]].itertuples(index=False))) == \
        sorted((a, b, pytest.approx(c, abs=1e-4)) for a, b, c in exp)
    assert (4, 5) in {(a, b) for a, b, _ in exp}


def _brute(v, ids, k=5, least=0.2):
    u = v / np.linalg.norm(v, axis=1)[:, None]
    s = u @ u.T
    return sorted((i, j, round(-n, 4)) for i in ids for n, j in sorted((-s[i, j], j) for j in range(len(v)) if j != i and s[i, j] >= least)[:k])


def _grouped(n=600, groups=12, d=32):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(groups, d))
    v = (centres[rng.integers(0, groups, n)] + 0.15 * rng.normal(size=(n, d))).astype("float32")
    v[: n // 3] = v[0]  # a third of the rows equal
    return v


def test_related_by_bounds_is_exact_and_skips_pairs(spark):
    from tributary.operators.similarity import related_pairs
    v = _grouped()
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, e array<float>")
    got = sorted(map(tuple, related_top_k(df, "id", "e", block_size=40).collect()))
    exp = _brute(v.astype("float64"), range(len(v)))
    # equal vectors: scores differ in the last bits only, so which of them come is open
    assert [(a, round(s, 3)) for a, _, s in got] == [(a, pytest.approx(s, abs=1e-3)) for a, _, s in exp]
    u = v.astype("float64") / np.linalg.norm(v.astype("float64"), axis=1)[:, None]
    assert all(s == pytest.approx(u[a] @ u[b], abs=1e-4) and a != b for a, b, s in got)
    told = related_pairs(df, "id", "e", block_size=40).first()
    assert told.pairs == len(v) ** 2 and told.scored < told.pairs / 2


def test_related_without_direction_and_few_queries(spark):
    v = np.random.default_rng(2).normal(size=(50, 6)).astype("float32")
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(100, None), (101, [0.0] * 6), (102, [None, 1.0, 0.0, 0.0, 0.0, 0.0]), (103, [float("nan")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows + odd, "id long, e array<float>")
    q = spark.createDataFrame([(3,), (7,), (101,)], "id long")
    for size in (7, 8192):
        got = sorted(map(tuple, related_top_k(df, "id", "e", q, block_size=size).collect()))
        assert got == [(a, b, pytest.approx(c, abs=1e-4)) for a, b, c in _brute(v.astype("float64"), [3, 7])]
        assert related_top_k(df.limit(0), "id", "e", block_size=size).count() == 0


def test_related_rows_of_new_ids_only(spark):
    import uuid

    from tributary.operators.similarity import append_related
    from tributary.session import checkpoint_dir
    v = np.random.default_rng(4).normal(size=(40, 5)).astype("float32")
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, e array<float>")
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    append_related(df.where("id < 25"), "id", "e", path)
    t = append_related(df, "id", "e", path)
    vv = v.astype("float64")
    first, both = _brute(vv[:25], range(25)), _brute(vv, range(40))
    new = [r for r in both if r[0] not in {a for a, _, _ in first}]
    assert sorted(map(tuple, t.read().collect())) == [(a, b, pytest.approx(c, abs=1e-4)) for a, b, c in sorted(first + new)]


def test_score_exactly_threshold_kept(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.2, (1 - 0.04) ** 0.5])], "id long, e array<double>")
    got = related_top_k(df, "id", "e", k=5, min_score=0.2).collect()
    assert len(got) == 2


def test_average_rank_ties_and_nulls(spark):
    vals = [3.0, 1.0, 3.0, None, 2.0, 3.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.x: r.pct_rank for r in average_rank(df, "x", buckets=2).collect()}
    exp = pd.Series(vals).rank(pct=True)
    for v, p in zip(vals, exp):
        if v is not None:
            assert got[v] == pytest.approx(p)


def test_quantiles_match_pandas(spark):
    rng = np.random.default_rng(1)
    g = rng.integers(0, 3, 500)
    x = np.round(rng.exponential(10, 500), 1)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x}))
    got = exact_quantiles(df, "x", {"a": 0.25, "b": 0.5, "c": 0.9}, ["g"], buckets=5).toPandas().set_index("g")
    exp = pd.DataFrame({"g": g, "x": x}).groupby("g")["x"].quantile([0.25, 0.5, 0.9]).unstack()
    for k in range(3):
        assert list(got.loc[k, ["a", "b", "c"]]) == pytest.approx(list(exp.loc[k]))


def test_lsh_is_subset_of_exact(spark):
    from tributary.operators.similarity import approx_related
    rng = np.random.default_rng(5)
    base = rng.normal(size=(8, 16))
    v = np.vstack([base[i % 8] + 0.05 * rng.normal(size=16) for i in range(80)]).astype("float32")
    df = spark.createDataFrame([(i, v[i].tolist()) for i in range(80)], "id long, e array<float>")
    exact = {(r.news_id, r.related_news_id) for r in related_top_k(df, "id", "e").collect()}
    approx = approx_related(df, "id", "e", bucket_length=2.0, tables=4).collect()
    assert approx, "LSH found no pairs"
    # Every approximate pair scores at least the threshold and is a real pair.
    assert all(r.score >= 0.2 and r.news_id != r.related_news_id for r in approx)
    got = {(r.news_id, r.related_news_id) for r in approx}
    assert len(got & exact) >= 0.5 * len(got)


@pytest.mark.parametrize("block_size", [40, 8192])
def test_lsh_in_blocks_keeps_the_pairs_of_the_bucket_join(spark, block_size):
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.linalg import Vectors
    from tributary.operators.similarity import approx_related
    v = np.random.default_rng(8).normal(size=(150, 8))
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    u = spark.createDataFrame([(i, Vectors.dense(x)) for i, x in enumerate(unit)], ["id", "f"])
    model = BucketedRandomProjectionLSH(inputCol="f", outputCol="h", bucketLength=0.4, numHashTables=2, seed=7).fit(u)
    h = {r.id: [x[0] for x in r.h] for r in model.transform(u).collect()}
    s = unit @ unit.T
    near = {i: [j for j in range(150) if j != i and s[i, j] >= 0.2 and any(a == b for a, b in zip(h[i], h[j]))] for i in h}
    exp = [(i, j, round(-n, 4)) for i in near for n, j in sorted((-s[i, j], j) for j in near[i])[:5]]
    assert len(exp) < len(_brute(v, range(150))) or exp != _brute(v, range(150))   # buckets do leave pairs out
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, e array<double>")
    got = approx_related(df, "id", "e", bucket_length=0.4, tables=2, block_size=block_size)
    assert sorted(map(tuple, got.collect())) == sorted((a, b, pytest.approx(c, abs=1e-4)) for a, b, c in exp)


def test_scores_of_a_block_pair_are_held_in_chunks():
    import tracemalloc
    from tributary.operators.similarity import _block_topk
    n = 4096
    v = np.random.default_rng(1).normal(size=(2 * n, 16))
    pdf = pd.DataFrame({"__id": np.arange(2 * n), "__vec": list(v), "__role": np.repeat([0, 1], n)})
    tracemalloc.start()
    got = _block_topk(5, 0.2)(pdf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    u = v / np.linalg.norm(v, axis=1)[:, None]
    s = u[:50] @ u[n:].T
    first = got[got.news_id < 50].groupby("news_id").related_news_id.apply(list)
    assert all(first[i] == (n + np.argsort(-s[i])[:5]).tolist() for i in range(50)) and len(got) == 5 * n
    assert peak < 100e6
