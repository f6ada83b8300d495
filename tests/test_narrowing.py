"""Order statistics by narrowing against numpy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tributary.operators import narrowing
from tributary.operators.aggregates import profile_numeric, profile_text

PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}


def values(n=6000, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.choice(["x", "y", "z"], n, p=[.9, .09, .01]), "v": np.round(rng.lognormal(3, 2, n), 2), "w": rng.integers(-3, 4, n) * 1.0})
    pdf.loc[rng.random(n) < .4, "v"] = 7.25                 # one value holds a large part
    pdf.loc[rng.random(n) < .05, "w"] = None
    return pdf


@pytest.mark.parametrize("accuracy", [50, 10_000])          # brackets from a sketch, and whole groups
def test_quantiles(spark, accuracy):
    pdf = values()
    df = spark.createDataFrame(pdf.astype({"w": object}).where(pdf.notna(), None), "g string, v double, w double")
    got = narrowing.quantiles(df, ["v", "w"], PROBS, ["g"], accuracy).toPandas().set_index(["g", "column_name"]).sort_index()
    for (g, c), row in got.iterrows():
        want = pdf.loc[pdf.g == g, c].dropna().quantile(list(PROBS.values()))
        assert row.to_numpy(float) == pytest.approx(want.to_numpy(), rel=1e-12)
    assert len(got) == 6
    assert narrowing.quantiles(df.limit(0), ["v"], PROBS, ["g"], accuracy).count() == 0
    one = narrowing.quantiles(df, ["v"], PROBS, accuracy=accuracy).first()
    assert [one[p] for p in PROBS] == pytest.approx(pdf.v.quantile(list(PROBS.values())).to_numpy(), rel=1e-12)


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_box(spark, accuracy):
    pdf = values(4000, 2)
    got = narrowing.box(spark.createDataFrame(pdf[["g", "v"]]), ["g"], "v", accuracy).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        q1, q2, q3 = part.v.quantile([.25, .5, .75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = part.v[(part.v >= lo) & (part.v <= hi)]
        want = [q1, q2, q3, q3 - q1, inside.min(), inside.max(), len(part) - len(inside)]
        assert got.loc[g, ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high", "outliers"]].to_numpy(float) == pytest.approx(want, rel=1e-12)
    same = narrowing.box(spark.createDataFrame([("k", 2.0)] * 5, "g string, v double"), ["g"], "v").first()
    assert (same.q1, same.whisker_low, same.whisker_high, same.outliers) == (2.0, 2.0, 2.0, 0)


@pytest.mark.parametrize("accuracy", [50, 10_000])
@pytest.mark.parametrize("share", [0.05, 0.5, 0.8, 0.999, 1.0])
def test_value_at_share(spark, accuracy, share):
    pdf = values(5000, 3)
    rank = pdf.v.rank(pct=True)
    df = spark.createDataFrame(pdf[["v"]])
    got = df.filter(F.col("v") >= narrowing.value_at_share(df, "v", share, accuracy)).count()
    assert got == int((rank >= share).sum())


def test_profiles_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(1, None, "a", None), (3, None, "b", None), (None, None, "b", None)], "x int, y double, s string, t string")
    p = {r.column_name: r for r in profile_numeric(df).collect()}
    assert (p["x"]["count"], p["x"].mean, p["x"].q50) == (2, 2.0, 2.0) and p["y"]["count"] == 0 and p["y"].q50 is None
    t = {r.column_name: r for r in profile_text(df).collect()}
    assert (t["s"]["count"], t["s"].unique, t["s"].top, t["s"].freq) == (3, 2, "b", 2) and (t["t"]["count"], t["t"].top) == (0, None)
