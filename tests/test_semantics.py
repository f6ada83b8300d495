"""pandas vs Spark meanings handled by the operators."""

import pytest
from pyspark.sql import functions as F

from tributary.functions import compass_label, day_period, direction_angle, split_part_as, weekday_mon0
from tributary.operators.aggregates import box_stats, mean_std, value_counts
from tributary.operators.stats import kruskal_wallis, one_way_anova
from tributary.plans.analysis import sentinel_to_null


def test_null_group_dropped_and_single_row_std_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), (None, 5.0)], "g string, v double")
    r = {x.g: (x.mean, x.std) for x in mean_std(df, ["g"], "v").collect()}
    assert set(r) == {"a", "b"} and r["b"][1] is None


def test_shares_exclude_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    r = {x.c: x.proportion for x in value_counts(df, "c", normalize=True).collect()}
    assert r == {"a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}


def test_sentinel_and_bad_text(spark):
    df = spark.createDataFrame([("NaN ", "12:3x"), ("x", "1:2:3")], "a string, t string")
    r = sentinel_to_null(df).select("a", split_part_as("t", ":", 2, "int").alias("m"),
                                    split_part_as("t", ":", 5, "int").alias("absent")).collect()
    assert r[0].a is None and r[0].m is None and r[1].m == 2 and r[1].absent is None


def test_angles_and_labels(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0), (0.0, 0.0, 0.0, 0.0), (0.0, 0.0, -1.0, 0.0),
                                (0.0, 0.0, 1.0, -1.0)], "a double, b double, c double, d double")
    r = df.select(direction_angle("a", "b", "c", "d").alias("x")).select("x", compass_label("x").alias("l")).collect()
    assert [x.l for x in r] == ["SE", "Stop", "W", "NE"]
    assert r[3].x == pytest.approx(315.0)


def test_day_period_and_weekday(spark):
    df = spark.createDataFrame([(0,), (6,), (12,), (18,), (None,)], "h int")
    assert [x.p for x in df.select(day_period("h").alias("p")).collect()] == \
        ["Evening", "Morning", "Afternoon", "Evening", "Evening"]
    d = spark.createDataFrame([("2024-01-06",)], "d string").select(weekday_mon0(F.to_date("d")).alias("w"))
    assert d.first().w == 5


def test_anova_kruskal_three_groups(spark):
    rows = [("a", float(v)) for v in (1, 2, 3, 4)] + [("b", float(v)) for v in (2, 3, 4, 5, 5)] + \
           [("c", float(v)) for v in (6, 7, 7, 8)]
    df = spark.createDataFrame(rows, "g string, v double")
    a = one_way_anova(df, "g", "v").first()
    k = kruskal_wallis(df, "g", "v").first()
    # Brute force with numpy/pandas on the same rows.
    import numpy as np
    import pandas as pd
    p = pd.DataFrame(rows, columns=["g", "v"])
    grand, n, kk = p.v.mean(), len(p), 3
    ssb = sum(len(x) * (x.mean() - grand) ** 2 for _, x in p.groupby("g").v)
    ssw = sum(((x - x.mean()) ** 2).sum() for _, x in p.groupby("g").v)
    f = (ssb / (kk - 1)) / (ssw / (n - kk))
    assert a.f_statistic == pytest.approx(f)
    assert a.p_value == pytest.approx((1 + 2 * f / (n - kk)) ** (-(n - kk) / 2))
    p["r"] = p.v.rank()
    h = 12 / (n * (n + 1)) * sum(x.sum() ** 2 / len(x) for _, x in p.groupby("g").r) - 3 * (n + 1)
    t = p.v.value_counts().to_numpy().astype(float)
    h /= 1 - (t ** 3 - t).sum() / (n ** 3 - n)
    assert k.h_statistic == pytest.approx(h)
    assert k.p_value == pytest.approx(np.exp(-h / 2))


def test_box_stats_whiskers(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "v double")
    r = box_stats(df, [], "v").first()
    assert (r.q1, r.median, r.q3, r.whisker_high, r.outliers) == (2.0, 3.0, 4.0, 4.0, 1)
