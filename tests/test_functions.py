"""Scalar helpers (H, O formulas)."""

import math

import pytest
from pyspark.sql import functions as F

from tributary.functions import (arrived, direction_angle, haversine_km, month_text, n_months_ago, n_weeks_ago,
                                 percent_number, plane_km, quarter_text, round_half_even, scale_to_long, text_number,
                                 trip_fare_parts, yesterday)


def test_period_texts_and_relative_dates(spark):
    r = spark.range(1).select(quarter_text(F.to_date(F.lit("2022-11-05"))).alias("q"),
                              month_text(F.to_date(F.lit("2022-12-31"))).alias("m"),
                              yesterday("2024-03-01").alias("y"), n_weeks_ago(2, "2024-03-01").alias("w"),
                              n_months_ago(1, "2024-03-31").alias("mo")).first()
    assert (r.q, r.m, str(r.y), str(r.w), str(r.mo)) == ("2022Q4", "2022-12", "2024-02-29", "2024-02-16",
                                                         "2024-02-29")


def test_number_texts(spark):
    df = spark.createDataFrame([(" 2,288,966 ", "2.0%", 2.5, 3.5, 1.2345)], "a string, b string, c double, d double, e double")
    r = df.select(text_number("a").alias("a"), percent_number("b").alias("b"), round_half_even("c").alias("c"),
                  round_half_even("d").alias("d"), scale_to_long("e").alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == (2288966, 2.0, 2.0, 4.0, 1234)
    bad = spark.createDataFrame([("n/a",)], "a string").select(text_number("a").alias("a")).first()
    assert bad.a is None


def test_fare_parts_and_check(spark):
    r = spark.range(1).select(*[v.alias(k) for k, v in trip_fare_parts(F.lit(3.333), F.lit(7.777)).items()]).first()
    # Python rounds the binary value, bround the decimal text:
    # compare within one unit in the last place.
    assert r.base_fare == 70.0
    assert abs(r.distance_fare - round(3.333 * 25, 2)) <= 0.01 + 1e-9
    assert abs(r.time_fare - round(7.777 * 2, 2)) <= 0.01 + 1e-9
    assert r.amount == pytest.approx(round(70 + 3.333 * 25 + 7.777 * 2, 2))


def test_distances(spark):
    r = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("h"),
                              plane_km(F.lit(0.0), F.lit(0.0), F.lit(3.0 / 111), F.lit(4.0 / 111)).alias("p")).first()
    assert r.h == pytest.approx(2 * math.pi * 6371.0088 / 360, rel=1e-9)
    assert r.p == pytest.approx(5.0)


def test_angle_wraps_and_arrival(spark):
    r = spark.range(1).select(direction_angle(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)).alias("e"),
                              direction_angle(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(-1.0)).alias("n"),
                              arrived(F.lit(1.0), F.lit(1.0), F.lit(1.05), F.lit(0.95), F.lit(0.1), F.lit(-0.1)).alias("a"),
                              arrived(F.lit(1.0), F.lit(1.0), F.lit(1.2), F.lit(1.0), F.lit(0.1), F.lit(0.1)).alias("b")
                              ).first()
    assert (r.e, r.n, r.a, r.b) == (0.0, 270.0, True, False)


def test_remaining_helpers(spark):
    from tributary.functions import audit_stamp, safe_ratio, tolerant_timestamp
    from tributary.operators.windows import packed_order_key, unpack_major
    r = spark.range(1).select(
        tolerant_timestamp(F.lit("2024/01/02 03:04"), "yyyy/MM/dd HH:mm").alias("a"),
        tolerant_timestamp(F.lit("bad"), "yyyy/MM/dd HH:mm").alias("b"),
        safe_ratio(F.lit(1.0), F.lit(0.0)).alias("c"),
        unpack_major(packed_order_key(F.lit(12345), F.lit(-7))).alias("d"),
        audit_stamp().isNotNull().alias("e")).first()
    assert str(r.a).startswith("2024-01-02 03:04") and r.b is None and r.c is None and r.d == 12345 and r.e
