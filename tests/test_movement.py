"""Zone membership and speed cases (FIXTURES §2)."""

import pytest
from pyspark.sql import functions as F

from tributary.operators.movement import points_in_zones, zone_speed, zone_table

LINE_ZONE = [("L", "z", ((0, 0), (10, 0)), ((0, 10), (10, 10)), 24.0)]
DEGENERATE = [("L", "d", ((0, 0), (10, 0)), ((0, 0), (10, 0)), 24.0)]


def _speeds(spark, rows, zones=LINE_ZONE, **kw):
    rows = [(o, e, float(t), float(x), float(y)) for o, e, t, x, y in rows]
    pts = spark.createDataFrame(rows, "object_id long, event_id long, t double, x double, y double")
    pts = pts.withColumn("location", F.lit("L"))
    z = points_in_zones(pts, zone_table(spark, zones), "x", "y")
    out = zone_speed(z, ["object_id", "zone_name"], "t", "event_id", **kw)
    return {r.event_id: r for r in out.collect()}


def test_point_on_line_is_inside_and_degenerate_never(spark):
    pts = spark.createDataFrame([(1, 1, 0.0, 5.0, 0.0), (1, 2, 1.0, 5.0, 5.0), (1, 3, 2.0, 5.0, 11.0)],
                                "object_id long, event_id long, t double, x double, y double") \
        .withColumn("location", F.lit("L"))
    z = points_in_zones(pts, zone_table(spark, LINE_ZONE + DEGENERATE), "x", "y")
    got = {(r.event_id, r.zone_name): r.inside for r in z.collect()}
    assert got[(1, "z")] is True and got[(2, "z")] is True and got[(3, "z")] is False
    assert not any(v for (e, zn), v in got.items() if zn == "d")


def test_speed_24m_in_1s(spark):
    r = _speeds(spark, [(1, 1, 0.0, 5, -1), (1, 2, 1.0, 5, 5), (1, 3, 2.0, 5, 12), (1, 4, 3.0, 5, 13)])
    assert r[2].entry and r[3].exit
    assert r[3].exit_speed == pytest.approx(86.4)
    assert r[4].speed_kmh == pytest.approx(86.4)  # held after the leave
    assert r[2].speed_kmh == 0.0  # inside


@pytest.mark.parametrize("dt", [0.1, 10.0])
def test_bounds_are_open(spark, dt):
    r = _speeds(spark, [(1, 1, 0.0, 5, 5), (1, 2, dt, 5, 12)])
    assert r[1].entry  # first sighting already inside counts as entry
    assert r[2].exit and r[2].exit_speed == 0.0


def test_gap_of_10_keeps_object_more_forgets(spark):
    keep = _speeds(spark, [(1, 1, 0.0, 5, 5), (1, 2, 10.0, 5, 5), (1, 3, 11.0, 5, 12)])
    assert not keep[2].new_track and keep[3].exit
    lost = _speeds(spark, [(1, 1, 0.0, 5, 5), (1, 2, 10.5, 5, 5), (1, 3, 11.0, 5, 12)])
    assert lost[2].new_track and lost[2].entry
    assert lost[3].exit_speed == pytest.approx(round(24 / 0.5 * 3.6, 1))


def test_held_speed_resets_on_new_track(spark):
    r = _speeds(spark, [(1, 1, 0.0, 5, 5), (1, 2, 1.0, 5, 12), (1, 3, 30.0, 5, 12)])
    assert r[2].speed_kmh == pytest.approx(86.4)
    assert r[3].new_track and r[3].speed_kmh == 0.0


def test_bucketed_carry_equals_unsplit(spark):
    rows = [(o, i, i * 0.37 + o, 5.0, (i * 7) % 15 - 2.0) for o in (1, 2) for i in range(120)]
    a = _speeds(spark, rows, bucket_seconds=0.5)
    b = _speeds(spark, rows, bucket_seconds=1e9)
    assert {k: (v.speed_kmh, v.entry, v.exit, v.new_track) for k, v in a.items()} == \
           {k: (v.speed_kmh, v.entry, v.exit, v.new_track) for k, v in b.items()}


def test_bucketed_lag_equals_window(spark):
    from pyspark.sql import Window
    from tributary.operators.windows import bucketed_lag
    rows = [(k, i, float(i * 3 % 17 + i), float(i)) for k in (1, 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, id long, t double, v double")
    got = {r.id * 10 + r.k: r.prev_v for r in bucketed_lag(df, ["k"], "t", "id", ["v"], bucket=4.0).collect()}
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = {r.id * 10 + r.k: r.p for r in df.withColumn("p", F.lag("v").over(w)).collect()}
    assert got == exp


def test_skew_safe_row_numbers(spark):
    from pyspark.sql import Window
    from tributary.operators.windows import skew_safe_row_numbers
    rows = [(g, i, (i * 7) % 5) for g in ("a", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "g string, u long, ms long")
    got = {(r.g, r.u): (r.rn_asc, r.rn_desc) for r in skew_safe_row_numbers(df, ["g"], "ms", "u").collect()}
    wa = Window.partitionBy("g").orderBy("ms", "u")
    wd = Window.partitionBy("g").orderBy(F.desc("ms"), F.desc("u"))
    exp = {(r.g, r.u): (r.a, r.d) for r in df.select("g", "u", F.row_number().over(wa).alias("a"),
                                                        F.row_number().over(wd).alias("d")).collect()}
    assert got == exp


def test_ellipsoid_distance(spark):
    """Published lengths in metres, near-antipodal and degenerate pairs."""
    from tributary.functions import ellipsoid_km
    q, m = 10001965.7293, 20003931.4586
    cases = [(-(37 + 57 / 60 + 3.72030 / 3600), 144 + 25 / 60 + 29.52440 / 3600,
              -(37 + 39 / 60 + 10.15610 / 3600), 143 + 55 / 60 + 35.38390 / 3600, 54972.271),
             (0.0, 0.0, 0.5, 179.5, 19936288.579), (0.0, 0.0, 0.5, 179.7, 19944127.421),
             (-90.0, 0.0, 90.0, 0.0, m), (0.0, 0.0, 90.0, 50.0, q), (0.0, 0.0, 0.0, 180.0, m),
             (30.0, 0.0, -30.0, 180.0, m), (0.0, 179.5, 0.0, -179.5, 111319.491), (12.0, 5.0, 12.0, 5.0, 0.0),
             (12.0, 5.0, 12.0, 365.0, 0.0), (None, 0.0, 1.0, 1.0, None), (91.0, 0.0, 1.0, 1.0, None),
             (float("nan"), 0.0, 1.0, 1.0, None)]
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "i int, a double, b double, c double, d double")
    got = {r.i: (r.km, r.back) for r in df.select("i", ellipsoid_km("a", "b", "c", "d").alias("km"),
                                                  ellipsoid_km("c", "d", "a", "b").alias("back")).collect()}
    for i, c in enumerate(cases):
        for km in got[i]:
            assert (km is None) if c[4] is None else km * 1000 == pytest.approx(c[4], abs=2e-3), (c, km)
