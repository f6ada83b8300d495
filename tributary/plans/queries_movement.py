"""Movement, zone and fare queries (O1-O7 parts, E5, E6, C7, H20, H27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import arrived, ellipsoid_km, haversine_km, midpoint, plane_km, trip_fare_parts
from tributary.plans import movement as MV
from tributary.operators.windows import bucketed_lag, first_last
from tributary.plans.catalog import query, table

_ZONES_SQL = """
WITH zraw AS (SELECT * FROM (VALUES
   ('road', 'H1_Linkou_north', 67.0, 153.0, 346.0, 198.0, 177.0, 104.0, 346.0, 109.0, 34.0),
   ('road', 'H3_Zonghe_north', 80.0, 108.0, 306.0, 115.0, 3.0, 136.0, 346.0, 143.0, 24.0))
   AS z(location, zone_name, a1x, a1y, a2x, a2y, b1x, b1y, b2x, b2y, length_m)),
zs AS (SELECT *, sign((a2x - a1x) * ((b1y + b2y) / 2 - a1y) - (a2y - a1y) * ((b1x + b2x) / 2 - a1x)) AS sa0,
                 sign((b2x - b1x) * ((a1y + a2y) / 2 - b1y) - (b2y - b1y) * ((a1x + a2x) / 2 - b1x)) AS sb0
       FROM zraw),
zones AS (SELECT *, CASE WHEN sa0 = 0 OR sb0 = 0 THEN 0 ELSE sa0 END AS sa,
                    CASE WHEN sa0 = 0 OR sb0 = 0 THEN 0 ELSE sb0 END AS sb FROM zs),
pts AS (SELECT user_id AS object_id, event_id, ts, epoch(ts) / 3600.0 AS t, value AS x,
               CAST(CAST(props::JSON->>'k' AS INTEGER) * 2.0 AS DOUBLE) AS y, 'road' AS location FROM events),
pz AS (
  SELECT p.*, z.zone_name, z.length_m,
         (z.sa <> 0 AND z.sb <> 0
          AND (sign((z.a2x - z.a1x) * (p.y - z.a1y) - (z.a2y - z.a1y) * (p.x - z.a1x)) = z.sa
               OR (z.a2x - z.a1x) * (p.y - z.a1y) - (z.a2y - z.a1y) * (p.x - z.a1x) = 0)
          AND (sign((z.b2x - z.b1x) * (p.y - z.b1y) - (z.b2y - z.b1y) * (p.x - z.b1x)) = z.sb
               OR (z.b2x - z.b1x) * (p.y - z.b1y) - (z.b2y - z.b1y) * (p.x - z.b1x) = 0)) AS inside
  FROM pts p JOIN zones z USING (location))"""

_VISITS_SQL = _ZONES_SQL + """,
w1 AS (SELECT *, lag(t) OVER w AS prev_t, lag(inside) OVER w AS prev_in FROM pz
       WINDOW w AS (PARTITION BY object_id, zone_name ORDER BY t, event_id)),
w2 AS (SELECT *, (prev_t IS NULL OR t - prev_t > 10) AS new_track FROM w1),
w3 AS (SELECT *, CASE WHEN new_track THEN false ELSE coalesce(prev_in, false) END AS pit FROM w2),
w4 AS (SELECT *, inside AND NOT pit AS entry, NOT inside AND pit AS "exit" FROM w3),
w5 AS (SELECT *, max(CASE WHEN new_track THEN t END) OVER r AS track_start,
                 max(CASE WHEN entry THEN t END) OVER r AS last_entry FROM w4
       WINDOW r AS (PARTITION BY object_id, zone_name ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
w6 AS (SELECT *, CASE WHEN "exit" THEN CASE WHEN t - last_entry > 0.1 AND t - last_entry < 10
                      THEN round_even(length_m / (t - last_entry) * 3.6, 1) ELSE 0.0 END END AS exit_speed FROM w5),
w7 AS (SELECT *, max(CASE WHEN "exit" THEN t END) OVER r AS lx_t,
                 arg_max(exit_speed, CASE WHEN "exit" THEN t END) OVER r AS lx_s FROM w6
       WINDOW r AS (PARTITION BY object_id, zone_name ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
v AS (SELECT *, CASE WHEN inside THEN 0.0 WHEN lx_t IS NOT NULL AND lx_t >= track_start THEN lx_s ELSE 0.0 END AS speed_kmh
      FROM w7)"""


@query("zone_inside", sql=_ZONES_SQL + """
SELECT object_id, event_id, zone_name, x, y, inside FROM pz""")
def zone_inside(spark, sf):
    return MV.zoned(spark, table(spark, sf, "events")).select("object_id", "event_id", "zone_name", "x", "y", "inside")


@query("zone_visits", sql=_VISITS_SQL + """
SELECT object_id, event_id, zone_name, inside, new_track, entry, "exit" FROM v""")
def zone_visits(spark, sf):
    return MV.speeds(spark, table(spark, sf, "events")).select(
        "object_id", "event_id", "zone_name", "inside", "new_track", "entry", "exit")


@query("zone_speed", sql=_VISITS_SQL + """
SELECT object_id, event_id, zone_name, ts, exit_speed, speed_kmh FROM v""")
def zone_speed_q(spark, sf):
    return MV.speeds(spark, table(spark, sf, "events")).select(
        "object_id", "event_id", "zone_name", "ts", "exit_speed", "speed_kmh")


_GEO_SQL = """
g AS (SELECT c_custkey, c_mktsegment, c_nationkey * 3.0 - 30 AS lat1, c_acctbal / 100 AS lon1,
             c_nationkey * 3.0 - 30 + c_acctbal / 10000 AS lat2, c_acctbal / 100 + 0.05 AS lon2 FROM customer)"""


@query("sphere_distance", sql=f"""WITH {_GEO_SQL}
SELECT c_mktsegment, round_even(avg(2 * 6371.0088 * asin(sqrt(least(1.0,
         pow(sin((radians(lat2) - radians(lat1)) / 2), 2)
         + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2))))), 6) AS avg_km
FROM g WHERE c_mktsegment IS NOT NULL GROUP BY 1""")
def sphere_distance(spark, sf):
    c = table(spark, sf, "customer")
    lat1 = F.col("c_nationkey") * 3.0 - 30
    lon1 = F.col("c_acctbal") / 100
    g = c.select("c_mktsegment", haversine_km(lat1, lon1, lat1 + F.col("c_acctbal") / 10000, lon1 + 0.05).alias("km"))
    return g.filter(F.col("c_mktsegment").isNotNull()).groupBy("c_mktsegment") \
            .agg(F.bround(F.avg("km"), 6).alias("avg_km"))


@query("ellipsoid_distance", sql=f"""WITH RECURSIVE {_GEO_SQL},
k AS (SELECT 6378.137::DOUBLE AS a, (1 / 298.257223563)::DOUBLE AS f),
r AS (SELECT c_custkey, atan2((1 - f) * sin(radians(lat1)), cos(radians(lat1))) AS u1,
             atan2((1 - f) * sin(radians(lat2)), cos(radians(lat2))) AS u2, radians(lon2 - lon1) AS l FROM g, k),
it AS (SELECT c_custkey, u1, u2, l, l AS lam, 0 AS n FROM r
       UNION ALL
       SELECT c_custkey, u1, u2, l,
              l + (1 - c) * f * sa * (s + c * ss * (cm + c * cs * (2 * cm * cm - 1))), n + 1
       FROM (SELECT *, f / 16 * ca2 * (4 + f * (4 - 3 * ca2)) AS c FROM
             (SELECT *, CASE WHEN ca2 < 1e-15 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / ca2 END AS cm FROM
              (SELECT *, 1 - sa * sa AS ca2, atan2(ss, cs) AS s FROM
               (SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa FROM
                (SELECT it.*, f, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
                        sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM it, k WHERE n < 12))))))
SELECT c_custkey, round_even(a * (1 - f) * ba * (s - bb * ss * (cm + bb / 4 * (cs * (2 * cm * cm - 1)
         - bb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))), 6) AS km
FROM (SELECT *, (1 + kk * kk / 4) / (1 - kk) AS ba, kk * (1 - 3 * kk * kk / 8) AS bb FROM
      (SELECT *, (sqrt(1 + w) - 1) / (sqrt(1 + w) + 1) AS kk FROM
       (SELECT *, ca2 * (1 / ((1 - f) * (1 - f)) - 1) AS w,
               CASE WHEN ca2 < 1e-15 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / ca2 END AS cm FROM
        (SELECT *, 1 - sa * sa AS ca2, atan2(ss, cs) AS s FROM
         (SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa FROM
          (SELECT it.*, a, f, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
                  sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM it, k WHERE n = 12))))))""")
def ellipsoid_distance(spark, sf):
    c = table(spark, sf, "customer")
    lat1 = F.col("c_nationkey") * 3.0 - 30
    lon1 = F.col("c_acctbal") / 100
    return c.select("c_custkey", F.bround(ellipsoid_km(lat1, lon1, lat1 + F.col("c_acctbal") / 10000, lon1 + 0.05), 6)
                    .alias("km"))


@query("plane_distance", sql=f"""WITH {_GEO_SQL}
SELECT c_custkey, round_even(sqrt(pow((lat2 - lat1) * 111, 2) + pow((lon2 - lon1) * 111, 2)), 6) AS km FROM g""")
def plane_distance(spark, sf):
    c = table(spark, sf, "customer")
    lat1 = F.col("c_nationkey") * 3.0 - 30
    lon1 = F.col("c_acctbal") / 100
    return c.select("c_custkey", F.bround(plane_km(lat1, lon1, lat1 + F.col("c_acctbal") / 10000, lon1 + 0.05), 6)
                    .alias("km"))


@query("trip_fare", sql="""
WITH f AS (SELECT l_orderkey, l_linenumber, l_quantity / 3.0 AS km, l_discount * 600 AS minutes FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(70.0 AS DOUBLE) AS base_fare, round_even(km * 25, 2) AS distance_fare,
       round_even(minutes * 2, 2) AS time_fare, round_even(70 + km * 25 + minutes * 2, 2) AS amount,
       abs(round_even(70 + km * 25 + minutes * 2, 2) - (70 + round_even(km * 25, 2) + round_even(minutes * 2, 2))) <= 0.011
         AS parts_match
FROM f""")
def trip_fare(spark, sf):
    li = table(spark, sf, "lineitem")
    p = trip_fare_parts(F.col("l_quantity") / 3.0, F.col("l_discount") * 600)
    out = li.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in p.items()])
    return out.withColumn("parts_match", F.abs(F.col("amount") - (F.col("base_fare") + F.col("distance_fare")
                                                                  + F.col("time_fare"))) <= 0.011)


@query("arrival", sql="""
WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, value / 10 AS lat,
                  CAST(props::JSON->>'k' AS INTEGER) / 10.0 AS lon FROM events),
d AS (SELECT user_id, day, arg_max(lat, (ts, event_id)) AS dlat, arg_max(lon, (ts, event_id)) AS dlon FROM p GROUP BY 1, 2),
s AS (SELECT p.*, lat - lag(lat) OVER w AS slat, lon - lag(lon) OVER w AS slon FROM p
      WINDOW w AS (PARTITION BY user_id, day ORDER BY ts, event_id))
SELECT s.user_id, s.event_id, abs(dlat - lat) < abs(slat) AND abs(dlon - lon) < abs(slon) AS arrived
FROM s JOIN d USING (user_id, day)""")
def arrival(spark, sf):
    """One trip per (user, day); the destination is the trip's last
    position (an aggregate) and each step is the offset from the previous
    position (a bucketed lag, so a long trip is not one task)."""
    e = table(spark, sf, "events")
    p = e.select("user_id", F.to_date("ts").alias("day"), "ts", "event_id", (F.col("value") / 10).alias("lat"),
                 (F.from_json("props", "k INT")["k"] / 10.0).alias("lon"),
                 MV.seconds_ntz("ts").alias("t"))
    p = p.withColumn("__us", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    dest = first_last(p, ["user_id", "day"], ["__us", "event_id"], last={"dlat": "lat", "dlon": "lon"})
    p = p.drop("__us")
    s = bucketed_lag(p, ["user_id", "day"], "t", "event_id", ["lat", "lon"], bucket=3600.0)
    s = s.withColumn("slat", F.col("lat") - F.col("prev_lat")).withColumn("slon", F.col("lon") - F.col("prev_lon"))
    j = s.join(dest, ["user_id", "day"])
    return j.select("user_id", "event_id", arrived("lat", "lon", "dlat", "dlon", "slat", "slon").alias("arrived"))


@query("box_centre", sql="""
SELECT event_id, ((value - 2) + (value + 2)) / 2 AS center_x FROM events""")
def box_centre(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", midpoint(F.col("value") - 2, F.col("value") + 2).alias("center_x"))
