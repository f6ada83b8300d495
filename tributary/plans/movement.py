"""Movement stand-ins over ``events``.

A sighting is an event: object = user_id, point = (value, 2 x props.k),
all on one road with both configured zones.  Time is scaled so an hour of
event time is one second of sighting time (``TIME_SCALE``): the 10-second
forget gap and the 0.1-10 s visit bounds then matter on this data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.movement import points_in_zones, zone_speed, zone_table

TIME_SCALE = 1.0 / 3600.0
ROAD = "road"


def seconds_ntz(ts: str) -> F.Column:
    """Seconds since the epoch of a TIMESTAMP_NTZ, independent of the
    session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})") / 1e6


def sightings(events: DataFrame) -> DataFrame:
    k = F.from_json(F.col("props"), "k INT")["k"]
    return events.select(
        F.col("user_id").alias("object_id"), "event_id", "ts",
        (seconds_ntz("ts") * TIME_SCALE).alias("t"),
        F.col("value").alias("x"), (k * 2.0).alias("y"), F.lit(ROAD).alias("location"))


def zoned(spark: SparkSession, events: DataFrame) -> DataFrame:
    return points_in_zones(sightings(events), zone_table(spark, location=ROAD), "x", "y")


def speeds(spark: SparkSession, events: DataFrame) -> DataFrame:
    return zone_speed(zoned(spark, events), ["object_id", "zone_name"], "t", "event_id")
