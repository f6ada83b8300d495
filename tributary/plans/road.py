"""Road-traffic marts (O7 and its parts: B1, D1, E1, E2, H18, H19).

Detections arrive as rows of (date, time text, object, uuid, class, box,
confidence, centre, zone, speed).  The driver's ``events`` table stands in:
object = user_id, class = event_type, confidence = speed = centre x =
value, centre y = props.k, zone = ``zone_{k % 3}``, uuid = event_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import compass_label, direction_angle, midpoint, split_part_as, time_text
from tributary.operators.windows import bidirectional_rank, first_last, skew_safe_row_numbers
from tributary.session import cut_lineage

MART_KEYS = ["date_utc", "object_id", "class", "zone_name"]
PROPS_SCHEMA = "k INT"
BOX_HALF = 2.0


def detections_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` onto the detection stream schema (FIXTURES §1)."""
    k = F.from_json(F.col("props"), PROPS_SCHEMA)["k"]
    e = events.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    return e.select(
        F.to_date("ts").alias("capture_date_utc"),
        time_text("ts").alias("capture_time_utc"),
        F.col("user_id").cast("string").alias("object_id"),
        F.col("event_id").alias("uuid"),
        F.col("event_type").alias("class"),
        (F.col("value") - BOX_HALF).alias("bounding_box_x1"),
        (F.col("k") - BOX_HALF).alias("bounding_box_y1"),
        (F.col("value") + BOX_HALF).alias("bounding_box_x2"),
        (F.col("k") + BOX_HALF).alias("bounding_box_y2"),
        F.col("value").alias("confidence"),
        F.col("value").alias("speed_kmh"),
        F.when(F.col("k").isNotNull(), F.concat(F.lit("zone_"), F.pmod(F.col("k"), F.lit(3)).cast("string")))
         .alias("zone_name"),
    )


def staging(det: DataFrame) -> DataFrame:
    """B1/H1/H2: date parts, time split into typed parts, renamed box,
    box centre (H20)."""
    t = F.col("capture_time_utc")
    return det.select(
        F.col("capture_date_utc").alias("date_utc"),
        F.year("capture_date_utc").alias("year"),
        F.month("capture_date_utc").alias("month"),
        F.dayofmonth("capture_date_utc").alias("day"),
        t.alias("time_utc"),
        split_part_as(t, ":", 1, "int").alias("hour"),
        split_part_as(t, ":", 2, "int").alias("minute"),
        split_part_as(t, ":", 3, "double").alias("second"),
        "object_id", "uuid", "class",
        F.col("bounding_box_x1").alias("bounding_box_left_top_x"),
        F.col("bounding_box_y1").alias("bounding_box_left_top_y"),
        F.col("bounding_box_x2").alias("bounding_box_right_bottom_x"),
        F.col("bounding_box_y2").alias("bounding_box_right_bottom_y"),
        "confidence",
        midpoint("bounding_box_x1", "bounding_box_x2").alias("center_pixels_x"),
        midpoint("bounding_box_y1", "bounding_box_y2").alias("center_pixels_y"),
        "zone_name", "speed_kmh",
    )


def ranked(stg: DataFrame, skew_safe: bool = True) -> DataFrame:
    """E1 on the staging rows (ties broken by uuid).  The skew-safe form
    ranks by (milliseconds of the day, uuid) through distributed positions;
    the window form sorts each group in one task."""
    if not skew_safe:
        return bidirectional_rank(stg, MART_KEYS, "time_utc", "uuid")
    return skew_safe_row_numbers(_with_ms(stg), MART_KEYS, "__ms", "uuid").drop("__ms")


def group_metrics(stg: DataFrame) -> DataFrame:
    """Mean confidence and top speed per object, day, class and zone."""
    return stg.groupBy(*MART_KEYS).agg(F.avg("confidence").alias("confidence"),
                                       F.max("speed_kmh").alias("speed_kmh"))


def _with_ms(stg: DataFrame) -> DataFrame:
    """Milliseconds of the day from the parsed time parts: a fixed-width
    value that orders exactly like the fixed-width time text."""
    ms = (F.col("hour").cast("long") * 3600000 + F.col("minute").cast("long") * 60000
          + F.round(F.col("second") * 1000).cast("long"))
    return stg.withColumn("__ms", ms)


def _ms_text(ms: str) -> Column:
    m = F.col(ms)
    return F.format_string("%02d:%02d:%02d.%03d", (m / 3600000).cast("int"),
                           ((m % 3600000) / 60000).cast("int"), ((m % 60000) / 1000).cast("int"),
                           (m % 1000).cast("int"))


def _summary(stg: DataFrame, aggs: list[Column] | None = None) -> DataFrame:
    g = first_last(
        _with_ms(stg), MART_KEYS, ["__ms", "uuid"],
        first={"__first_ms": "__ms", "first_center_x": "center_pixels_x",
               "first_center_y": "center_pixels_y"},
        last={"last_center_x": "center_pixels_x", "last_center_y": "center_pixels_y"},
        aggs=aggs)
    return g.withColumn("time_utc", _ms_text("__first_ms")).drop("__first_ms")


def first_last_points(stg: DataFrame) -> DataFrame:
    """First time and point, last point, per group; one aggregation."""
    return _summary(stg)


def traffic_objects(stg: DataFrame) -> DataFrame:
    """Movement summary per (day, object, class, zone).

    One ``groupBy`` with partial aggregation computes the averages, maxima
    and both end points (``min_by``/``max_by`` over a packed fixed-width
    (time, uuid) key, so it stays a hash aggregate), where the reference
    ranks twice and joins three relations.  Rows that lack the date,
    object, class or zone never reach the mart (the reference's inner joins
    drop them)."""
    g = _summary(stg, aggs=[F.avg("confidence").alias("confidence"), F.max("speed_kmh").alias("speed_kmh")])
    # Groups with a null key are dropped after the aggregation: filtering before it
    # would make the optimizer parse the JSON twice per row.
    for key in ("date_utc", "object_id", "class", "zone_name"):
        g = g.filter(F.col(key).isNotNull())
    ang = direction_angle("first_center_x", "first_center_y", "last_center_x", "last_center_y")
    return g.select("date_utc", "time_utc", "object_id", "class",
                    F.bround("confidence", 6).alias("confidence"),
                    "first_center_x", "first_center_y", "last_center_x", "last_center_y",
                    "zone_name", "speed_kmh",
                    F.bround(ang, 6).alias("direction_angle_degrees"),
                    compass_label(ang).alias("object_direction"))


def traffic_objects_sorted(stg: DataFrame) -> DataFrame:
    """the mart in its published order (a range-partitioned sort)."""
    return traffic_objects(stg).orderBy("date_utc", "time_utc", "object_id", "class", "zone_name")


def refresh_marts(spark, stg: DataFrame, base: str) -> dict[str, str]:
    """K4 for both road marts, keyed tables, so a repeated load leaves them
    unchanged and a load writes what it touches only.  The traffic mart (uuid)
    goes first; then the (day, object, class, zone) groups that the new rows
    touch are summarised again from all their rows in it, so a group that
    arrives in several loads keeps its earlier rows.  A new row may also move
    out of a group, so the groups its old form was in are touched as well, and
    a group without rows goes."""
    from tributary.operators.keyed_table import KeyedTable
    paths = {"traffic": f"{base.rstrip('/')}/fct_highway_traffic", "objects": f"{base.rstrip('/')}/fct_traffic_objects"}
    traffic, objects = KeyedTable(spark, paths["traffic"], ["uuid"]), KeyedTable(spark, paths["objects"], MART_KEYS)
    touched = stg.select(*MART_KEYS)
    if traffic.version():
        replaced = traffic.read().join(stg.select("uuid").distinct(), on="uuid", how="left_semi")
        touched = touched.unionByName(replaced.select(*MART_KEYS))
    touched = cut_lineage(touched.dropna().distinct())
    traffic.upsert(stg)
    new = traffic_objects(traffic.read().join(touched, on=MART_KEYS, how="left_semi").select(*stg.columns))
    objects.upsert(new, deleted=touched)
    return paths
