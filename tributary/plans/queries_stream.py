"""Streaming queries: events as a file stream with ``availableNow``; each
returns the table its sink wrote (read back), to be compared with the
batch result over the same rows.  Sinks and checkpoints live under the
session's shared checkpoint folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.schemas import TAXI_TOPICS
from tributary.session import checkpoint_dir
from tributary.streaming import ingest as S
from tributary.streaming.supervisor import supervise
from tributary.streaming.zone_state import latest, stream_zone_speed
from tributary.plans import movement as MV
from tributary.operators.keyed_table import KeyedTable
from tributary.operators.movement import points_in_zones, zone_table
from tributary.plans.catalog import query, table
from tributary.plans.queries_movement import _VISITS_SQL
from tributary.plans.queries_road import _MART_SQL

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"


_EVENTS_SQL = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"""


@query("stream_parquet", sql=_EVENTS_SQL)
def stream_parquet(spark, sf):
    """File stream -> keyed JSON records -> parsed back
    by the declared schema -> watermark -> parquet sink with checkpoint."""
    base = _scratch(spark)
    ev = S.file_stream(spark, sf, "events")
    schema = S.with_event_watermark(ev, "ts", "2 minutes").schema
    recs = S.keyed_json(ev.withColumn("ts", F.col("ts").cast("timestamp")), "event_id")
    parsed = S.parse_json_values(recs, schema)
    q = S.parquet_sink(S.with_event_watermark(parsed, "ts", "2 minutes"), f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("event_id", F.date_format("ts", TS_TEXT).alias("ts"), "user_id", "event_type", "value", "props")


@query("stream_upsert", sql=_EVENTS_SQL)
def stream_upsert(spark, sf):
    """Micro-batch upsert by key into a keyed table (deltas, merged
    when read); the same stream loaded twice (two checkpoints) leaves the table
    as one load does."""
    base = _scratch(spark)
    for i in range(2):
        ev = S.file_stream(spark, sf, "events", max_files_per_trigger=1)
        S.upsert_sink(ev, f"{base}/table", ["event_id"], f"{base}/ck{i}").awaitTermination()
    out = KeyedTable(spark, f"{base}/table").read()
    return out.select("event_id", F.date_format("ts", TS_TEXT).alias("ts"), "user_id", "event_type", "value", "props")


@query("stream_dedup", sql=_EVENTS_SQL)
def stream_dedup(spark, sf):
    """Every event arrives twice (two file streams), newest quarter first,
    a file a trigger; one copy of each stays, late ones too."""
    base = _scratch(spark)
    e = table(spark, sf, "events")
    cuts = e.select(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75]).alias("q")).first().q
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = [-(1 << 62), *(cuts or [0, 0, 0]), 1 << 62]
    for i, (lo, hi) in enumerate(reversed(list(zip(bounds, bounds[1:])))):
        e.filter((us > lo) & (us <= hi)).write.parquet(f"{base}/in/part{i}")
    a, b = (spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/part*") for _ in range(2))
    S.dedup_sink(a.unionByName(b), f"{base}/out", ["event_id"], f"{base}/ck", order=["ts"]).awaitTermination()
    out = spark.read.schema(e.schema).parquet(f"{base}/out")
    return out.select("event_id", F.date_format("ts", TS_TEXT).alias("ts"), "user_id", "event_type", "value", "props")


@query("stream_fanout", sql="""
SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')
UNION ALL SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')""")
def stream_fanout(spark, sf):
    """Two queries (two topics) under one supervisor."""
    base = _scratch(spark)
    ev = S.file_stream(spark, sf, "events").select("event_id", "event_type")
    q1 = S.parquet_sink(ev.filter(F.col("event_type").isin("click", "view")), f"{base}/a", f"{base}/cka")
    q2 = S.parquet_sink(ev.filter(~F.col("event_type").isin("click", "view")), f"{base}/b", f"{base}/ckb")
    supervise(spark, [q1, q2])
    return spark.read.parquet(f"{base}/a").unionByName(spark.read.parquet(f"{base}/b"))


@query("stream_zone_speed", sql=_VISITS_SQL + """
SELECT object_id, event_id, zone_name, new_track, entry, "exit", exit_speed, speed_kmh FROM v""")
def stream_zone_speed_q(spark, sf):
    """I4: the zone state machine as a stateful stream over the events in four
    files, newest first, one a trigger; equals the batch ``zone_speed``."""
    base = _scratch(spark)
    e = table(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = e.select(F.percentile_approx(us, [0.25, 0.5, 0.75]).alias("q")).first().q
    bounds = [-(1 << 62), *(cuts or [0, 0, 0]), 1 << 62]
    for lo, hi in reversed(list(zip(bounds, bounds[1:]))):  # the file source reads by the files' times
        e.filter((us > lo) & (us <= hi)).repartition(1).write.mode("append").parquet(f"{base}/in")
    ev = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    zoned = points_in_zones(MV.sightings(ev), zone_table(spark, location=MV.ROAD), "x", "y") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    # All of the input may come late, so its whole time is kept.
    S.parquet_sink(stream_zone_speed(zoned, keep_seconds=1e12), f"{base}/out", f"{base}/ck", output_mode="update").awaitTermination()
    r = latest(spark.read.parquet(f"{base}/out"))
    return r.select("object_id", "event_id", "zone_name", "new_track", "entry", "exit", "exit_speed", "speed_kmh")


# Stand-in values of a topic's columns, by type, from an event.
# (Split here: Spark parses a DDL text only where a session is up.)
_TOPIC_FIELDS = {t: [tuple(f.split()) for f in ddl.split(",")] for t, (ddl, _) in TAXI_TOPICS.items()}


def _names(topic, dtype):
    return [name for name, t in _TOPIC_FIELDS[topic] if t == dtype]


def _topic_sql(topic):
    texts = ", ".join(f"event_id || '-{c}'" for c in _names(topic, "string"))
    number = "value" if _names(topic, "double") else "CAST(NULL AS DOUBLE)"
    whole = "CAST(event_id % 1000 AS INTEGER)" if _names(topic, "int") else "CAST(NULL AS INTEGER)"
    return (f"SELECT '{topic}' AS topic, concat_ws('|', {texts}) AS texts, {number} AS low, {number} AS high, "
            f"{whole} AS whole, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events")


@query("stream_topics", sql="\nUNION ALL ".join(_topic_sql(t) for t in TAXI_TOPICS))
def stream_topics(spark, sf):
    """All seven topics written as keyed JSON text (the broker
    stand-in), read as streams, parsed by their declared schemas (watermark
    only where the topic has ``timestamp``), sunk to parquet under one
    supervisor; every output is read back."""
    from tributary.streaming.topics import run_topics
    base = _scratch(spark)
    e = table(spark, sf, "events")
    ident = F.col("event_id").cast("string")
    value_of = {"string": lambda c: F.concat(ident, F.lit(f"-{c}")), "double": lambda c: F.col("value"),
                "int": lambda c: (F.col("event_id") % 1000).cast("int"),
                "timestamp": lambda c: F.col("ts").cast("timestamp")}
    for t, fields in _TOPIC_FIELDS.items():
        df = e.select(*[value_of[dtype](name).alias(name) for name, dtype in fields])
        S.write_topic(S.keyed_json(df, TAXI_TOPICS[t][1]), f"{base}/topics/{t}")
    run_topics(spark, {t: spark.readStream.text(f"{base}/topics/{t}") for t in TAXI_TOPICS}, f"{base}/out", f"{base}/ck")
    parts = []
    for t in TAXI_TOPICS:
        numbers = F.array(*_names(t, "double")).cast("array<double>")
        whole = F.array(*_names(t, "int")).cast("array<int>")
        parts.append(spark.read.parquet(f"{base}/out/{t}").select(
            F.lit(t).alias("topic"), F.concat_ws("|", *_names(t, "string")).alias("texts"),
            F.array_min(numbers).alias("low"), F.array_max(numbers).alias("high"), F.array_max(whole).alias("whole"),
            F.date_format(_names(t, "timestamp")[0], TS_TEXT).alias("ts")))
    return reduce(DataFrame.unionByName, parts)


@query("road_stream_mart", sql=_MART_SQL)
def road_stream_mart(spark, sf):
    """Road lifecycle end to end: detections as keyed JSON on a
    topic stand-in -> stream parsed by the declared schema -> micro-batch
    upsert by uuid into the raw table -> staging -> movement mart."""
    from tributary.plans import road
    from tributary.schemas import DETECTIONS
    base = _scratch(spark)
    det = road.detections_from_events(table(spark, sf, "events")).withColumn("uuid", F.col("uuid").cast("string"))
    S.write_topic(S.keyed_json(det, "uuid"), f"{base}/topic")
    parsed = S.parse_json_values(spark.readStream.text(f"{base}/topic"), DETECTIONS)
    S.upsert_sink(parsed, f"{base}/raw", ["uuid"], f"{base}/ck").awaitTermination()
    raw = KeyedTable(spark, f"{base}/raw").read().withColumn("uuid", F.col("uuid").try_cast("long"))
    return road.traffic_objects(road.staging(raw))


@query("road_marts_incremental", sql=_MART_SQL)
def road_marts_incremental(spark, sf):
    """K4 in the road lifecycle: staging loaded in two halves of each day, the
    second one twice; the objects mart equals one full build."""
    from tributary.plans import road
    base = _scratch(spark)
    events = table(spark, sf, "events")
    halves = [road.staging(road.detections_from_events(events.filter(c)))
              for c in (F.hour("ts") < 12, F.hour("ts") >= 12)]
    for part in (halves[0], halves[1], halves[1]):
        paths = road.refresh_marts(spark, part, base)
    return KeyedTable(spark, paths["objects"]).read()
