"""Stream parsing, sinks and supervision (FIXTURES §1 cases)."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tributary.operators.keyed_table import KeyedTable
from tributary.schemas import DETECTIONS
from tributary.session import checkpoint_dir
from tributary.streaming.ingest import parse_json_values, upsert_sink
from tributary.streaming.supervisor import supervise


def _topic(spark, lines):
    base = f"{checkpoint_dir(spark)}/t_{uuid.uuid4().hex}"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/topic")
    return base


def test_parse_drops_extra_fields_and_bad_json(spark):
    rec = {"capture_date_utc": "2024-01-02", "capture_time_utc": "10:00:00.000", "object_id": "o",
           "uuid": "u1", "class": "car", "confidence": 0.9, "location_name": "extra", "zones_data": []}
    no_zone = dict(rec, uuid="u2")
    df = spark.createDataFrame([(json.dumps(rec),), ("not json",), (json.dumps(no_zone),)], "value string")
    out = parse_json_values(df, DETECTIONS)
    assert "location_name" not in out.columns
    rows = out.collect()
    assert rows[0].uuid == "u1" and str(rows[0].capture_date_utc) == "2024-01-02"
    assert all(v is None for v in rows[1])  # non-JSON value: all columns null
    assert rows[2].zone_name is None


def test_upsert_sink_keeps_one_row_per_uuid(spark):
    recs = [{"uuid": "a", "object_id": "1", "speed_kmh": 1.0}, {"uuid": "a", "object_id": "1", "speed_kmh": 2.0},
            {"uuid": "b", "object_id": "2", "speed_kmh": 3.0}]
    base = _topic(spark, [json.dumps(r) for r in recs])
    stream = parse_json_values(spark.readStream.text(f"{base}/topic"), DETECTIONS)
    upsert_sink(stream, f"{base}/raw", ["uuid"], f"{base}/ck").awaitTermination()
    upsert_sink(parse_json_values(spark.readStream.text(f"{base}/topic"), DETECTIONS),
                f"{base}/raw", ["uuid"], f"{base}/ck2").awaitTermination()
    got = KeyedTable(spark, f"{base}/raw").read()
    assert got.count() == 2 and got.filter(F.col("uuid") == "a").count() == 1


def test_supervisor_raises_and_stops_others(spark):
    base = _topic(spark, ["1", "2", "3"])
    ok = spark.readStream.text(f"{base}/topic").writeStream.format("noop").start()
    bad = (spark.readStream.text(f"{base}/topic")
           .select(F.raise_error(F.lit("boom")).alias("x"))
           .writeStream.format("noop").trigger(availableNow=True).start())
    with pytest.raises(RuntimeError, match="boom"):
        supervise(spark, [ok, bad])
    assert not ok.isActive


def test_zone_state_across_micro_batches(spark):
    """State carried between micro-batches gives the batch result."""
    from tributary.operators.movement import points_in_zones, zone_table
    from tributary.plans import movement as MV
    from tributary.streaming.ingest import parquet_sink, with_event_watermark
    from tributary.streaming.zone_state import stream_zone_speed

    base = f"{checkpoint_dir(spark)}/zs_{uuid.uuid4().hex}"
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    q = ev.select(F.percentile_approx("event_id", [0.25, 0.5, 0.75]).alias("q")).first().q
    bounds = [-1, *q, 1 << 62]
    for i in range(4):  # event ids grow with time: four time-ordered files
        ev.filter((F.col("event_id") > bounds[i]) & (F.col("event_id") <= bounds[i + 1])) \
          .coalesce(1).write.parquet(f"{base}/in/part{i}")
    files = spark.read.parquet(f"{base}/in/part*")
    stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/part*")
    z = points_in_zones(MV.sightings(stream), zone_table(spark, location=MV.ROAD), "x", "y")
    out = stream_zone_speed(with_event_watermark(z, "ts", "10 hours"), keep_seconds=60.0)
    parquet_sink(out, f"{base}/out", f"{base}/ck").awaitTermination()
    got = {(r.event_id, r.zone_name): (r.speed_kmh, r.entry, r.exit, r.new_track)
           for r in spark.read.parquet(f"{base}/out").collect()}
    exp = {(r.event_id, r.zone_name): (r.speed_kmh, r.entry, r.exit, r.new_track)
           for r in MV.speeds(spark, ev).collect()}
    assert got == exp


def _zoned(spark, base, bounds, order):
    """Events in files by event id, read one a trigger in the given order."""
    import os
    from tributary.operators.movement import points_in_zones, zone_table
    from tributary.plans import movement as MV
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for turn, i in enumerate(order):
        part = ev.filter((F.col("event_id") > bounds[i]) & (F.col("event_id") <= bounds[i + 1]))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        for f in os.listdir(f"{base}/in".removeprefix("file:")):   # read in order of their times
            if f.endswith(".parquet") and not f.startswith("seen"):
                os.rename(f"{base}/in/{f}".removeprefix("file:"), f"{base}/in/seen{turn}.parquet".removeprefix("file:"))
                os.utime(f"{base}/in/seen{turn}.parquet".removeprefix("file:"), (1_600_000_000 + turn * 100,) * 2)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    return ev, points_in_zones(MV.sightings(stream), zone_table(spark, location=MV.ROAD), "x", "y").withColumn("ts", F.col("ts").cast("timestamp"))


def _speeds(rows):
    return {(r.event_id, r.zone_name): (r.new_track, r.entry, r.exit, r.exit_speed, r.speed_kmh) for r in rows}


def test_zone_state_newest_files_first_equals_batch(spark):
    """Files newest first, one a trigger, one delivered twice: every row, with
    the batch's results, once in the latest revisions."""
    from tributary.plans import movement as MV
    from tributary.streaming.ingest import parquet_sink
    from tributary.streaming.zone_state import expired, latest, stream_zone_speed
    base = f"{checkpoint_dir(spark)}/zd_{uuid.uuid4().hex}"
    q = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.percentile_approx("event_id", [0.25, 0.5, 0.75]).alias("q")).first().q
    ev, z = _zoned(spark, base, [-1, *q, 1 << 62], [3, 2, 1, 2, 0])
    parquet_sink(stream_zone_speed(z, keep_seconds=1e9), f"{base}/out", f"{base}/ck", output_mode="update").awaitTermination()
    sent = spark.read.parquet(f"{base}/out")
    got = latest(sent).collect()
    want = MV.speeds(spark, ev).collect()
    assert len(got) == len(want) and _speeds(got) == _speeds(want)
    assert expired(sent).count() == 0 and sent.select(F.max("revision")).first()[0] > 1


def test_zone_state_late_rows_go_to_the_side_output(spark):
    """What is older than the buffer is sent as expired, and no row is lost."""
    from tributary.plans import movement as MV
    from tributary.streaming.ingest import parquet_sink
    from tributary.streaming.zone_state import expired, latest, stream_zone_speed
    base = f"{checkpoint_dir(spark)}/ze_{uuid.uuid4().hex}"
    q = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.percentile_approx("event_id", [0.5]).alias("q")).first().q
    ev, z = _zoned(spark, base, [-1, *q, 1 << 62], [1, 0])
    parquet_sink(stream_zone_speed(z, keep_seconds=60.0), f"{base}/out", f"{base}/ck", output_mode="update").awaitTermination()
    sent = spark.read.parquet(f"{base}/out")
    late, kept = expired(sent).count(), latest(sent).count()
    assert late > 0 and late + kept == MV.speeds(spark, ev).count()


def _feed(spark, base, rows, name):
    schema = "object_id long, zone_name string, event_id long, ts timestamp, t double, inside boolean, length_m double"
    spark.createDataFrame([(1 if i < 9 else 2, "z", i, None, t, a, 10.0) for i, t, a in rows], schema) \
        .withColumn("ts", F.timestamp_millis((F.col("t") * 1000).cast("long"))).coalesce(1).write.parquet(f"{base}/in/{name}")
    return spark.readStream.schema(schema).parquet(f"{base}/in/*")


def test_zone_state_after_an_idle_timer(spark):
    """A timer empties an idle key; later rows go on from its carry, earlier ones are expired."""
    import time
    from tributary.streaming.ingest import parquet_sink
    from tributary.streaming.zone_state import stream_zone_speed
    base = f"{checkpoint_dir(spark)}/zi_{uuid.uuid4().hex}"

    def run():
        parquet_sink(stream_zone_speed(stream, idle_ms=1), f"{base}/out", f"{base}/ck", output_mode="update").awaitTermination()
    stream = _feed(spark, base, [(1, 100.0, True), (2, 101.0, True)], "a")
    run()
    time.sleep(0.1)
    _feed(spark, base, [(9, 50.0, True)], "b")            # another key's batch, in which the timer is due
    run()
    time.sleep(0.1)
    _feed(spark, base, [(3, 102.0, False), (8, 60.0, False)], "c")
    run()
    got = {r.event_id: r for r in spark.read.parquet(f"{base}/out").collect()}
    assert [k for k, r in got.items() if r.expired] == [8] and len(got) == 5
    assert got[3].exit and got[3].exit_speed == 18.0      # 10 m in 2 s: the entry came before the timer


class _State(dict):
    """A processor's handle and states, in memory; counts what a state server would answer."""

    def __init__(self):
        super().__init__()
        self.calls = 0

    def getMapState(self, name, *_):
        return self.setdefault(name, _State())

    getValueState = getMapState

    def getValue(self, key):
        self.calls += 1
        return super().get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        self.pop(key, None)

    def get(self):
        self.calls += 1
        return super().get("value")

    def update(self, value):
        self.calls += 1
        self["value"] = value


def _machine(rows):
    """One key's rows in time order, row by row."""
    out, last, was, entered, held = {}, None, False, None, 0.0
    for t, i, inside, length in rows:
        new = last is None or t - last > 10.0
        pit = was and not new
        entry, leave = inside and not pit, not inside and pit
        if new:
            entered, held = None, 0.0
        if entry:
            entered = t
        if leave:
            held = round(length / (t - entered) * 3.6, 1) if 0.1 < t - entered < 10.0 else 0.0
        out[i] = (new, entry, leave, held if leave else None, 0.0 if inside else held)
        last, was = t, inside
    return out


def test_zone_state_takes_many_keys_a_call(spark):
    """A call holds hundreds of keys (null ones too), in any order and twice; what it asks
    of the state follows the time buckets, not the keys."""
    import numpy as np
    import pandas as pd
    from tributary.streaming import zone_state as Z
    rng = np.random.default_rng(5)
    keys = [(o, z) for o in [None, *range(1 << 60, (1 << 60) + 150)] for z in (None, "a", "b")]
    rows = pd.DataFrame([(*keys[rng.integers(len(keys))], i, float(rng.integers(0, 3200)) / 4, bool(rng.random() < 0.5), 20.0) for i in range(9000)],
                        columns=["object_id", "zone_name", "event_id", "t", "inside", "length_m"])
    rows["no_object"] = rows["object_id"].isna()
    rows["object_id"] = [0 if n else int(o) for o, n in zip(rows["object_id"], rows["no_object"])]
    rows["ts"] = pd.to_datetime((rows["t"] * 1e9).astype("int64"))
    for frames in (1, 4):
        state, got = _State(), {}
        p = Z.ZoneProcessor(10.0, 0.1, 10.0, 1e9, None, 300.0)
        p.init(state)
        for part in (rows[rows.t > 400], rows[rows.t < 500], rows[rows.t > 700]):
            Z.PENDING, before = (1_000_000 if frames == 1 else 1000), Z.PENDING
            chunks = [part.iloc[i::frames] for i in range(frames)]
            for f in p.handleInputRows((0,), iter(chunks), None):
                for r in f.itertuples():
                    got[r.event_id] = (bool(r.new_track), bool(r.entry), bool(r.exit), None if r.exit_speed != r.exit_speed else r.exit_speed, r.speed_kmh)
                    o, z = rows.loc[r.event_id, ["object_id", "zone_name"]]
                    assert (pd.isna(r.object_id) and rows.no_object[r.event_id]) or int(r.object_id) == o
                    assert r.zone_name == z or (z is None and r.zone_name is None)
            Z.PENDING = before
        want = {}
        for _, g in rows.assign(z=rows.zone_name.fillna("?")).sort_values(["t", "event_id"]).groupby(["object_id", "no_object", "z"]):
            want |= _machine(list(g[["t", "event_id", "inside", "length_m"]].itertuples(index=False, name=None)))
        assert got == want
        assert state["buckets"].calls + state["head"].calls < (40 if frames == 1 else 120)


def test_zone_state_of_a_slot_expires_key_by_key(spark):
    """Each key's buffer ends by its own newest row; rows of other keys in the same bucket stay."""
    import pandas as pd
    from tributary.streaming import zone_state as Z
    state = _State()
    p = Z.ZoneProcessor(10.0, 0.1, 10.0, 60.0, None, 30.0)
    p.init(state)

    def feed(*rows):
        f = pd.DataFrame([(o, False, "z", i, t, a, 10.0) for o, i, t, a in rows],
                         columns=["object_id", "no_object", "zone_name", "event_id", "t", "inside", "length_m"])
        f["ts"] = pd.to_datetime((f["t"] * 1e9).astype("int64"))
        return [(r.event_id, r.expired, r.entry, r.exit_speed) for out in p.handleInputRows((0,), iter([f]), None) for r in out.itertuples()]
    feed((1, 10, 0.0, True), (1, 11, 28.0, True), (2, 20, 1.0, True))
    feed((1, 12, 100.0, False))                           # key 1 forgets the bucket 0-30
    assert [r[:2] for r in feed((1, 13, 5.0, True))] == [(13, True)]
    late = feed((2, 21, 3.0, False))                      # key 2 does not
    assert [(r[0], r[1], r[3]) for r in late] == [(21, False, 18.0)]


def test_topic_files_are_packed_and_read_alike(spark):
    from tributary.streaming.ingest import keyed_json, write_topic
    base = f"{checkpoint_dir(spark)}/tp_{uuid.uuid4().hex}"
    df = spark.range(20000).select("id", F.concat(F.lit("line\n"), F.col("id").cast("string")).alias("text"))
    recs = keyed_json(df, "id")
    write_topic(recs, f"{base}/topic")
    read = spark.read.text(f"{base}/topic")
    assert read.exceptAll(recs.select("value")).isEmpty() and read.count() == 20000
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/topic")
    size = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(fs_path).getLength()
    assert size < recs.select(F.sum(F.length("value"))).first()[0] / 3
