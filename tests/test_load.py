"""Keyed loads: upsert, watermark append, delete-insert (2.T, FIXTURES §3)."""

from pyspark.sql import functions as F

from tributary.operators.keyed_table import KeyedTable
from tributary.operators.load import Source, append_above_watermark, delete_insert, load_sources, materialize, upsert

S = "k long, a string, v double"


def test_upsert_twice_equals_once(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], S)
    u = spark.createDataFrame([(2, "Y", 20.0), (3, "z", 3.0)], S)
    once = upsert(t, u, ["k"])
    twice = upsert(once, u, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(tuple(r) for r in once.collect()) == [(1, "x", 1.0), (2, "Y", 20.0), (3, "z", 3.0)]


def test_partial_update_keeps_other_columns(spark):
    t = spark.createDataFrame([(1, "x", 1.0)], S)
    u = spark.createDataFrame([(1, "changed", 5.0)], S)
    r = upsert(t, u, ["k"], update_cols=["v"]).collect()[0]
    assert (r.a, r.v) == ("x", 5.0)


def test_upsert_first_incoming_row_wins(spark):
    t = spark.createDataFrame([], S)
    u = spark.createDataFrame([(1, "first", 1.0, 0), (1, "second", 2.0, 1)], S + ", pos int")
    r = upsert(t, u.drop("pos"), ["k"], order=None)
    assert r.count() == 1  # without an order any one row is kept, never both
    r = upsert(t, u, ["k"], order=["pos"]).collect()
    assert len(r) == 1 and r[0].a == "first"


def test_empty_target_takes_all(spark):
    empty = spark.createDataFrame([], "d date, x int")
    new = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, x int") \
        .withColumn("d", F.to_date("d"))
    assert append_above_watermark(empty, new, "d").count() == 2
    tgt = new.filter("x = 1")
    assert sorted(r.x for r in append_above_watermark(tgt, new, "d").collect()) == [1, 2]


def test_delete_insert_replaces_keys(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)], S)
    n = spark.createDataFrame([(1, "new", 9.0)], S)
    r = sorted(tuple(x) for x in delete_insert(t, n, ["k"]).collect())
    assert r == [(1, "new", 9.0), (2, "c", 3.0)]


def test_materialize_overwrite_reads_own_path(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 1.0)], S)
    materialize(spark, df, p)
    cur = spark.read.parquet(p)
    materialize(spark, upsert(cur, spark.createDataFrame([(2, "b", 2.0)], S), ["k"]), p)
    assert spark.read.parquet(p).count() == 2


def test_audit_stamps_created_on_insert_only(spark):
    t = spark.createDataFrame([(1, 5.0, "2024-01-01 00:00:00", "2024-01-01 00:00:00")],
                              "k long, v double, created_at string, updated_at string")
    u = spark.createDataFrame([(1, 7.0, "2024-02-01 00:00:00", "2024-02-01 00:00:00"),
                               (2, 1.0, "2024-02-01 00:00:00", "2024-02-01 00:00:00")],
                              "k long, v double, created_at string, updated_at string")
    r = {x.k: x for x in upsert(t, u, ["k"], update_cols=["v", "updated_at"]).collect()}
    assert (r[1].v, r[1].created_at, r[1].updated_at) == (7.0, "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    assert r[2].created_at == "2024-02-01 00:00:00"


def test_road_marts_repeat_safe(spark, tmp_path):
    from tributary.plans import road
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stg = road.staging(road.detections_from_events(ev))
    for _ in range(2):
        paths = road.refresh_marts(spark, stg, str(tmp_path / "marts"))
    traffic = KeyedTable(spark, paths["traffic"]).read()
    assert traffic.count() == stg.count() == traffic.select("uuid").distinct().count()
    assert KeyedTable(spark, paths["objects"]).read().count() == road.traffic_objects(stg).count()


def test_sources_load_on_their_own(spark, tmp_path):
    """A failing source is reported and stops none; its table stays; a repeat
    changes nothing, the next load does."""
    base, state = str(tmp_path / "tables"), {"broken": False}

    def read(n):
        if state["broken"]:
            raise OSError("no file")
        return spark.createDataFrame([(i % 3, f"r{i}", float(i)) for i in range(n)], S)
    sources = {"a": Source(lambda: read(5), ["k"], ["v"]), "b": Source(lambda: spark.createDataFrame([(1, "x", 1.0)], S), ["k"])}
    run = lambda number: {r.source: (r.rows, r.version, r.error) for r in load_sources(spark, sources, base, number).collect()}
    assert run(1) == {"a": (3, 1, None), "b": (1, 1, None)} == run(1)
    state["broken"] = True
    rep = run(2)
    assert rep["a"] == (None, 1, "OSError: no file") and rep["b"] == (1, 2, None)
    assert sorted(r.a for r in KeyedTable(spark, f"{base}/a").read().collect()) == ["r0", "r1", "r2"]   # first in order
