"""Keyed tables: versions, deltas, deletes, two writers, bytes written."""

import os
import random
import threading
import uuid

import pytest

from pyspark.sql import functions as F

from tributary.operators.keyed_table import Conflict, KeyedTable
from tributary.operators.load import upsert
from tributary.operators.windows import keep_first
from tributary.session import checkpoint_dir

S = "k long, a string, v double"


def _path(spark):
    return f"{checkpoint_dir(spark)}/kt_{uuid.uuid4().hex}"


def _bytes(path):
    root = path.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))


def test_upserts_equal_the_whole_table_form(spark):
    """A random run of loads against ``load.upsert``, with partial columns,
    compaction in between, null keys and an order."""
    rng = random.Random(4)
    t, plain = KeyedTable(spark, _path(spark), ["k"], buckets=5), spark.createDataFrame([], S)
    for i in range(6):
        rows = [(rng.choice([None, *range(12)]), f"a{i}{j}", float(rng.randrange(99)), j) for j in range(rng.randrange(1, 9))]
        df = spark.createDataFrame(rows, S + ", pos int")
        cols = [None, ["v"], None, ["a"], None, []][i]
        df = df.drop("a") if i == 2 else df
        new = df.drop("pos")
        first = spark.createDataFrame(keep_first(df, ["k"], ["pos"]).drop("pos").collect(), new.schema)
        t.upsert(first, update_cols=cols)
        plain = spark.createDataFrame(upsert(plain, first, ["k"], update_cols=cols).collect(), S)
        assert _rows(t.read()) == _rows(plain), i
        if i == 3:
            t.compact()
            assert _rows(t.read()) == _rows(plain)
    assert _rows(t.read(2)) != _rows(t.read())


def test_deleted_keys_go_and_may_come_again(spark):
    t = KeyedTable(spark, _path(spark), ["k"], buckets=3)
    t.replace(spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, "z", 3.0)], S))
    t.upsert(spark.createDataFrame([(2, "new")], "k long, a string"), deleted=spark.createDataFrame([(1,), (2,)], "k long"))
    assert _rows(t.read()) == [(2, "new", None), (3, "z", 3.0)]
    t.upsert(spark.createDataFrame([(1, 7.0)], "k long, v double"))
    assert _rows(t.read()) == [(1, None, 7.0), (2, "new", None), (3, "z", 3.0)]
    t.compact()
    assert _rows(t.read()) == [(1, None, 7.0), (2, "new", None), (3, "z", 3.0)]
    assert t.vacuum(1) and _rows(t.read())[0] == (1, None, 7.0)


def test_bytes_written_grow_with_the_batch(spark):
    sizes = []
    for n in (2_000, 40_000):
        path = _path(spark)
        t = KeyedTable(spark, path, ["k"], buckets=4)
        t.replace(spark.range(n).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("a"), F.rand(1).alias("v")))
        before = _bytes(path)
        t.upsert(spark.range(50).select((F.col("id") * 31).alias("k"), F.lit("b").alias("a"), F.lit(1.0).alias("v")))
        sizes.append((before, _bytes(path) - before))
        assert t.read().filter("a = 'b'").count() == 50 and t.read().count() == n
    assert sizes[1][0] > 5 * sizes[0][0] and sizes[1][1] < 1.5 * sizes[0][1]


def test_reader_keeps_its_version_and_refresh_checks_its_predecessor(spark):
    t = KeyedTable(spark, _path(spark))
    a, b = spark.range(5).toDF("x"), spark.range(7).toDF("x")
    v1 = t.replace(a)
    seen = t.read()
    v2 = t.replace(b, expected=v1)
    assert seen.count() == 5 and t.read().count() == 7 and t.read(v1).count() == 5
    with pytest.raises(Conflict):
        t.replace(a, expected=v1)
    assert t.version() == v2 and t.read().count() == 7
    t.append(a)
    assert t.read().count() == 12


def test_two_writers_lose_no_rows(spark):
    path, errors = _path(spark), []
    KeyedTable(spark, path, ["k"]).replace(spark.createDataFrame([(0, "x", 0.0)], S))

    def write(who):
        try:
            for i in range(4):
                KeyedTable(spark, path, ["k"]).upsert(spark.createDataFrame([(who * 10 + i, "w", 1.0)], S), load=(f"w{who}", i))
        except Exception as e:  # noqa: BLE001 - shown by the assert
            errors.append(e)
    threads = [threading.Thread(target=write, args=(w,)) for w in (1, 2, 3)]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    t = KeyedTable(spark, path)
    assert not errors and t.version() == 13
    assert {r.k for r in t.read().collect()} == {0, *(w * 10 + i for w in (1, 2, 3) for i in range(4))}
    assert t.upsert(spark.createDataFrame([(99, "again", 1.0)], S), load=("w1", 3)) == 13   # a repeated load does nothing


def test_a_stopped_writer_leaves_the_table(spark):
    t = KeyedTable(spark, _path(spark), ["k"])
    t.replace(spark.createDataFrame([(1, "x", 1.0)], S))
    bad = spark.createDataFrame([(2, "y", 2.0)], S).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        t.upsert(bad)
    assert _rows(t.read()) == [(1, "x", 1.0)] and t.version() == 1
    with pytest.raises(ValueError, match="lacks"):
        t.upsert(spark.createDataFrame([(1, 2)], "k long, other long"))
