"""Stream sources, parsing, watermarks, sinks.

A broker stream is any streaming frame with a ``value`` column: the Kafka
source when its package is on the classpath, a file stream in tests.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tributary.operators.keyed_table import Conflict, KeyedTable
from tributary.operators.load import _fs
from tributary.operators.windows import keep_first

__all__ = ["file_stream", "kafka_stream", "parse_json_values", "keyed_json", "write_topic", "with_event_watermark",
           "parquet_sink", "upsert_sink", "dedup_sink", "write_key_index", "loads_that_may_hold", "kafka_sink", "jdbc_append_sink", "dedup_within_watermark"]

LOAD_ID = "load_id"


def file_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over ``{folder}/{name}.{fmt}``; a one-character class
    in the pattern makes the file source accept a single file."""
    pattern = f"{folder.rstrip('/')}/{name[:-1]}[{name[-1]}].{fmt}"
    if schema is None:
        schema = spark.read.format(fmt).load(f"{folder.rstrip('/')}/{name}.{fmt}").schema
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(pattern)


def kafka_stream(spark: SparkSession, servers: str, topic: str, fail_on_data_loss: bool = True) -> DataFrame:
    """A5 source: subscribe from the earliest offsets (needs the Kafka
    package on the classpath)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest")
            .option("failOnDataLoss", str(fail_on_data_loss).lower()).load())


# Timestamps travel as ISO text with microseconds and offset.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def parse_json_values(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Value text -> typed columns; undeclared fields are dropped,
    a value that is not JSON gives all-null columns."""
    return df.select(F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS).alias("data")).select("data.*")


def keyed_json(df: DataFrame, id_col: str) -> DataFrame:
    """(key = id as text, value = the row as JSON)."""
    return df.select(F.col(id_col).cast("string").alias("key"),
                     F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


# Records of a file of a topic: packed text is read by one task a file.
TOPIC_FILE_RECORDS = 500_000


def write_topic(records: DataFrame, path: str) -> None:
    """A6 to files, a topic's stand-in: the ``value`` texts a line each, packed
    (JSON repeats its field names in every record); text streams read them as they are."""
    records.select("value").write.option("compression", "gzip").option("maxRecordsPerFile", TOPIC_FILE_RECORDS).text(path)


def with_event_watermark(df: DataFrame, ts_col: str, delay: str = "2 minutes") -> DataFrame:
    """Watermark on an event-time column (a TIMESTAMP_NTZ is cast to
    TIMESTAMP first; the watermark refuses NTZ)."""
    t = df.schema[ts_col].dataType
    if isinstance(t, T.TimestampNTZType):
        df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df.withWatermark(ts_col, delay)


def parquet_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 query_name: str | None = None, output_mode: str = "append") -> StreamingQuery:
    """Append parquet files with a checkpoint folder.  ``update`` is for
    streams that send a row again when its result changes: each micro-batch has
    a folder of its own, written anew if the batch is replayed."""
    if output_mode == "update":
        def write(batch: DataFrame, epoch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{LOAD_ID}={_load_id(checkpoint, epoch_id)}")
        w = df.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    else:
        w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if not available_now:
        return w.start() if output_mode == "update" else w.start(path)
    # With processing-time timers a batch without data would follow another for ever.
    conf, key = df.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(key)
    if output_mode == "update":
        conf.set(key, "false")
    try:
        w = w.trigger(availableNow=True)
        return w.start() if output_mode == "update" else w.start(path)
    finally:
        conf.set(key, before)


def upsert_sink(df: DataFrame, path: str, keys: list[str], checkpoint: str, order: list[str] | None = None,
                available_now: bool = True, buckets: int = 16, compact_every: int = 16) -> StreamingQuery:
    """Per micro-batch, skip an empty batch, otherwise upsert the
    batch into the keyed table at ``path`` (``KeyedTable.read`` reads it).  A
    batch writes its own rows only; after ``compact_every`` batches the touched
    buckets are written anew.  A batch committed already is not applied again,
    and a failed write raises (the reference logs and loses it).

    Of one key's rows in a batch the first in ``order`` counts, by default in
    the order of the other columns, so that a repeated batch picks the same.
    Rows with a null key (records that are not JSON) cannot be merged by it;
    they go to ``{path}__rejects``, in a folder of their own per batch."""
    order = order or [f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))]

    def write(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        rejects = batch.filter(no_key)
        if not rejects.isEmpty():
            rejects.write.mode("overwrite").parquet(f"{path.rstrip('/')}__rejects/{LOAD_ID}={_load_id(checkpoint, epoch_id)}")
        t = KeyedTable(batch.sparkSession, path, keys, buckets)
        t.upsert(batch.filter(~no_key), order=order, load=(_writer(checkpoint), epoch_id))
        try:
            t.compact(compact_every)
        except Conflict:        # another writer was faster; the next batch tries again
            pass

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def _writer(checkpoint: str) -> str:
    """Names one query."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def _load_id(checkpoint: str, epoch_id: int) -> str:
    """Names one micro-batch of one query, the same when it is replayed."""
    return f"{_writer(checkpoint)}_{epoch_id}"


# Keys that a block of a load's membership index holds on average, and bits
# set for a key: about one key in 400 seems to be in a load that lacks it.
INDEX_KEYS, INDEX_HASHES, INDEX_BITS = 2600, 4, 32768


def _index_places(rows: DataFrame, keys: list[str], blocks) -> DataFrame:
    """(blocks, block, pos): the bits of each key in an index of ``blocks``
    (a Column) blocks; the bits of one key lie in one block."""
    h = F.xxhash64(*keys)
    spots = F.array(*[F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(INDEX_BITS)) for i in range(INDEX_HASHES)])
    return rows.select(blocks.alias("blocks"), F.pmod(h, blocks).alias("block"), spots.alias("spots"))


def write_key_index(rows: DataFrame, keys: list[str], path: str, load: str) -> str:
    """A blocked Bloom filter of the keys of one load as a table (blocks,
    block, bits) in the folder ``{path}__index/load_id=...``: about 13 bits a key.
    Built by Spark a block a group; no filter goes through the driver."""
    n = rows.count()
    blocks = 1
    while blocks * INDEX_KEYS < n:
        blocks *= 2
    places = _index_places(rows, keys, F.lit(blocks)).select("blocks", "block", F.explode("spots").alias("pos")).distinct()
    bits = places.groupBy("blocks", "block").agg(F.bitmap_construct_agg("pos").alias("bits"))
    folder = f"{path.rstrip('/')}__index/{LOAD_ID}={load}"
    bits.write.mode("overwrite").parquet(folder)
    return folder


def loads_that_may_hold(rows: DataFrame, keys: list[str], path: str) -> list[str]:
    """The loads of the table at ``path`` that may hold a key of ``rows`` (all that do,
    seldom another one): the driver gets their names.  Keys and index blocks meet
    in a join on the block, keys of one block as a set of bit places."""
    spark, index = rows.sparkSession, f"{path.rstrip('/')}__index"
    fs, p = _fs(spark, index)
    if not fs.exists(p):
        return []
    table = spark.read.schema("blocks long, block long, bits binary").option("basePath", index).parquet(index) \
        .withColumn(LOAD_ID, F.regexp_extract(F.col("_metadata.file_path"), f"/{LOAD_ID}=([^/]+)/", 1))
    sizes = [r.blocks for r in table.select("blocks").distinct().collect()]  # powers of two: few
    each = rows.select(*keys).withColumn("__blocks", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])))
    asked = _index_places(each, keys, F.col("__blocks")).distinct()
    byte = lambda pos: F.conv(F.hex(F.substring(F.col("bits"), (pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.forall("spots", lambda pos: (byte(pos).bitwiseAND(F.pow(F.lit(2), pos % 8).cast("int"))) != 0)
    hit = table.join(asked, ["blocks", "block"]).filter(held).select(LOAD_ID).distinct()
    return sorted(r[0] for r in hit.collect())


def _indexed(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Loads of the table, and those of them that have no complete index."""
    def below(folder: str, complete: bool) -> list[str]:
        fs, p = _fs(spark, folder)
        found = [st.getPath() for st in fs.listStatus(p)] if fs.exists(p) else []
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path
        return [q.getName()[len(LOAD_ID) + 1:] for q in found if q.getName().startswith(f"{LOAD_ID}=")
                and (not complete or fs.exists(jvm_path(q, "_SUCCESS")))]
    loads, known = below(path, False), set(below(f"{path.rstrip('/')}__index", True))
    return loads, [x for x in loads if x not in known]


def dedup_sink(df: DataFrame, path: str, keys: list[str], checkpoint: str, order: list[str] | None = None,
               available_now: bool = True) -> StreamingQuery:
    """Append each key's first arriving copy and drop the later ones, however late a row is.

    Per micro-batch: one row per key (first in ``order``), less the keys the
    table holds, written to the batch's own folder ``load_id=...``.  Each load has
    a membership index beside the table (``write_key_index``); a batch reads the
    key columns of those loads only that may hold one of its keys, and of loads
    without an index (a writer that stopped in between).  Nothing is rewritten,
    no state outgrows memory and no watermark drops rows.  A replayed batch
    ignores and overwrites its own folder, so it is repeat-safe.  Null keys count
    as a key."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        load = _load_id(checkpoint, epoch_id)
        new = keep_first(batch, keys, order) if order else batch.dropDuplicates(keys)
        loads, unknown = _indexed(spark, path)
        may = set(loads_that_may_hold(new, keys, path)) | set(unknown)
        ask = [x for x in loads if x in may and x != load]
        if ask:
            seen = spark.read.schema(batch.schema).parquet(*[f"{path.rstrip('/')}/{LOAD_ID}={x}" for x in ask]).select(*keys)
            cond = [F.col(f"n.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
            new = new.alias("n").join(seen.alias("s"), on=cond, how="left_anti")
        target = f"{path.rstrip('/')}/{LOAD_ID}={load}"
        new.write.mode("overwrite").parquet(target)
        write_key_index(spark.read.schema(batch.schema).parquet(target), keys, path, load)

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def kafka_sink(df: DataFrame, servers: str, topic: str, id_col: str, checkpoint: str) -> StreamingQuery:
    """A6 to a broker: keyed JSON records written with the Kafka sink
    (needs the Kafka package on the classpath; not available here)."""
    return (keyed_json(df, id_col).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def jdbc_append_sink(df: DataFrame, url: str, table: str, properties: dict, checkpoint: str,
                     available_now: bool = False) -> StreamingQuery:
    """A8 with a JDBC target: per micro-batch, skip an empty batch, else
    append; a failed write raises so the batch is retried, not lost
    (needs the database's JDBC driver; no database is reachable here)."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        batch.write.jdbc(url=url, table=table, mode="append", properties=properties)

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def dedup_within_watermark(df: DataFrame, keys: list[str], ts_col: str, delay: str = "2 minutes") -> DataFrame:
    """Drop rows whose key was seen within the watermark delay.  State is
    bounded by the watermark, at a price: every row older than the watermark
    is dropped, first copies too.  ``dedup_sink`` keeps those."""
    return with_event_watermark(df, ts_col, delay).dropDuplicatesWithinWatermark(keys)
