"""Load and materialisation operators.

Plain parquet has no MERGE; the keyed operators are written as joins that
produce the complete new table content, which ``materialize`` writes to a
fresh folder before swapping it in (a job never reads and overwrites one
path).  Every join here is on the table key, unique on each side after
``dedupe``, so no key can fan out or gather a skewed group.
"""

from __future__ import annotations

import re as _re
import uuid as _uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.keyed_table import KeyedTable
from tributary.operators.windows import keep_first

__all__ = ["rows_above_watermark", "append_above_watermark", "upsert", "delete_insert",
           "replace_partitions", "materialize", "recover_swap", "create_if_missing", "Source", "load_sources"]


def rows_above_watermark(target: DataFrame, new: DataFrame, col: str) -> DataFrame:
    """Rows of ``new`` strictly after ``max(col)`` of the target.

    The maximum is a scalar subquery (one value).  An empty target has a
    null maximum; the reference then loads nothing forever, here it takes
    all rows."""
    mx = target.agg(F.max(col)).scalar()
    return new.filter(mx.isNull() | (F.col(col) > mx))


def append_above_watermark(target: DataFrame, new: DataFrame, col: str) -> DataFrame:
    return target.unionByName(rows_above_watermark(target, new, col))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str],
           update_cols: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """K2/K3: insert new keys; for existing keys set ``update_cols`` (by
    default the non-key columns that ``updates`` has) to the incoming values, keep the others.

    ``updates`` is first reduced to one row per key (first in ``order``;
    any one row when no order is given), as the reference's loader does
    before its INSERT ... ON CONFLICT - a key twice in one load would
    otherwise update a row twice."""
    non_keys = [c for c in target.columns if c not in keys]
    update_cols = [c for c in non_keys if c in updates.columns] if update_cols is None else list(update_cols)
    if order:
        updates = keep_first(updates, keys, order)
    else:
        updates = updates.dropDuplicates(keys)
    new = updates.select(*keys, *[c for c in updates.columns if c in non_keys]) \
        .withColumn("__new", F.lit(True))
    old = target.withColumn("__old", F.lit(True))
    n = new.alias("n")
    o = old.alias("o")
    cond = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    j = o.join(n, on=cond, how="full_outer")
    has_new = F.col("n.__new").isNotNull()
    has_old = F.col("o.__old").isNotNull()
    out = [F.when(has_old, F.col(f"o.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in keys]
    for c in non_keys:
        new_v = F.col(f"n.{c}") if c in updates.columns else F.lit(None)
        if c in update_cols:
            out.append(F.when(has_new, new_v).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.when(has_old, F.col(f"o.{c}")).otherwise(new_v).alias(c))
    return j.select(*out)


def delete_insert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """K4: drop target rows whose key comes again, then add the new rows."""
    kept = target.join(new.select(*keys).distinct(), on=keys, how="left_anti")
    return kept.unionByName(new.select(*target.columns))


def replace_partitions(spark: SparkSession, new: DataFrame, path: str, keys: list[str],
                       partition_col: str) -> list[str]:
    """K4 for a table partitioned by ``partition_col`` (date-led keys):
    only the partitions that ``new`` touches are read (partition pruning
    through a semi join), rebuilt as ``target minus new keys, plus new``,
    written to a staging folder and swapped in partition by partition.
    Untouched partitions are neither read nor rewritten.  Returns the
    replaced partition folder names."""
    jvm = spark._jvm
    recover_swap(spark, path)
    touched = new.select(partition_col).distinct()
    cur = spark.read.parquet(path)
    old = cur.join(touched, on=partition_col, how="left_semi")
    content = delete_insert(old, new.select(*cur.columns), keys)
    stage = f"{path.rstrip('/')}.__stage_{_uuid.uuid4().hex}"
    content.write.partitionBy(partition_col).parquet(stage)
    fs, root = _fs(spark, path)
    _, sroot = _fs(spark, stage)
    done = []
    for st in fs.listStatus(sroot):
        name = st.getPath().getName()
        if not st.isDirectory() or not name.startswith(f"{partition_col}="):
            continue
        target = jvm.org.apache.hadoop.fs.Path(root, name)
        trash = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old_{_uuid.uuid4().hex}_{name}")
        if fs.exists(target):
            _rename(fs, target, trash)
        _rename(fs, st.getPath(), target)
        if fs.exists(trash):
            fs.delete(trash, True)
        done.append(name)
    fs.delete(sroot, True)
    return done


def _rename(fs, src, dst) -> None:
    if not fs.rename(src, dst):
        raise OSError(f"rename failed: {src} -> {dst}")


def recover_swap(spark: SparkSession, path: str) -> list[str]:
    """Put back what a swap stopped between its two renames had moved aside.

    A swap renames the old table (or one partition folder) to
    ``{path}.__old_<id>[_<partition>]`` and then the new one into its place.
    Where that place is empty the old content returns; where it is filled the
    swap was complete and the leftover is deleted.  One writer per table is
    assumed.  Returns the restored names ("" for the whole table)."""
    fs, root = _fs(spark, path)
    hp = spark._jvm.org.apache.hadoop.fs.Path
    restored = []
    for st in fs.globStatus(hp(f"{path.rstrip('/')}.__old_*")) or []:
        m = _re.search(r"\.__old_[0-9a-f]{32}(?:_(.+))?$", st.getPath().getName())
        if not m:
            continue
        target = hp(root, m.group(1)) if m.group(1) else root
        if fs.exists(target):
            fs.delete(st.getPath(), True)
        else:
            _rename(fs, st.getPath(), target)
            restored.append(m.group(1) or "")
    return restored


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def materialize(spark: SparkSession, df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, sort_within: list[str] | None = None) -> str:
    """K5 and the write half of K1-K4.

    ``overwrite`` writes the full new content to a sibling staging folder,
    then swaps it in by rename, so a reader of ``path`` never sees a half
    table and the job may read ``path`` in ``df``.  ``append`` adds files.
    A writer that stops between the two renames leaves no table at ``path``;
    every load here first calls ``recover_swap``, which puts it back.
    """
    recover_swap(spark, path)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode("overwrite" if mode == "overwrite" else "append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if mode != "overwrite":
        w.parquet(path)
        return path
    stage = f"{path.rstrip('/')}.__stage_{_uuid.uuid4().hex}"
    w.parquet(stage)
    fs, p = _fs(spark, path)
    _, s = _fs(spark, stage)
    old = None
    if fs.exists(p):
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old_{_uuid.uuid4().hex}")
        _rename(fs, p, old)
    _rename(fs, s, p)
    if old is not None:
        fs.delete(old, True)
    return path


def create_if_missing(spark: SparkSession, path: str, schema) -> DataFrame:
    """An empty table of ``schema`` when ``path`` holds no data yet;
    an existing table is left as it is, one whose swap was cut off comes back."""
    recover_swap(spark, path)
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass
class Source:
    """K6: how to read a source, the keys of its table, and which of one
    key's rows counts."""
    read: Callable[[], DataFrame]
    keys: list[str]
    order: list[str] | None = None


def load_sources(spark: SparkSession, sources: dict[str, Source], base: str, number: int, at_once: int = 8) -> DataFrame:
    """K6: load every source into the keyed table ``base/<name>``, created when
    missing; rows of a repeated key are reduced first.  Loads run at the same
    time and each is committed by its own manifest, so a source that fails
    leaves its table and the others as they are.  A load that has been committed
    under ``number`` is not applied again.  Returns (source, rows, version,
    error): rows of each table as its manifest names them."""
    def one(name: str) -> tuple[str, int | None, int, str | None]:
        s = sources[name]
        t = KeyedTable(spark, f"{base.rstrip('/')}/{name}", s.keys)
        try:
            t.upsert(s.read(), order=s.order, load=("load", number))
            return name, t.read().count(), t.version(), None
        except Exception as e:  # noqa: BLE001 - the failure is the reported value
            return name, None, t.version(), f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(one, sorted(sources)))
    return spark.createDataFrame(rows, "source string, rows long, version long, error string")
