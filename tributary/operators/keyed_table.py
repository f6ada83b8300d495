"""Tables that change by small commits.

A table is a folder of immutable parquet folders and a list of numbered
manifests (``_versions/<n>.json``); the highest one says which folders make up
the table.  A commit writes its folder first and then puts manifest n + 1 in
place without overwriting: if another writer was there first, that fails, and
the commit is based on the new manifest and tried again, or refused where the
caller named the version it expects.  So a reader sees one version, old or new,
two writers lose no rows, and a writer that stops leaves an unnamed folder only.

Rows are dealt to ``buckets`` by a hash of the keys.  An upsert writes its own
rows as a delta folder: bytes written grow with the batch, not with the table.
A read takes buckets without a delta as they are; in the others the deltas,
reduced to one row a key, are joined to the base, where Spark broadcasts the
deltas if they are small.  ``compact`` writes those buckets anew.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.windows import keep_first

__all__ = ["Conflict", "KeyedTable"]

BUCKET, GONE, SEQ = "__bucket", "__gone", "__seq"


class Conflict(RuntimeError):
    """Another writer committed since the version that the caller expects."""


class KeyedTable:
    """The table at ``path``.  ``keys`` and ``buckets`` are fixed by the first
    commit; without keys rows are only appended or replaced."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, buckets: int = 16):
        self.spark, self.path, self._keys, self._buckets = spark, path.rstrip("/"), list(keys or []), buckets
        self._hp = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hp(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # Manifests.

    def version(self) -> int:
        """The highest committed version, 0 for no table yet."""
        folder = self._hp(f"{self.path}/_versions")
        if not self._fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "keys": self._keys, "buckets": self._buckets, "folders": [], "loads": {}}
        stream = self._fs.open(self._hp(f"{self.path}/_versions/{version:020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _put(self, manifest: dict) -> bool:
        """Put the manifest in place if nobody has put one of its number."""
        folder, name = f"{self.path}/_versions", f"{manifest['version']:020d}.json"
        self._fs.mkdirs(self._hp(folder))
        tmp, final = self._hp(f"{folder}/.{uuid.uuid4().hex}"), self._hp(f"{folder}/{name}")
        out = self._fs.create(tmp, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        tmp, final = self._fs.makeQualified(tmp), self._fs.makeQualified(final)
        try:
            if final.toUri().getScheme() == "file":     # a local rename would overwrite
                try:
                    os.link(tmp.toUri().getPath(), final.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            jvm = self.spark._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
            none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            try:
                context.rename(tmp, final, none)
            except Exception as e:  # noqa: BLE001 - py4j wraps what the store raises
                if "FileAlreadyExists" in str(e):
                    return False
                raise
            return True
        finally:
            if self._fs.exists(tmp):
                self._fs.delete(tmp, False)

    def _commit(self, change: Callable[[dict], dict | None], expected: int | None = None) -> int:
        """Apply ``change`` to the latest manifest until it could be put."""
        while True:
            before = self.manifest()
            if expected is not None and before["version"] != expected:
                raise Conflict(f"{self.path} is at version {before['version']}, expected {expected}")
            after = change(json.loads(json.dumps(before)))
            if after is None:
                return before["version"]
            after["version"] = before["version"] + 1
            if self._put(after):
                return after["version"]

    # Folders.

    def _write(self, df: DataFrame, manifest: dict) -> dict:
        """Write rows as a new folder, by bucket; its manifest entry."""
        keys, name = manifest["keys"], f"data-{uuid.uuid4().hex}"
        if keys:
            df = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(manifest["buckets"])).cast("int")).repartition(BUCKET)
            df.write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        else:
            df.write.parquet(f"{self.path}/{name}")
        parts = [f.getPath().getName() for f in self._fs.listStatus(self._hp(f"{self.path}/{name}"))]
        return {"name": name, "live": sorted(int(p.split("=")[1]) for p in parts if p.startswith(f"{BUCKET}="))}

    def _folder(self, entry: dict, schema: T.StructType, buckets: set[int] | None = None) -> DataFrame:
        if not entry["live"] and entry.get("keyed"):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(T.StructType([*schema.fields, *([T.StructField(BUCKET, T.IntegerType())] if entry.get("keyed") else [])])) \
            .parquet(f"{self.path}/{entry['name']}")
        if entry.get("keyed"):
            df = df.filter(F.col(BUCKET).isin(sorted(set(entry["live"]) if buckets is None else set(entry["live"]) & buckets))).drop(BUCKET)
        return df

    @staticmethod
    def _fit(manifest: dict, schema: T.StructType) -> dict:
        """The first commit names the columns; later ones have no others."""
        if manifest["schema"] is None:
            return {**manifest, "schema": schema.jsonValue()}
        unknown = set(schema.names) - {f["name"] for f in manifest["schema"]["fields"]}
        if unknown:
            raise ValueError(f"columns that the table lacks: {sorted(unknown)}")
        return manifest

    # Changes.

    def replace(self, df: DataFrame, expected: int | None = None) -> int:
        """K5: the rows of ``df`` become the table; with ``expected`` only if
        that is still its version.  Keys, where there are any, must be unique."""
        first = self.manifest()
        entry = {**self._write(df, first), "kind": "base", "seq": 0, "keyed": bool(first["keys"])}
        return self._commit(lambda m: {**m, "schema": df.schema.jsonValue(), "folders": [entry]}, expected)

    def append(self, df: DataFrame) -> int:
        """Add rows to a table without keys."""
        first = self.manifest()
        if first["keys"]:
            raise ValueError("a table with keys is changed by upsert")
        entry = {**self._write(df, first), "kind": "base", "seq": 0, "keyed": False}
        return self._commit(lambda m: {**self._fit(m, df.schema), "folders": [*m["folders"], entry]})

    def upsert(self, df: DataFrame, order: list[str] | None = None, update_cols: list[str] | None = None,
               load: tuple[str, int] | None = None, deleted: DataFrame | None = None) -> int:
        """K2/K3: new keys are added; for known ones ``update_cols`` (all given
        columns but the keys) take the new values and the others stay.  Of one
        key's rows the first in ``order`` counts.  Keys of ``deleted`` go first.
        ``load`` = (writer, number): a load with a number that the writer has
        committed already does nothing, so a repeated load is safe."""
        first = self.manifest()
        keys = first["keys"]
        if load and first["loads"].get(load[0], -1) >= load[1]:
            return first["version"]
        rows = (keep_first(df, keys, order) if order else df.dropDuplicates(keys)).withColumn(GONE, F.lit(False))
        entries = []
        if deleted is not None:
            gone = deleted.select(*keys).distinct().withColumn(GONE, F.lit(True))
            entries.append({**self._write(gone, first), "kind": "delta", "keyed": True, "given": [], "sets": [], "gone": True})
        given = [c for c in df.columns if c not in keys]
        entries.append({**self._write(rows, first), "kind": "delta", "keyed": True, "given": given,
                        "sets": given if update_cols is None else list(update_cols), "gone": False})

        def change(m: dict) -> dict | None:
            if load and m["loads"].get(load[0], -1) >= load[1]:
                return None
            m = self._fit(m, df.schema)
            last = max((f["seq"] for f in m["folders"]), default=0)
            m["folders"] += [{**e, "seq": last + 1 + i} for i, e in enumerate(entries)]
            if load:
                m["loads"][load[0]] = load[1]
            return m
        return self._commit(change)

    def compact(self, at_least: int = 1) -> int:
        """Write the buckets that have deltas anew, if there are ``at_least``
        deltas; refused (the table stays as it is) if somebody else commits
        meanwhile."""
        m = self.manifest()
        deltas = [f for f in m["folders"] if f["kind"] == "delta"]
        if len(deltas) < at_least:
            return m["version"]
        touched = {b for f in deltas for b in f["live"]}
        entry = {**self._write(self._merged(m, touched), m), "kind": "base", "seq": 0, "keyed": True}
        kept = [{**f, "live": sorted(set(f["live"]) - touched)} for f in m["folders"] if f["kind"] == "base"]
        return self._commit(lambda x: {**x, "folders": [f for f in kept if f["live"]] + [entry]}, m["version"])

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what none of the last ``keep`` versions names (no writer may
        be at work).  Returns the deleted folders."""
        now = self.version()
        named = {f["name"] for v in range(max(1, now - keep + 1), now + 1) for f in self.manifest(v)["folders"]}
        for v in range(1, max(1, now - keep + 1)):
            self._fs.delete(self._hp(f"{self.path}/_versions/{v:020d}.json"), False)
        found = [f.getPath().getName() for f in self._fs.listStatus(self._hp(self.path))]
        gone = [n for n in found if n.startswith("data-") and n not in named]
        for n in gone:
            self._fs.delete(self._hp(f"{self.path}/{n}"), True)
        return gone

    # Reads.

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the latest (or the given) version."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"no table at {self.path}")
        schema = T.StructType.fromJson(m["schema"])
        deltas = [f for f in m["folders"] if f["kind"] == "delta"]
        touched = {b for f in deltas for b in f["live"]}
        parts = [self._folder(f, schema, set(range(m["buckets"])) - touched if f["keyed"] else None) for f in m["folders"] if f["kind"] == "base"]
        if deltas:
            parts.append(self._merged(m, touched))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _merged(self, m: dict, buckets: set[int]) -> DataFrame:
        schema, keys = T.StructType.fromJson(m["schema"]), m["keys"]
        columns = [c for c in schema.names if c not in keys]
        wide = T.StructType([*schema.fields, T.StructField(GONE, T.BooleanType())])
        deltas = [f for f in m["folders"] if f["kind"] == "delta"]
        rows = reduce(DataFrame.unionAll, [self._folder(f, wide, buckets).withColumn(SEQ, F.lit(f["seq"])) for f in deltas])
        # A key has one row a delta at most, so its list is bounded by their number.
        d = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(SEQ, GONE, *columns))).alias("all"))
        from_ = F.coalesce(F.array_max(F.transform(F.filter("all", lambda x: x[GONE]), lambda x: x[SEQ])), F.lit(-1))
        d = d.withColumn("fresh", from_ >= 0).withColumn("all", F.filter("all", lambda x: x[SEQ] > from_))
        d = d.withColumn("given", F.size("all") > 0).withColumn("__d", F.lit(True))
        bases = [self._folder(f, schema, buckets) for f in m["folders"] if f["kind"] == "base"]
        base = reduce(DataFrame.unionByName, bases) if bases else self.spark.createDataFrame([], schema)
        b, n = base.alias("b"), d.alias("n")
        same = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])

        def value(c: str, known=None):
            """The value of the last delta that sets the column; else the known
            one, or the first delta's where the key is new."""
            number = lambda what: F.array(*[F.lit(f["seq"]) for f in deltas if c in f[what]]).cast("array<int>")
            last = F.filter("n.all", lambda x: F.array_contains(number("sets"), x[SEQ]))
            first = F.filter(F.slice("n.all", 1, 1), lambda x: F.array_contains(number("given"), x[SEQ]))
            first = F.try_element_at(first, F.lit(1))[c]
            new = F.when(F.size(last) > 0, F.try_element_at(last, F.lit(-1))[c])
            return new.otherwise(first) if known is None else new.when(F.col("n.fresh"), first).otherwise(known)

        joined = b.join(n, same, "left")
        old = joined.filter(F.col("n.__d").isNull() | ~F.col("n.fresh") | F.col("n.given")).select(*[
            F.col(f"b.{c}").alias(c) if c in keys else
            F.when(F.col("n.__d").isNull(), F.col(f"b.{c}")).otherwise(value(c, F.col(f"b.{c}"))).alias(c) for c in schema.names])
        new = n.join(b.select(*keys).alias("b"), same, "left_anti").filter("given").select(*[
            F.col(f"n.{c}").alias(c) if c in keys else value(c).alias(c) for c in schema.names])
        return old.unionByName(new)
