"""Readers (A1-A4, A13)."""

from __future__ import annotations

import csv
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["normalize_header", "read_platform_csvs", "read_typed_csv", "read_with_file_value", "read_columns"]


def normalize_header(name: str) -> str:
    """A2: ``Total users`` -> ``total_users``."""
    return re.sub(r"\s+", "_", name.strip().lower())


def _files(spark: SparkSession, pattern: str) -> list[str]:
    """Data files of a glob; a folder in it stands for the files below."""
    hp = spark._jvm.org.apache.hadoop.fs.Path
    fs = hp(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for st in fs.globStatus(hp(pattern)) or []:
        below = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
        out += [s.getPath().toString() for s in below
                if s.isFile() and s.getLen() > 0 and not s.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def _by_header(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their normalised header line (one small read each)."""
    jvm = spark._jvm
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        p = jvm.org.apache.hadoop.fs.Path(f)
        stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
        try:
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
        finally:
            stream.close()
        header = tuple(normalize_header(c) for c in next(csv.reader([line.lstrip("\ufeff")]), []))
        groups.setdefault(header, []).append(f)
    return groups


def _cell(name: str, dtype: T.DataType):
    """A text cell in its declared type.  ``377.0`` is a whole number; any other
    number that does not fit ends the job rather than become null.  Blank
    cells are null, and so are dates that do not parse."""
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return F.try_to_date(c)
    v = c.try_cast(dtype)
    if isinstance(dtype, T.IntegralType):
        d = c.try_cast("decimal(38,6)")
        v = F.coalesce(v, F.when(d == F.floor(d), d).try_cast(dtype))
    if isinstance(dtype, T.StringType):
        return v
    bad = F.raise_error(F.concat(F.lit(f"column {name}: not a {dtype.simpleString()}: "), c)).cast(dtype)
    return F.when(F.trim(c) == "", F.lit(None).cast(dtype)).when(v.isNull() & c.isNotNull(), bad).otherwise(v)


def read_platform_csvs(spark: SparkSession, base: str, platform: str, schema: T.StructType) -> DataFrame | None:
    """A1/A2: every ``{base}/{platform}/{platform}_fake_data_*.csv`` stacked;
    headers normalised and matched to ``schema`` by name, file by file (files
    may order their columns differently; a missing column fails); dates
    parsed; ``src_file``/``src_pos`` keep the input order for first-wins
    dedup.  ``None`` when the platform has no files."""
    files = _files(spark, f"{base.rstrip('/')}/{platform}/{platform}_fake_data_*.csv")
    if not files:
        return None
    parts = []
    for header, group in _by_header(spark, files).items():
        missing = [f.name for f in schema.fields if f.name not in header]
        if missing:
            raise ValueError(f"{platform}: missing columns {missing} in {group[0]}")
        names = T.StructType([T.StructField(c, T.StringType()) for c in header])
        raw = spark.read.option("header", True).schema(names).csv(group)
        parts.append(raw.select(*[_cell(f.name, f.dataType).alias(f.name) for f in schema.fields],
                                F.col("_metadata.file_path").alias("src_file"),
                                F.monotonically_increasing_id().alias("src_pos")))
    return reduce(DataFrame.unionByName, parts)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A3: header CSV with a declared schema (a leading byte-order mark is
    removed by the reader)."""
    return spark.read.option("header", True).option("encoding", "UTF-8").schema(schema).csv(path)


def read_with_file_value(spark: SparkSession, path: str, fmt: str, name: str, pattern: str,
                         cast: str = "int", schema: T.StructType | str | None = None) -> DataFrame:
    """Files stacked in one read, with a column taken from each
    file's path by a regular expression, placed first."""
    r = spark.read.format(fmt).option("header", True)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    v = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast(cast)
    return df.select(v.alias(name), *[c for c in df.columns if c != name])


def read_columns(spark: SparkSession, path: str, cols: list[str], where=None) -> DataFrame:
    """Column subset and predicate, both pushed into the parquet scan."""
    df = spark.read.parquet(path).select(*cols)
    return df.filter(where) if where is not None else df
