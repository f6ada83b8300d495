"""Data checks (J1-J6) reported as one table (check, table, column, failing_rows).

Each check is one aggregation pass; several checks on one table are
combined in one ``agg`` so the table is scanned once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.session import cut_lineage

__all__ = ["not_null_report", "unique_report", "table_report", "duplicate_rows", "not_empty_report",
           "check_report"]


def not_null_report(df: DataFrame, table: str, cols: list[str] | None = None) -> DataFrame:
    """Rows with a null, per column, all columns in one pass."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("failing_rows"))
        for c in cols])).alias("r"))
    return stacked.select(F.lit("not_null").alias("check"), F.lit(table).alias("table_name"),
                          "r.column_name", "r.failing_rows")


def unique_report(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first for each repeated key (set).

    ``groupBy(keys).count()`` combines map-side; only one row per distinct
    key per task crosses the shuffle."""
    g = df.groupBy(*keys).count()
    n = g.agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count") - 1)), F.lit(0)).cast("long")
              .alias("failing_rows"))
    return n.select(F.lit("unique").alias("check"), F.lit(table).alias("table_name"),
                    F.lit(",".join(keys)).alias("column_name"), "failing_rows")


def duplicate_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows pandas ``duplicated`` marks (every repeat after the first
    in ``order``, nulls first; of rows equal in ``keys + order`` one is kept).

    Rows get an id in a written copy, so that it stays the same when read
    twice.  The first row per key is a partial aggregate (``min`` of the
    order columns and the id); the repeats are the rows left after an anti
    join on the id alone, which spreads a key repeated in a third of the
    table over all tasks.  Null keys form a key of their own, as in pandas."""
    rows = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, "__row")).alias("__o")).select(F.col("__o.__row").alias("__row"))
    return rows.join(first, on="__row", how="left_anti").drop("__row")


def not_empty_report(df: DataFrame, table: str) -> DataFrame:
    """One failing row when the table is empty (a bounded probe)."""
    probe = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return probe.select(F.lit("not_empty").alias("check"), F.lit(table).alias("table_name"),
                        F.lit("*").alias("column_name"),
                        F.when(F.col("n") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("failing_rows"))


def table_report(df: DataFrame, table: str, not_null_cols: list[str], unique_keys: list[str]) -> DataFrame:
    """J1 + J6 in one scan (null counts and the row count), J2/J3 in one
    partial aggregation: the checks of one table as report rows."""
    a = df.agg(F.count(F.lit(1)).alias("__rows"),
               *[F.count_if(F.col(c).isNull()).alias(c) for c in not_null_cols])
    rows = [F.struct(F.lit("not_null").alias("check"), F.lit(c).alias("column_name"),
                     F.col(c).cast("long").alias("failing_rows")) for c in not_null_cols]
    rows.append(F.struct(F.lit("not_empty").alias("check"), F.lit("*").alias("column_name"),
                         F.when(F.col("__rows") == 0, 1).otherwise(0).cast("long").alias("failing_rows")))
    first = a.select(F.explode(F.array(*rows)).alias("r")).select(
        "r.check", F.lit(table).alias("table_name"), "r.column_name", "r.failing_rows")
    return first.unionByName(unique_report(df, table, unique_keys))


def check_report(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
