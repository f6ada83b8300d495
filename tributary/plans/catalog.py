"""Query catalogue: one named query per operator of the inventory, each
paired (where SQL can say it) with an equivalent DuckDB SQL text used as
the correctness oracle.

A query is ``fn(spark, sf_dir) -> DataFrame`` reading the given parquet
tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tributary.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def run(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every module that registers queries."""
    from tributary.plans import (queries_ads, queries_analysis, queries_io, queries_movement, queries_news,  # noqa: F401
                                 queries_passport, queries_road, queries_stream)
