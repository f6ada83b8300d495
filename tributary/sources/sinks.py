"""Writers (A9-A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame

__all__ = ["export_sorted_csv", "export_json"]

BOM = "﻿"


def export_sorted_csv(df: DataFrame, path: str, order: list, bom: bool = True, single_file: bool = False) -> None:
    """A10: CSV sorted by ``order``.  The sort is a range partitioning, so
    part files follow each other in order; ``single_file`` (small results
    only) coalesces the sorted rows into one file.  ``bom`` puts a byte-order
    mark before the header, as spreadsheet tools expect."""
    out = df.orderBy(*order)
    if bom:
        first = out.columns[0]
        out = out.withColumnRenamed(first, BOM + first)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, UTF-8 text kept as is."""
    df.write.mode("overwrite").option("encoding", "UTF-8").json(path)

