"""Reshape operators.

All work on DataFrames; column-name logic (positional renames, fuzzy
header matches) touches only metadata on the driver."""

from __future__ import annotations

import difflib
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["melt", "rename_by_position", "keep_total_row", "reorder", "resolve_columns",
           "from_first_match", "per_file_choice"]


def melt(df: DataFrame, ids: list[str], values: list[str], var_name: str, value_name: str,
         value_type: str | None = None) -> DataFrame:
    """L1: wide to long; measures are cast to one type first (``unpivot``
    needs a common type).  Rows with null measures are kept, as pandas
    ``melt`` keeps them."""
    if value_type:
        df = df.select(*ids, *[F.col(v).cast(value_type).alias(v) for v in values])
    return df.unpivot(ids, values, var_name, value_name)


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """L2: rename all columns by position when the count matches; warn and
    leave the frame unchanged otherwise (the reference's behaviour)."""
    if len(df.columns) != len(names):
        warnings.warn(f"column count mismatch: expected {len(names)}, got {len(df.columns)}")
        return df
    return df.toDF(*names)


def keep_total_row(df: DataFrame, label_col: str, label: str, keep: list[str]) -> DataFrame:
    """L4: the one total row and the wanted columns."""
    return df.filter(F.col(label_col) == label).select(*keep)


def reorder(df: DataFrame, first: list[str]) -> DataFrame:
    """Given columns first, the rest in their order."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def resolve_columns(df: DataFrame, wanted: list[str], cutoff: float = 0.6) -> list[str]:
    """For each wanted name the closest present column (difflib ratio
    at least ``cutoff``); metadata only.  Raises when a name has no match."""
    out = []
    for w in wanted:
        m = difflib.get_close_matches(w, df.columns, n=1, cutoff=cutoff)
        if not m:
            raise KeyError(f"no column close to {w!r}")
        out.append(m[0])
    return out


def from_first_match(df: DataFrame, file_col: str, row_col: str, pred: Column) -> DataFrame:
    """Per file, keep rows from the first row (by ``row_col``) where
    ``pred`` holds; files where it never holds are dropped.  The start row
    per file is a one-row-per-file aggregate joined back by file."""
    start = df.groupBy(file_col).agg(F.min(F.when(pred, F.col(row_col))).alias("__start"))
    return df.join(start, on=file_col).filter(F.col(row_col) >= F.col("__start")).drop("__start")


def per_file_choice(df: DataFrame, file_col: str, test: Column, if_any: Column, otherwise: Column) -> DataFrame:
    """When any row of a file passes ``test``, keep the rows passing
    ``if_any``, else those passing ``otherwise`` (one aggregate per file)."""
    flag = df.groupBy(file_col).agg(F.max(test.cast("int")).alias("__any"))
    j = df.join(flag, on=file_col)
    return j.filter(F.when(F.col("__any") == 1, if_any).otherwise(otherwise)).drop("__any")
