"""Number parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._util import as_col

__all__ = ["split_part_as", "tolerant_number", "round_half_even", "text_number",
           "percent_number", "scale_to_long", "safe_ratio"]


def split_part_as(s: Column | str, delim: str, n: int, type_: str) -> Column:
    """H2: n-th part (1-based) of a text, cast tolerantly; absent part is null."""
    part = F.split_part(as_col(s), F.lit(delim), F.lit(n))
    return part.try_cast(type_)


def tolerant_number(s: Column | str, type_: str = "double") -> Column:
    """H9: text to number, bad text to null."""
    return as_col(s).try_cast(type_)


def round_half_even(c: Column | str, scale: int = 0) -> Column:
    """Half to even (pandas/Python parity up to binary rounding)."""
    return F.bround(as_col(c), scale)


def text_number(s: Column | str, type_: str = "long") -> Column:
    """``"2,288,966"`` to 2288966; blanks trimmed; bad text null."""
    return F.regexp_replace(F.trim(as_col(s)), ",", "").try_cast(type_)


def percent_number(s: Column | str) -> Column:
    """``2.0%`` to 2.0 (the number in percent units)."""
    return F.regexp_replace(F.trim(as_col(s)), "[%,]", "").try_cast("double")


def scale_to_long(c: Column | str, factor: int = 1000) -> Column:
    """Unit scaling to a 64-bit integer (no int overflow)."""
    return (as_col(c) * F.lit(factor)).cast("long")


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """2.T-4: division by zero gives null instead of failing under ANSI."""
    return F.try_divide(as_col(a), as_col(b))
