"""Exact order statistics by narrowing.

A first pass over the rows gives each group its size and, from a quantile sketch
of known error, a bracket of values around each wanted rank.  A second pass
counts the rows below and above each bracket and keeps the different values
inside it with their counts; a running count over these finds the value at a
rank exactly.  The input is read twice, whatever the number of columns and
ranks; no table of all different values is built, and nothing is collected.

A bracket holds about 4 / ``accuracy`` of its group's rows (a group of up to
4 * ``accuracy`` rows is its own bracket), and one task sorts its different
values: raise ``accuracy`` with the largest group (a sketch grows with it).  A
bracket that missed its rank would raise an error, never give a near value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.session import cut_lineage

__all__ = ["long_form", "group_brackets", "cells", "quantiles_of", "quantiles", "box", "value_at_share"]

ACCURACY = 10_000
NAME, VALUE = "__column", "__value"


def long_form(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys, column name, value as double) of all numbers; nulls and NaN go."""
    one = lambda c: F.struct(F.lit(c).alias(NAME), F.col(c).cast("double").alias(VALUE))
    rows = df.select(*keys, (F.explode(F.array(*map(one, columns))) if len(columns) > 1 else one(columns[0])).alias("x")).select(*keys, "x.*")
    return rows.filter(F.col(VALUE).isNotNull() & ~F.isnan(VALUE))


def group_brackets(rows: DataFrame, keys: list[str], probs: list[float], accuracy: int = ACCURACY, fences: bool = False,
                   extra: list[Column] | None = None) -> DataFrame:
    """Pass 1: (keys, column, n, brackets, extra...).  Bracket i surrounds the
    rank of ``probs[i]``; with ``fences`` two more surround the whisker limits
    that the first and last of ``probs`` (the quartiles) can give."""
    wanted = [min(1.0, max(0.0, p + s * 2 / accuracy)) for p in probs for s in (-1, 1)]
    g = rows.groupBy(*keys, NAME).agg(F.count(F.lit(1)).alias("n"), F.min(VALUE).alias("__min"), F.max(VALUE).alias("__max"),
                                      F.percentile_approx(VALUE, wanted, accuracy).alias("__q"), *(extra or []))
    few = F.col("n") <= 4 * accuracy
    lo = [F.when(few, F.col("__min")).otherwise(F.col("__q")[2 * i]) for i in range(len(probs))]
    hi = [F.when(few, F.col("__max")).otherwise(F.col("__q")[2 * i + 1]) for i in range(len(probs))]
    ends = list(zip(lo, hi))
    if fences:
        slack = F.greatest(F.abs(F.col("__min")), F.abs(F.col("__max"))) * 1e-9
        ends += [(2.5 * lo[0] - 1.5 * hi[-1] - slack, 2.5 * hi[0] - 1.5 * lo[-1] + slack),
                 (2.5 * lo[-1] - 1.5 * hi[0] - slack, 2.5 * hi[-1] - 1.5 * lo[0] + slack)]
    brackets = F.array(*[F.struct(F.lit(i).alias("b"), a.alias("lo"), b.alias("hi")) for i, (a, b) in enumerate(ends)])
    return g.withColumn("brackets", brackets).drop("__min", "__max", "__q")


def cells(rows: DataFrame, keys: list[str], brackets: DataFrame) -> DataFrame:
    """Pass 2: (keys, column, b, side, v, cnt, low, high, n, before), written
    out.  Side -1 and 1 are all rows below and above bracket ``b`` (``low`` and
    ``high``: their extremes), side 0 one value inside it; ``before`` counts the
    group's rows of smaller values."""
    on = [*keys, NAME]
    x = rows.join(brackets.select(*on, "n", "brackets"), on).select(*on, "n", VALUE, F.explode("brackets").alias("x"))
    side = F.when(F.col(VALUE) < F.col("x.lo"), -1).when(F.col(VALUE) > F.col("x.hi"), 1).otherwise(0)
    x = x.select(*on, "n", VALUE, F.col("x.b").alias("b"), side.alias("side"))
    # -0.0 and 0.0 are one value.
    x = x.withColumn("v", F.when(F.col("side") == 0, F.col(VALUE) + 0.0))
    t = cut_lineage(x.groupBy(*on, "b", "side", "v").agg(F.count(F.lit(1)).alias("cnt"), F.min(VALUE).alias("low"), F.max(VALUE).alias("high"),
                                                        F.first("n").alias("n")))
    w = Window.partitionBy(*on, "b").orderBy("side", "v").rowsBetween(Window.unboundedPreceding, -1)
    return t.withColumn("before", F.coalesce(F.sum("cnt").over(w), F.lit(0)))


def quantiles_of(t: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """(keys, column, one value for each of ``probs``), with linear
    interpolation, from ``cells`` whose brackets are those of ``probs``."""
    missed = F.raise_error(F.lit("a bracket missed its rank")).cast("double")
    inside = F.col("side") == 0
    aggs, out = [], []
    for i, (name, p) in enumerate(probs.items()):
        h = (F.col("n") - 1) * F.lit(float(p))
        at = lambda pos: F.max(F.when((F.col("b") == i) & inside & (F.col("before") <= pos) & (pos < F.col("before") + F.col("cnt")), F.col("v")))  # noqa: B023, E731
        aggs += [at(F.floor(h)).alias(f"__lo{i}"), at(F.ceil(h)).alias(f"__hi{i}"), F.max(h - F.floor(h)).alias(f"__part{i}")]
        lo, hi = F.coalesce(F.col(f"__lo{i}"), missed), F.coalesce(F.col(f"__hi{i}"), missed)
        out.append((lo + (hi - lo) * F.col(f"__part{i}")).alias(name))
    return t.groupBy(*keys, NAME).agg(*aggs).select(*keys, NAME, *out)


def quantiles(df: DataFrame, columns: list[str], probs: dict[str, float], keys: list[str] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles of each column and group: (keys, column_name, probs...)."""
    keys = list(keys or [])
    rows = long_form(df, columns, keys)
    t = cells(rows, keys, group_brackets(rows, keys, list(probs.values()), accuracy))
    return quantiles_of(t, keys, probs).withColumnRenamed(NAME, "column_name")


def box(df: DataFrame, keys: list[str], value: str, accuracy: int = ACCURACY) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR of the box) and
    outlier count per group, from the same two passes."""
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    rows = long_form(df, [value], keys)
    t = cells(rows, keys, group_brackets(rows, keys, list(probs.values()), accuracy, fences=True))
    on = [*keys, NAME]
    q = quantiles_of(t, keys, probs).withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("__lo", F.col("q1") - 1.5 * F.col("iqr")).withColumn("__hi", F.col("q3") + 1.5 * F.col("iqr"))
    j = t.filter(F.col("b") >= 3).join(q, on)
    low, high = F.col("b") == 3, F.col("b") == 4
    # A row at a limit is inside; rows below the low limit's bracket and above the high one's are outliers.
    over = (low & ((F.col("side") < 0) | ((F.col("side") == 0) & (F.col("v") < F.col("__lo"))))) | \
        (high & ((F.col("side") > 0) | ((F.col("side") == 0) & (F.col("v") > F.col("__hi")))))
    return j.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("q1", "median", "q3", "iqr")],
        F.min(F.when(low & ~over, F.col("low"))).alias("whisker_low"), F.max(F.when(high & ~over, F.col("high"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(over, F.col("cnt"))), F.lit(0)).cast("long").alias("outliers"))


def value_at_share(df: DataFrame, value: str, share: float, accuracy: int = ACCURACY) -> Column:
    """The least value whose average percentile rank (ties averaged, as
    pandas ``rank(pct=True)``) is at least ``share``, as a scalar; null if none is."""
    rows = long_form(df, [value], [])
    t = cells(rows, [], group_brackets(rows, [], [share], accuracy))
    rank = (F.col("before") + (F.col("cnt") + 1) / 2.0) / F.col("n")
    inside = F.when((F.col("side") == 0) & (rank >= share), F.col("v"))
    # Ranks grow with the value: beyond the bracket the next value passes, if it does, before any other.
    above = F.when(F.col("side") > 0, F.col("low"))
    return t.agg(F.coalesce(F.min(inside), F.min(above))).scalar()

