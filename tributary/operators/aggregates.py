"""Aggregations (D2-D22).  Every operator is one ``groupBy``/``agg`` with
partial (map-side) aggregation; nothing gathers a group into one task.
pandas drops null group keys, Spark keeps a null group: ``drop_null_keys``
filters them first where pandas parity is wanted (2.T-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import narrowing
from tributary.session import cut_lineage

__all__ = ["drop_null_keys", "table_shape", "mean_std", "value_counts", "null_counts", "profile_numeric",
           "profile_text", "schema_profile", "box_stats", "correlation_matrix", "sums_with_ratios", "pivot_mean"]

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def mean_std(df: DataFrame, keys: list[str], measure: str, digits: int | None = None,
             prefix: str = "") -> DataFrame:
    """Mean and sample standard deviation per group (single-row std
    is null in pandas and Spark alike)."""
    m, s = F.avg(measure), F.stddev_samp(measure)
    if digits is not None:
        m, s = F.bround(m, digits), F.bround(s, digits)
    return drop_null_keys(df, keys).groupBy(*keys).agg(m.alias(f"{prefix}mean"), s.alias(f"{prefix}std"))


def value_counts(df: DataFrame, col: str, normalize: bool = False, scale: float = 1.0,
                 name: str | None = None) -> DataFrame:
    """Rows per value, nulls excluded (also from the share base)."""
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return g
    from tributary.operators.windows import share_of_total
    return share_of_total(g, "count", name or "proportion", scale).select(col, name or "proportion")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass, as (column, nulls)."""
    a = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                 F.col(c).cast("long").alias("nulls")) for c in df.columns]))
                    .alias("r")).select("r.*")


def table_shape(df: DataFrame, name: str) -> DataFrame:
    """Rows (one counting pass) and columns (metadata) of a table."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"))


def profile_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pandas ``describe`` for numbers, one row per column:
    count, mean, std, min, 25%, 50%, 75%, max.  All columns are read together:
    moments, extremes and quartile brackets in a first pass, the exact quartiles
    in a second."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = cols or [c for c in df.columns if isinstance(types[c], NUMERIC)]
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    v = F.col(narrowing.VALUE)
    rows = narrowing.long_form(df, cols, [])
    moments = [F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")]
    base = cut_lineage(narrowing.group_brackets(rows, [], list(probs.values()), extra=moments))
    q = narrowing.quantiles_of(narrowing.cells(rows, [], base), [], probs)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], f"{narrowing.NAME} string")  # a column without numbers keeps its row
    p = names.join(base.drop("brackets"), narrowing.NAME, "left").join(q, narrowing.NAME, "left")
    return p.select(F.col(narrowing.NAME).alias("column_name"), F.coalesce("n", F.lit(0)).cast("long").alias("count"),
                    "mean", "std", "min", "q25", "q50", "q75", "max")


def profile_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, unique, top, freq for text columns (pandas ``describe``
    of objects), all columns read together.  ``top`` ties break to the smallest
    value.  Rows become (column, value) and are counted once; the counts are
    partial before the shuffle, so a frequent value is not a hot key."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = cols or [c for c in df.columns if isinstance(types[c], T.StringType)]
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in cols])).alias("x")
    counts = df.select(one).select("x.*").filter(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    first = F.min_by(F.col("v"), F.struct((-F.col("n")).alias("less"), F.col("v").alias("v")))
    got = counts.groupBy("column_name").agg(F.sum("n").cast("long").alias("count"), F.count(F.lit(1)).cast("long").alias("unique"),
                                            first.alias("top"), F.max("n").cast("long").alias("freq"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    return names.join(got, "column_name", "left").select("column_name", F.coalesce("count", F.lit(0).cast("long")).alias("count"),
                                                         F.coalesce("unique", F.lit(0).cast("long")).alias("unique"), "top", "freq")


def schema_profile(df: DataFrame) -> DataFrame:
    """The schema part of a profile (``info``): position, column, type and
    number of values that aren't null, one counting pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.select(F.explode(F.array(*[F.struct(
        F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
        F.col(f.name).cast("long").alias("not_null")) for i, f in enumerate(df.schema.fields)])).alias("r")).select("r.*")


def box_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR of the box)
    and outlier count per group."""
    return narrowing.box(drop_null_keys(df, list(keys)), list(keys), value)


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete rows),
    all pairs in one aggregation, long form (col_a, col_b, corr)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{i}").alias("corr"))
                     for i, (a, b) in enumerate(pairs)])
    return agg.select(F.explode(rows).alias("r")).select("r.*")


def sums_with_ratios(df: DataFrame, keys: list[str], sums: dict[str, str],
                     ratios: dict[str, tuple[str, str]], extra: list[Column] | None = None) -> DataFrame:
    """Sums per group and ratios of those sums (null on zero)."""
    g = drop_null_keys(df, keys).groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()], *(extra or []))
    for n, (a, b) in ratios.items():
        g = g.withColumn(n, F.try_divide(F.col(a), F.col(b)))
    return g


def pivot_mean(df: DataFrame, row: str, col: str, value: str, values: list) -> DataFrame:
    """Mean of ``value`` per row key with one column per given
    ``col`` value (values listed, so no extra pass finds them)."""
    return df.groupBy(row).pivot(col, values).agg(F.avg(value))
