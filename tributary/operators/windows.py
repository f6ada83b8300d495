"""Window operators.

Per-key orderings are expressed as window functions or as ``min_by`` /
``max_by`` aggregates.  The aggregate form is preferred wherever only the
first or last row of a group is needed: it combines map-side, so a hot
key is reduced before the shuffle and one task never holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["bidirectional_rank", "first_last", "keep_first", "share_of_total",
           "packed_order_key", "unpack_major", "skew_safe_row_numbers", "bucketed_lag"]


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def bidirectional_rank(df: DataFrame, keys: list[str], order: str, tie: str,
                       asc_name: str = "rn_asc", desc_name: str = "rn_desc") -> DataFrame:
    """``row_number`` ascending and descending over ``keys``.

    ``tie`` makes the order total (the reference has none, so its result
    is not repeatable).  Both windows share one partitioning and one sort
    order reversed, so Spark plans one shuffle for the pair."""
    w_asc = Window.partitionBy(*keys).orderBy(F.col(order).asc(), F.col(tie).asc())
    w_desc = Window.partitionBy(*keys).orderBy(F.col(order).desc(), F.col(tie).desc())
    return (df.withColumn(asc_name, F.row_number().over(w_asc))
              .withColumn(desc_name, F.row_number().over(w_desc)))


_FIXED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
          T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TWO64 = 18446744073709551616
_TWO63 = 9223372036854775808


def packed_order_key(major: Column | str, minor: Column | str) -> Column:
    """One DECIMAL(38,0) that orders like the pair (major, minor) of
    64-bit integers, with ``major`` in [0, 2^64) and any signed ``minor``.

    A fixed-width ordering key lets ``min_by``/``max_by`` run in the hash
    aggregate; a struct key forces a sort-based aggregate that sorts every
    input row before the partial combine."""
    d = "decimal(38,0)"
    mj = (F.col(major) if isinstance(major, str) else major).cast(d)
    mn = (F.col(minor) if isinstance(minor, str) else minor).cast(d)
    return mj * F.lit(str(_TWO64)).cast(d) + (mn + F.lit(str(_TWO63)).cast(d))


def unpack_major(key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.floor(k / F.lit(str(_TWO64)).cast("decimal(38,0)")).cast("long")


def first_last(df: DataFrame, keys: list[str], order: list[str],
               first: dict[str, str] | None = None, last: dict[str, str] | None = None,
               aggs: list[Column] | None = None) -> DataFrame:
    """First and last values per group in one aggregation.

    ``first``/``last`` map output name -> input column, taken at the least /
    greatest ``order`` tuple.  Extra ``aggs`` (avg, max, ...) ride along in
    the same ``groupBy`` so the whole summary is one shuffle with partial
    aggregation.  When the order is one fixed-width column or two integral
    columns, and the values are fixed-width, each value gets its own
    ``min_by``/``max_by`` over a fixed-width key (hash aggregate);
    otherwise structs are used (sort aggregate, same result)."""
    first, last = first or {}, last or {}
    types = {f.name: f.dataType for f in df.schema.fields}
    fixed_vals = all(isinstance(types[c], _FIXED) for c in [*first.values(), *last.values()])
    okey = None
    if fixed_vals and len(order) == 1 and isinstance(types[order[0]], _FIXED):
        okey = F.col(order[0])
    elif fixed_vals and len(order) == 2 and all(isinstance(types[o], _INTEGRAL) for o in order):
        okey = packed_order_key(order[0], order[1])
    out = list(aggs or [])
    if okey is not None:
        out += [F.min_by(c, okey).alias(n) for n, c in first.items()]
        out += [F.max_by(c, okey).alias(n) for n, c in last.items()]
        return df.groupBy(*keys).agg(*out)
    skey = F.struct(*_cols(order))
    if first:
        out.append(F.min_by(F.struct(*[F.col(c).alias(n) for n, c in first.items()]), skey).alias("__first"))
    if last:
        out.append(F.max_by(F.struct(*[F.col(c).alias(n) for n, c in last.items()]), skey).alias("__last"))
    g = df.groupBy(*keys).agg(*out)
    sel = [F.col(c) for c in g.columns if c not in ("__first", "__last")]
    sel += [F.col(f"__first.{n}").alias(n) for n in first]
    sel += [F.col(f"__last.{n}").alias(n) for n in last]
    return g.select(*sel)


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Keep the first row per key in the given input order.

    Expressed as ``min_by`` grouped by the keys: a partial aggregate, so
    duplicates collapse map-side and a key repeated a billion times costs
    one row per map task in the shuffle.  With fixed-width columns and a
    one-column (or two integral columns) order, each column gets its own
    ``min_by`` over a fixed-width key (hash aggregate); otherwise the row
    is carried as a struct (sort aggregate)."""
    others = [c for c in df.columns if c not in keys]
    if all(isinstance(o, str) for o in order):
        return first_last(df, keys, list(order), first={c: c for c in others}).select(*df.columns)
    okey = F.struct(*_cols(order))
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in others]), okey).alias("__row"))
    return g.select(*[F.col(k) for k in keys], *[F.col(f"__row.{c}").alias(c) for c in others])


def share_of_total(df: DataFrame, count_col: str, name: str = "share", scale: float = 1.0) -> DataFrame:
    """Each row's share of the column total.

    ``df`` is an aggregated table (one row per label).  It is written once
    as a table in the shared checkpoint folder; the total is a scalar
    subquery over that table, so neither the aggregation nor its input is
    computed twice, and no unpartitioned window gathers the rows."""
    from tributary.session import cut_lineage
    g = cut_lineage(df, "table")
    tot = g.agg(F.sum(count_col)).scalar()
    return g.withColumn(name, F.try_divide(F.col(count_col) * F.lit(scale), tot))


def skew_safe_row_numbers(df: DataFrame, keys: list[str], major: str, minor: str,
                          asc_name: str = "rn_asc", desc_name: str = "rn_desc") -> DataFrame:
    """E1 without a per-group window: the position of each row's order key
    (``major``, ``minor`` integral, unique per row within a group) among
    its group comes from ``ranking.value_positions`` (bucketed prefix
    sums); ``rn_asc = before + 1``, ``rn_desc = n - before``.  The join
    back is on (keys, order key), unique per row, so a hot group is spread
    over all tasks."""
    from tributary.operators.ranking import value_positions
    d = df.withColumn("__ok", packed_order_key(major, minor))
    pos = value_positions(d.select(*keys, "__ok"), "__ok", keys)
    j = d.join(pos.select(*keys, "__ok", "before", "n"), on=[*keys, "__ok"])
    return (j.withColumn(asc_name, F.col("before") + 1)
             .withColumn(desc_name, F.col("n") - F.col("before"))
             .drop("__ok", "before", "n"))


def bucketed_lag(df: DataFrame, keys: list[str], t: str, tie: str, cols: list[str],
                 bucket: float, prefix: str = "prev_") -> DataFrame:
    """``lag(col)`` over (keys ordered by t, tie) without one task per key:
    windows run per (keys, time bucket) and the first row of each bucket
    takes the last row of the previous non-empty bucket, found in a
    per-bucket table (one row per bucket) joined back on (keys, bucket)."""
    KB = [*keys, "__bk"]
    d = df.withColumn("__bk", F.floor(F.col(t) / F.lit(bucket)).cast("long"))
    w = Window.partitionBy(*KB).orderBy(F.col(t), F.col(tie))
    d = d.withColumn("__has_prev", F.lag(F.lit(1)).over(w).isNotNull()) \
         .withColumn("__is_last", F.lead(F.lit(1)).over(w).isNull())
    for c in cols:
        d = d.withColumn(f"__l_{c}", F.lag(c).over(w))
    last = d.filter("__is_last").select(*KB, *[F.col(c).alias(f"__b_{c}") for c in cols])
    wk = Window.partitionBy(*keys).orderBy("__bk")
    last = last.select(*KB, *[F.lag(f"__b_{c}").over(wk).alias(f"__p_{c}") for c in cols])
    j = d.join(last, on=KB, how="left")
    for c in cols:
        j = j.withColumn(f"{prefix}{c}", F.when(F.col("__has_prev"), F.col(f"__l_{c}")).otherwise(F.col(f"__p_{c}")))
    return j.drop("__bk", "__has_prev", "__is_last", *[f"__l_{c}" for c in cols], *[f"__p_{c}" for c in cols])
