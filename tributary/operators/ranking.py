"""Exact positions of values inside their group, without a one-task window.

``value_positions`` returns, per distinct (keys, value), how many rows of
the group hold that value (``cnt``), how many hold a smaller one
(``before``) and the group size (``n``).  From it follow average ranks
(E3, M2) and exact quantiles with linear interpolation (D7, D9, D17).

Plan (all steps distributed):
1. ``groupBy(keys, value).count()`` - a hot value or key collapses map-side.
2. Cut the value axis into ``b`` buckets at approximate quantiles (a
   bounded list of ``b`` numbers computed by ``approxQuantile``); the
   bucket is found JVM-side by binary search (``Bucketizer``).
3. Per (keys, bucket) totals - at most keys x b rows - and their running
   sums over buckets within each key (``before`` of the bucket, and ``n``).
4. Join back on (keys, bucket) and add the running count inside the
   bucket (window over (keys, bucket), ordered by value).

A key holding a third of all rows is spread over all ``b`` buckets in
steps 3-4, so no task sees a whole group.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["value_positions", "average_rank", "exact_quantiles", "quantiles_from_positions", "default_buckets"]


MIN_BUCKETS = 16
ROWS_PER_BUCKET = 50_000


def default_buckets(df: DataFrame) -> int:
    """Most buckets a value axis is cut into: four for each shuffle partition."""
    try:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # noqa: BLE001
        n = 200
    return max(MIN_BUCKETS, 4 * n)


def _bucketed(d: DataFrame, value: str, buckets: int) -> DataFrame:
    probs = [i / buckets for i in range(1, buckets)]
    bounds = d.select(F.col(value).cast("double").alias("__v")).approxQuantile("__v", probs, 1.0 / (4 * buckets))
    splits = sorted({b for b in bounds if b == b})
    splits = [float("-inf"), *splits, float("inf")]
    # Bucketizer needs increasing splits; a value equal to a split goes up.
    src = d.withColumn("__vd", F.col(value).cast("double"))
    if len(splits) < 3:
        return src.withColumn("__b", F.lit(0.0)).drop("__vd")
    bz = Bucketizer(splits=splits, inputCol="__vd", outputCol="__b", handleInvalid="keep")
    return bz.transform(src).drop("__vd")


def value_positions(df: DataFrame, value: str, keys: list[str] | None = None,
                    buckets: int | None = None, materialize: bool = True) -> DataFrame:
    """(keys..., value, cnt, before, n) for every distinct non-null value.

    The distinct-value table is read three times (bucket bounds, bucket
    totals, the join back); with ``materialize`` it is computed once and
    written as a table in the shared checkpoint folder."""
    keys = list(keys or [])
    d = (df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
           .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt")))
    if materialize:
        from tributary.session import cut_lineage
        d = cut_lineage(d, "table")
    if buckets is None:
        buckets = default_buckets(df)
        if materialize:  # size from the written table: a bucket holds about ROWS_PER_BUCKET values
            buckets = max(MIN_BUCKETS, min(buckets, -(-d.count() // ROWS_PER_BUCKET)))
    d = _bucketed(d, value, buckets)
    tot = d.groupBy(*keys, "__b").agg(F.sum("cnt").alias("__bt"))
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    tot = (tot.withColumn("__boff", F.sum("__bt").over(wk.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("n", F.sum("__bt").over(wk))
              .select(*keys, "__b", F.coalesce(F.col("__boff"), F.lit(0)).alias("__boff"), "n"))
    j = d.join(tot, on=[*keys, "__b"])
    wb = Window.partitionBy(*keys, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    j = j.withColumn("before", F.col("__boff") + F.coalesce(F.sum("cnt").over(wb), F.lit(0)))
    return j.select(*keys, value, "cnt", F.col("before").cast("long").alias("before"),
                    F.col("n").cast("long").alias("n"))


def average_rank(df: DataFrame, value: str, keys: list[str] | None = None,
                 buckets: int | None = None) -> DataFrame:
    """(keys..., value, cnt, n, avg_rank, pct_rank): pandas ``rank(pct=True)``
    with ties averaged, over non-null values (``avg_rank / n``)."""
    p = value_positions(df, value, keys, buckets)
    ar = F.col("before") + (F.col("cnt") + 1) / 2.0
    return p.select(*(keys or []), value, "cnt", "n", ar.alias("avg_rank"), (ar / F.col("n")).alias("pct_rank"))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float],
                    keys: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``percentile``),
    one column per entry of ``probs`` (name -> p), one row per group."""
    keys = list(keys or [])
    return quantiles_from_positions(value_positions(df, value, keys, buckets), value, probs, keys)


def quantiles_from_positions(p: DataFrame, value: str, probs: dict[str, float],
                             keys: list[str] | None = None) -> DataFrame:
    """Quantiles from a ``value_positions`` table (one aggregation)."""
    keys = list(keys or [])
    v = F.col(value).cast("double")
    aggs = [F.max("n").alias("__n")]
    for name, q in probs.items():
        h = (F.col("n") - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        covers = lambda pos: (F.col("before") <= pos) & (pos < F.col("before") + F.col("cnt"))
        aggs += [F.max(F.when(covers(lo), v)).alias(f"__lo_{name}"),
                 F.max(F.when(covers(hi), v)).alias(f"__hi_{name}"),
                 F.max(h - lo).alias(f"__fr_{name}")]
    g = p.groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys]
    for name in probs:
        lo_v, hi_v, fr = F.col(f"__lo_{name}"), F.col(f"__hi_{name}"), F.col(f"__fr_{name}")
        out.append((lo_v + (hi_v - lo_v) * fr).alias(name))
    return g.select(*out)
