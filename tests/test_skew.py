"""A hot key (most of the rows) is spread over many tasks, results exact."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tributary.operators.ranking import _bucketed, exact_quantiles


def test_hot_key_spreads_over_buckets(spark):
    n = 20000
    df = spark.range(n).select(F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.lit("cold")).alias("k"),
                               (F.col("id") * 7919 % 100003).cast("double").alias("v"))
    d = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("cnt"))
    b = _bucketed(d, "v", 32)
    parts = b.repartition(16, "k", "__b").groupBy(F.spark_partition_id().alias("p")).count().collect()
    biggest = max(r["count"] for r in parts) / n
    assert biggest < 0.25, biggest  # the hot key alone is 90 % of the rows

    got = exact_quantiles(df, "v", {"m": 0.5, "q9": 0.9}, ["k"]).toPandas().set_index("k")
    exp = df.toPandas().groupby("k")["v"].quantile([0.5, 0.9]).unstack()
    for k in ("hot", "cold"):
        assert list(got.loc[k, ["m", "q9"]]) == pytest.approx(list(exp.loc[k]))
    assert isinstance(exp, pd.DataFrame)
