"""Statistical tests (M1, M2) as aggregations.

Both reduce to per-group sums computed in one distributed pass (plus the
distributed rank of ``ranking.value_positions`` for Kruskal-Wallis); the
final formula works on a handful of numbers per test.  The p-values are
Column expressions too: closed forms for three groups, continued fractions
of the incomplete gamma and beta functions for other group counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.aggregates import drop_null_keys
from tributary.operators.ranking import value_positions

__all__ = ["one_way_anova", "kruskal_wallis", "chi_square_tail", "f_tail"]

def _num(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("double")


def _steps(a: Column, each: float) -> Column:
    """1, 2, ...: enough terms, which near the mean grow with the root of ``a``."""
    return F.sequence(F.lit(1), (100.0 + each * F.sqrt(F.greatest(a, F.lit(1.0)))).cast("int"))


def _remainder(x: Column) -> Column:
    """ln gamma(x) - ((x - 1/2) ln x - x + ln(2 pi) / 2): Stirling's series from
    ten on, stepped down to a smaller x > 0."""
    series = lambda z: 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7) + 1 / (1188 * z ** 9)
    z = x + 10.0
    logs = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda a, i: a + F.ln(x + i))
    small = series(z) + (z - 0.5) * F.ln(z) - (x - 0.5) * F.ln(x) - 10.0 - logs
    return F.when(x < 10.0, small).otherwise(series(x))


def _fraction(first: Column, a, b, steps: Column) -> Column:
    """first + a(1) / (b(1) + a(2) / (b(2) + ...)) by ratios of neighbouring convergents."""
    def step(s, i):
        i = i.cast("double")
        den, num = b(i) + a(i) * s["d"], b(i) + a(i) / s["c"]
        return F.struct((1.0 / den).alias("d"), num.alias("c"), (s["f"] * num / den).alias("f"))
    start = F.struct(F.lit(0.0).alias("d"), first.alias("c"), first.alias("f"))
    return F.aggregate(steps, start, step, lambda s: s["f"])


def chi_square_tail(x, k) -> Column:
    """P(X >= x) of a chi-square with ``k`` degrees of freedom; null for null or k < 1."""
    a, z = _num(k) / 2.0, _num(x) / 2.0
    # z^a e^-z / gamma(a) from the distance to the mean: no difference of large numbers.
    d = (z - a) / a
    front = F.sqrt(a / (2.0 * math.pi)) * F.exp(-a * (d - F.log1p(d)) - _remainder(a))
    series = F.aggregate(_steps(a, 10.0),
                         F.struct((1.0 / a).alias("t"), (1.0 / a).alias("s")),
                         lambda s, i: F.struct((s["t"] * z / (a + i)).alias("t"), (s["s"] + s["t"] * z / (a + i)).alias("s")),
                         lambda s: s["s"])
    far = front / _fraction(z + 1.0 - a, lambda i: -i * (i - a), lambda i: z + 1.0 - a + 2.0 * i, _steps(a, 20.0))
    return F.when((a <= 0) | z.isNull(), F.lit(None).cast("double")).when(z <= 0, F.lit(1.0)) \
            .when(z < a + 1.0, 1.0 - front * series).otherwise(far)


def _beta_part(x: Column, y: Column, a: Column, b: Column, apart: Column, front: Column) -> Column:
    """Regularised incomplete beta I_x(a, b), x = 1 - y <= a / (a + b), by the
    continued fraction in ``apart`` = (a + b) y - b, which keeps its digits where
    x is near 1 (Didonato and Morris 1992); ``front`` is x^a y^b / B(a, b)."""
    c, c1 = 1.0 + apart, 1.0 + 1.0 / a

    def step(s, i):
        i = i.cast("double")
        p, size, w = 1.0 + (i - 1.0) / a, a + 2.0 * i - 1.0, i * (b - i) * x
        alpha = p * (p + b / a) * F.pow(a / size, F.lit(2.0)) * w * x
        beta = i + w / size + (1.0 + i / a) / (c1 + 2.0 * i / a) * (c + i * (1.0 + y))
        down = alpha * s["d"] + beta
        return F.struct((s["r"] / down).alias("n"), (1.0 / down).alias("d"), ((alpha * s["n"] + beta * s["r"]) / down).alias("r"))
    start = F.struct(F.lit(0.0).alias("n"), (c1 / c).alias("d"), (c1 / c).alias("r"))
    return front * F.aggregate(_steps(F.least(a, b), 20.0), start, step, lambda s: s["r"])


def f_tail(f, d1, d2) -> Column:
    """P(F >= f) with ``d1`` and ``d2`` degrees of freedom; null for null or a degree < 1."""
    f, d1, d2 = _num(f), _num(d1), _num(d2)
    whole = d2 + d1 * f
    x, y, a, b = d2 / whole, d1 * f / whole, d2 / 2.0, d1 / 2.0
    # x^a y^b / B(a, b) from the distances of x and y to a / (a + b) and b / (a + b).
    u, v = d1 * (1.0 - f) / whole, (f - 1.0) * d2 / whole
    inner = a * (F.log1p(u) - u) + b * (F.log1p(v) - v) + _remainder(a + b) - _remainder(a) - _remainder(b)
    front = F.sqrt(a / (a + b) * b / (2.0 * math.pi)) * F.exp(inner)
    apart = b * v
    tail = F.when(f >= 1.0, _beta_part(x, y, a, b, apart, front)).otherwise(1.0 - _beta_part(y, x, b, a, -apart, front))
    return F.when((d1 < 1) | (d2 < 1) | f.isNull(), F.lit(None).cast("double")).when(f <= 0, F.lit(1.0)).otherwise(tail)


def one_way_anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """M1: F statistic and p-value of a one-way ANOVA over the groups."""
    d = drop_null_keys(df, [group]).filter(F.col(value).isNotNull())
    v = F.col(value).cast("double")
    g = d.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v"))
    # Sums of squares about means: plain sums of squares cancel for large values.
    # The means' own weighted variance is about their mean; both are running sums.
    grand = (F.sum(F.col("n") * (F.col("m") - F.col("near"))) / F.sum("n")).alias("off")
    near = g.agg(F.min("m")).scalar()       # any of the means: differences to it are small
    off = g.withColumn("near", near).agg(grand).scalar()
    spread, apart = F.col("n") * F.col("v"), F.col("n") * F.pow(F.col("m") - near - off, F.lit(2.0))
    t = g.agg(F.count(F.lit(1)).alias("k"), F.sum("n").cast("long").alias("N"), F.sum(spread).alias("within"), F.sum(apart).alias("between"))
    t = t.withColumn("d1", F.col("k") - 1).withColumn("d2", F.col("N") - F.col("k"))
    mean_square = [F.try_divide(F.col(s).cast("double"), F.col(d)) for s, d in (("between", "d1"), ("within", "d2"))]
    t = t.withColumn("f_statistic", F.try_divide(*mean_square))
    f, d1, d2 = F.col("f_statistic"), F.col("d1"), F.col("d2")
    p = F.when((d1 == 2) & (d2 > 0), F.pow(F.lit(1.0) + 2.0 * f / d2, -d2 / 2.0)).otherwise(f_tail(f, d1, d2))
    return t.select(F.col("k").cast("long").alias("groups"), F.col("N").cast("long").alias("n"),
                    "f_statistic", p.alias("p_value"))


def kruskal_wallis(df: DataFrame, group: str, value: str) -> DataFrame:
    """M2: H statistic with tie correction and its chi-square p-value.

    Ranks are averaged over ties across all groups: positions of each
    distinct value come from ``value_positions`` (no global window)."""
    d = drop_null_keys(df, [group]).filter(F.col(value).isNotNull()).select(group, value)
    pos = value_positions(d, value)  # (value, cnt, before, n) over all groups
    ranks = pos.select(value, (F.col("before") + (F.col("cnt") + 1) / 2.0).alias("r"),
                       F.col("cnt").alias("t"), F.col("n").alias("N"))
    per = d.groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    j = per.join(ranks, on=value)
    # Tie term: each distinct value's t^3 - t, spread over its per-group rows
    # in proportion c / t, is the sum of c * (t^2 - 1) - so every number
    # comes out of one aggregation chain, with no join of one-row tables.
    t = F.col("t").cast("double")
    g = j.groupBy(group).agg(F.sum(F.col("c") * F.col("r")).alias("R"), F.sum("c").alias("ni"),
                             F.sum(F.col("c") * (t * t - 1.0)).alias("Tg"))
    h = g.agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("R") * F.col("R") / F.col("ni")).alias("RR"),
              F.sum("ni").cast("double").alias("N"), F.sum("Tg").alias("T"))
    n = F.col("N")
    h_raw = 12.0 / (n * (n + 1)) * F.col("RR") - 3.0 * (n + 1)
    hc = F.try_divide(h_raw, F.lit(1.0) - F.try_divide(F.col("T"), n * n * n - n))
    h = h.withColumn("h_statistic", hc)
    p = F.when(F.col("k") == 3, F.exp(-F.col("h_statistic") / 2.0)) \
         .otherwise(chi_square_tail(F.col("h_statistic"), F.col("k") - 1))
    return h.select(F.col("k").cast("long").alias("groups"), n.cast("long").alias("n"), "h_statistic", p.alias("p_value"))
