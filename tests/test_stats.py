"""Tails of the F and chi-square distributions against closed forms and sums."""

import math

import numpy as np
import pytest

from tributary.operators.stats import chi_square_tail, f_tail, kruskal_wallis, one_way_anova


def _chi(x, k):
    """Closed forms: powers for an even k, the error function for an odd one."""
    h = x / 2
    if k % 2 == 0:
        return math.exp(-h) * sum(h ** j / math.factorial(j) for j in range(k // 2))
    out, term = math.erfc(math.sqrt(h)), math.sqrt(h) / math.gamma(1.5) * math.exp(-h)
    for j in range(1, k // 2 + 1):
        out, term = out + term, term * h / (j + 0.5)
    return out


def _f(f, d1, d2):
    """The density of the beta variable, summed by the middle of 400,000 slices."""
    top, a, b = d2 / (d2 + d1 * f), d2 / 2, d1 / 2
    t = (np.arange(400_000) + 0.5) / 400_000 * top
    log = (a - 1) * np.log(t) + (b - 1) * np.log1p(-t) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    return float(np.exp(log).sum() * top / 400_000)


def test_chi_square_tail(spark):
    cases = [(x, k) for x in (0.01, 0.5, 3.0, 11.0, 80.0) for k in (1, 2, 3, 4, 5, 9, 24)]
    df = spark.createDataFrame(cases, "x double, k int")
    for r in df.select("x", "k", chi_square_tail(df.x, df.k).alias("p")).collect():
        assert r.p == pytest.approx(_chi(r.x, r.k), rel=1e-9, abs=1e-14), r
    odd = spark.createDataFrame([(None, 3), (1.0, 0), (0.0, 2)], "x double, k int")
    assert [r.p for r in odd.select(chi_square_tail(odd.x, odd.k).alias("p")).collect()] == [None, None, 1.0]


def test_f_tail(spark):
    cases = [(f, a, b) for f in (0.2, 1.0, 2.5, 9.0) for a in (2, 4, 7) for b in (4, 30, 995)]
    df = spark.createDataFrame(cases, "f double, a int, b int")
    for r in df.select("f", "a", "b", f_tail(df.f, df.a, df.b).alias("p")).collect():
        assert r.p == pytest.approx(_f(r.f, r.a, r.b), rel=1e-5, abs=1e-12), r
    two = spark.createDataFrame([(4.0, 1, 1)], "f double, a int, b int")  # a Cauchy variable over 2
    assert two.select(f_tail(two.f, two.a, two.b)).first()[0] == pytest.approx(1 - 2 * math.atan(2) / math.pi, rel=1e-9)
    huge = spark.createDataFrame([(2.0, 4, 10 ** 12)], "f double, a int, b long")
    assert huge.select(f_tail(huge.f, huge.a, huge.b)).first()[0] == pytest.approx(_chi(8.0, 4), rel=1e-6)


def test_five_groups_and_one(spark):
    rows = [(g, float(v)) for g, vs in {"a": [1, 2, 9], "b": [2, 5, 4], "c": [1, 8, 6], "d": [7, 9, 9], "e": [3, 3, 8]}.items()
            for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    a = one_way_anova(df, "g", "v").first()
    assert a.groups == 5 and a.p_value == pytest.approx(_f(a.f_statistic, 4, 10), rel=1e-5)
    k = kruskal_wallis(df, "g", "v").first()
    assert k.groups == 5 and k.p_value == pytest.approx(_chi(k.h_statistic, 4), rel=1e-9)
    one = df.filter("g = 'a'")
    assert one_way_anova(one, "g", "v").first().p_value is None
    assert kruskal_wallis(one, "g", "v").first().p_value is None


def _gamma_tail(a, z):
    """Q(a, z) for a whole a: e^-z times the sum of z^k / k!, with 60 digits."""
    from decimal import Decimal, getcontext
    getcontext().prec = 60
    term = total = Decimal(1)
    for k in range(1, a):
        term = term * Decimal(z) / k
        total += term
    return float(total * (-Decimal(z)).exp())


def test_tails_at_any_size(spark):
    """Relative error under 1e-9 from 1 to 1e9 degrees of freedom."""
    import math
    import pytest
    from pyspark.sql import functions as F
    from tributary.operators.stats import chi_square_tail, f_tail
    cases = [(2 * a, 2 * z) for a, z in ((1, .5), (1, 30.), (4, 4.), (50, 30.), (50, 50.), (50, 90.), (5000, 4900.), (5000, 5000.), (5000, 5300.), (50000, 49950.), (50000, 50000.), (50000, 51000.))]
    rows = spark.createDataFrame([(float(x), k) for k, x in cases], "x double, k long").select("x", "k", chi_square_tail(F.col("x"), F.col("k")).alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx(_gamma_tail(int(r.k) // 2, r.x / 2), rel=1e-9), r
    one = spark.range(1).select(chi_square_tail(1.0, 1).alias("a"), chi_square_tail(1e9, 10 ** 9).alias("b"), chi_square_tail(9.0, 1).alias("c")).first()
    assert one.a == pytest.approx(math.erfc(math.sqrt(.5)), rel=1e-12) and one.c == pytest.approx(math.erfc(math.sqrt(4.5)), rel=1e-11)
    big = 5e8                                                    # the series of Q(a, a)
    assert one.b == pytest.approx(.5 - (1 / 3 + 1 / (540 * big)) / math.sqrt(2 * math.pi * big), rel=1e-9)

    def exact(f, d1, d2):                                        # closed forms for 2 and 4 degrees above
        a, y = d2 / 2, d1 * f / (d2 + d1 * f)
        first = math.exp(a * math.log1p(-y))
        return first if d1 == 2 else first * (1 + a * y)
    cases = [(f, d1, d2) for d1 in (2, 4) for d2 in (1, 3, 50, 999_999, 1_000_001, 10 ** 9) for f in (.01, .9, 2., 10., 50.)]
    for r in spark.createDataFrame(cases, "f double, d1 long, d2 long").select("*", f_tail(F.col("f"), F.col("d1"), F.col("d2")).alias("p")).collect():
        assert r.p == pytest.approx(exact(r.f, r.d1, r.d2), rel=1e-9), r
