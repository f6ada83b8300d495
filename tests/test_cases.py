"""Remaining cases from FIXTURES (news, ads, player spend, statistics)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.operators.html import clean_pages
from tributary.operators.reshape import resolve_columns
from tributary.plans import ads
from tributary.plans.analysis import account_roi, quarter_currency


def test_page_empty_after_cleaning_is_dropped(spark):
    pages = spark.createDataFrame([(1, "<script>x()</script><span>only</span>"), (2, "<p>text</p>")],
                                  "page_id long, html string")
    assert [r.page_id for r in clean_pages(pages).collect()] == [2]


def test_two_ga_sources_multiply_only_in_reference_join(spark):
    d = dt.date(2024, 7, 1)
    plat = spark.createDataFrame([("google", d, "c", "a", 1, 1)], "platform string, day date, campaign string, "
                                 "adgroup string, impressions int, clicks int").withColumn("cost", F.lit(1.0))
    ga = spark.createDataFrame([(d, "google", "ppc", "c", "a"), (d, "yahoo", "ppc", "c", "a")],
                               "day date, source string, medium string, campaign string, adgroup string")
    for m in ads.GA_MEASURES:
        ga = ga.withColumn(m, F.lit(1))
    assert ads.platforms_with_ga(plat, ga, match_platform=False).count() == 2
    assert ads.platforms_with_ga(plat, ga, match_platform=True).count() == 1


def _spend(spark, rows):
    return spark.createDataFrame(rows, "account string, currency string, date date, amount_spent double, "
                                 "gacha_attempts double, wins int, treasure_value double")


def test_zero_spend_gives_null_ratio(spark):
    s = _spend(spark, [("a", "X", dt.date(2022, 1, 1), 0.0, 1.0, 0, 5.0), ("b", "X", dt.date(2022, 1, 1), 2.0, 1.0, 0, 1.0)])
    r = {x.account: x.roi for x in account_roi(s).collect()}
    assert r["a"] is None and r["b"] == pytest.approx(0.5)


def test_unparseable_date_is_dropped_from_periods(spark):
    raw = spark.createDataFrame([("a", "X", "2022/12/01", 1.0), ("a", "X", "not a date", 2.0)],
                                "account string, currency string, d string, amount_spent double")
    from tributary.functions import tolerant_date
    s = raw.select("account", "currency", tolerant_date("d", "yyyy/MM/dd").alias("date"), "amount_spent",
                   F.lit(1.0).alias("gacha_attempts"))
    q = quarter_currency(s).collect()
    assert [(r.quarter, r.account) for r in q] == [("2022Q4", 1)]


def test_fuzzy_header_full_width_digit(spark):
    df = spark.createDataFrame([(1, 2)], "`年齢5歳階級` int, `男女別` int")
    assert resolve_columns(df, ["年齢５歳階級", "男女別"]) == ["年齢5歳階級", "男女別"]
    with pytest.raises(KeyError):
        resolve_columns(df, ["completely different"])
