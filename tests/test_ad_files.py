"""Counted facts of the ad platforms' CSV files.  The files are not part of this
repository: their folder comes from the variable AD_CSV_DIR, without it the
test is skipped."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.windows import keep_first
from tributary.plans import ads
from tributary.sources.readers import read_platform_csvs

BASE = os.environ.get("AD_CSV_DIR")
# Rows after dedup, impressions, clicks, cost, rows with a GA match.
FACTS = {"criteo": (92, 4504227, 192695, "45079.14", 33), "facebook": (92, 4432198, 218641, "50537.62", 33),
         "google": (92, 4360663, 238158, "46851.00", 28), "yahoo": (92, 4340098, 211647, "41087.11", 28)}
# GA rows, total users, sessions, engaged sessions, revenue, purchases.
GA = (248, 71180, 105091, 78552, "660060.97", 9412)
MONEY, DAY = T.DecimalType(18, 4), T.DateType()


def _schema(texts, measures):
    fields = [("day", DAY), *((c, T.StringType()) for c in texts), *measures]
    return T.StructType([T.StructField(c, t) for c, t in fields])


@pytest.mark.skipif(not BASE, reason="AD_CSV_DIR is not set")
def test_ad_files_give_the_counted_facts(spark):
    whole = T.IntegerType()
    plat = _schema(["campaign", "adgroup"], [("impressions", whole), ("clicks", whole), ("cost", MONEY)])
    ga_schema = _schema(["utm_source", "utm_medium", "utm_campaign", "utm_content"],
                        [(m, MONEY if m in ("bounce_rate", "purchase_revenue") else whole) for m in ads.GA_MEASURES])
    tables = {}
    for p in FACTS:
        raw = read_platform_csvs(spark, BASE, p, plat)
        assert raw.count() == 154
        tables[p] = keep_first(raw, ads.PLATFORM_KEY, ["src_file", "src_pos"]).drop("src_file", "src_pos")
    ga = keep_first(read_platform_csvs(spark, BASE, "ga", ga_schema), ads.GA_KEY, ["src_file", "src_pos"])
    total = ga.agg(F.count("*"), F.sum("total_users"), F.sum("sessions"), F.sum("engaged_sessions"),
                   F.sum("purchase_revenue"), F.sum("purchases"), F.min("day"), F.max("day")).first()
    assert (*total[:4], total[4], total[5]) == (*GA[:4], Decimal(GA[4]), GA[5])
    assert (str(total[6]), str(total[7])) == ("2024-07-01", "2024-08-31")
    mart = ads.platforms_with_ga(ads.union_platforms(tables), ads.ga_staging(ga))
    got = {r.platform: tuple(r)[1:] for r in mart.groupBy("platform").agg(
        F.count("*"), F.sum("impressions"), F.sum("clicks"), F.sum("cost"), F.count("total_users")).collect()}
    assert got == {p: (n, i, c, Decimal(cost), m) for p, (n, i, c, cost, m) in FACTS.items()}
    loose = ads.platforms_with_ga(ads.union_platforms(tables), ads.ga_staging(ga), match_platform=False)
    assert loose.count() == mart.count() == 368 and loose.where("total_users IS NOT NULL").count() == 122
