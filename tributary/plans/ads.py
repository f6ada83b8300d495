"""Ad-performance marts (G1, C1, B2, B3, E4, K1, K2) and their inputs.

Stand-ins from the driver tables: each order is an ad row; its priority
names the platform, its status the campaign and its customer (mod 5) the
ad group.  GA rows are lineitem measures per (day, platform, campaign, ad
group).  Raw platform tables are keyed by (day, campaign, adgroup), first
row wins (the loader's drop_duplicates), ordered by order key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.windows import keep_first

# Platforms, which order priority stands for each, and the
# GA source/medium pairs the platforms appear under.
PLATFORMS = ["criteo", "facebook", "google", "yahoo"]
PRIORITY_OF = {"facebook": "1-URGENT", "google": "2-HIGH", "yahoo": "3-MEDIUM",
               "criteo": "4-NOT SPECIFIED"}
GA_MEDIUM = {"google": "ppc", "yahoo": "ppc", "facebook": "social", "criteo": "display"}
PLATFORM_KEY = ["day", "campaign", "adgroup"]
GA_KEY = ["day", "utm_source", "utm_medium", "utm_campaign", "utm_content"]
AD_GROUPS = 5


def _platform_of(priority: Column) -> Column:
    c = None
    for p, pr in PRIORITY_OF.items():
        c = (F.when(priority == pr, F.lit(p)) if c is None else c.when(priority == pr, F.lit(p)))
    return c


def ad_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        _platform_of(F.col("o_orderpriority")).alias("platform"),
        F.to_date("o_orderdate").alias("day"),
        F.concat(F.lit("camp_"), F.col("o_orderstatus")).alias("campaign"),
        F.concat(F.lit("ag_"), F.pmod(F.col("o_custkey"), F.lit(AD_GROUPS)).cast("string")).alias("adgroup"),
        F.col("o_totalprice").cast("int").alias("impressions"),
        F.pmod(F.col("o_orderkey"), F.lit(1000)).cast("int").alias("clicks"),
        (F.col("o_totalprice") / 100).cast("decimal(18,4)").alias("cost"),
        F.col("o_orderkey").alias("src_order"),
    ).filter(F.col("platform").isNotNull())


def platform_raw(orders: DataFrame) -> DataFrame:
    """Raw platform tables, stacked (A1 stand-in) and de-duplicated on the
    key within each platform (E4): first row by source order wins."""
    return keep_first(ad_rows(orders), ["platform", *PLATFORM_KEY], ["src_order"]).drop("src_order")


def platform_staging(raw: DataFrame, platform: str) -> DataFrame:
    """B2: pass-through staging of one platform."""
    return raw.filter(F.col("platform") == platform).drop("platform")


def union_platforms(tables: dict[str, DataFrame]) -> DataFrame:
    """G1: union of separate platform tables by column name, tagged with
    the platform (the reference loses the origin)."""
    parts = [t.withColumn("platform", F.lit(p)) for p, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def all_platforms(raw: DataFrame, stacked: bool = True) -> DataFrame:
    """G1 over the stacked raw table: the union of the four platform
    stagings is the stacked table restricted to the platforms (one scan).
    ``stacked=False`` builds it as the union of per-platform stagings, as
    for separate tables."""
    if stacked:
        return raw.filter(F.col("platform").isin(PLATFORMS)).select(*PLATFORM_KEY, "impressions", "clicks",
                                                                    "cost", "platform")
    return union_platforms({p: platform_staging(raw, p) for p in PLATFORMS})


def ga_raw(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """GA rows: lineitem measures per (day, source, medium, campaign, content)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                      _platform_of(F.col("o_orderpriority")).alias("src"))
    o = o.filter(F.col("src").isNotNull())
    li = lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    medium = F.create_map(*[x for p, m in GA_MEDIUM.items() for x in (F.lit(p), F.lit(m))])
    return j.groupBy(
        F.to_date("o_orderdate").alias("day"),
        F.col("src").alias("utm_source"),
        medium[F.col("src")].alias("utm_medium"),
        F.concat(F.lit("camp_"), F.col("o_orderstatus")).alias("utm_campaign"),
        F.concat(F.lit("ag_"), F.pmod(F.col("o_custkey"), F.lit(AD_GROUPS)).cast("string")).alias("utm_content"),
    ).agg(
        F.count("*").cast("int").alias("total_users"),
        F.count_if(F.col("l_returnflag") == "N").cast("int").alias("first_time_purchasers"),
        F.count_if(F.col("l_returnflag") == "R").cast("int").alias("new_users"),
        F.bround(F.avg("l_discount"), 6).alias("bounce_rate"),
        F.sum("l_quantity").cast("int").alias("sessions"),
        F.sum(F.when(F.col("l_discount") < 0.05, F.col("l_quantity"))).cast("int").alias("engaged_sessions"),
        F.bround(F.sum("l_extendedprice"), 2).alias("purchase_revenue"),
        F.count_distinct("l_orderkey").cast("int").alias("purchases"),
    )


def ga_staging(ga: DataFrame) -> DataFrame:
    """utm_* renamed to the platform vocabulary."""
    return ga.withColumnsRenamed({"utm_source": "source", "utm_medium": "medium",
                                  "utm_campaign": "campaign", "utm_content": "adgroup"})


GA_MEASURES = ["total_users", "first_time_purchasers", "new_users", "bounce_rate", "sessions",
               "engaged_sessions", "purchase_revenue", "purchases"]


def platforms_with_ga(platforms: DataFrame, ga_stg: DataFrame, match_platform: bool = True) -> DataFrame:
    """Every platform row with its GA measures (left join on day,
    campaign, ad group).  ``match_platform`` also requires GA's source to
    be the row's platform, so two sources sharing a campaign/ad group do
    not multiply rows; ``False`` gives the reference's join."""
    g = ga_stg.select(*PLATFORM_KEY, "source", *GA_MEASURES)
    on = [platforms[k] == g[k] for k in PLATFORM_KEY]
    if match_platform:
        on.append(platforms["platform"] == g["source"])
    j = platforms.join(g, on=on, how="left")
    return j.select(*[platforms[c] for c in ["platform", *PLATFORM_KEY, "impressions", "clicks", "cost"]],
                    *[g[c] for c in GA_MEASURES])


def refresh_marts(spark, raw: DataFrame, ga_stg: DataFrame, mart_base: str) -> dict[str, str]:
    """SURVEY 3.2 after the load: each platform mart grows by the rows above
    its own ``max(day)`` (K1; an empty mart takes everything), then the
    combined mart with GA is rebuilt in full (K5, staged and swapped).
    Returns the written paths."""
    from tributary.operators.load import create_if_missing, materialize, rows_above_watermark
    paths = {}
    for p in PLATFORMS:
        path = f"{mart_base.rstrip('/')}/fct_{p}"
        stg = platform_staging(raw, p)
        cur = create_if_missing(spark, path, stg.schema)
        materialize(spark, rows_above_watermark(cur, stg, "day"), path, mode="append")
        paths[p] = path
    marts = union_platforms({p: spark.read.parquet(paths[p]) for p in PLATFORMS})
    combined = f"{mart_base.rstrip('/')}/fct_all_platform_with_ga"
    materialize(spark, platforms_with_ga(marts, ga_stg), combined)
    paths["all"] = combined
    return paths
