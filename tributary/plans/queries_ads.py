"""Ad-performance, load and check queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tributary.operators import checks, load
from tributary.operators.keyed_table import KeyedTable
from tributary.plans import ads
from tributary.plans.catalog import ORACLE, query, table
from tributary.session import checkpoint_dir

_AD_SQL = """
ad AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook' WHEN '2-HIGH' THEN 'google'
              WHEN '3-MEDIUM' THEN 'yahoo' WHEN '4-NOT SPECIFIED' THEN 'criteo' END AS platform,
         CAST(o_orderdate AS DATE) AS day,
         'camp_' || o_orderstatus AS campaign,
         'ag_' || CAST(o_custkey % 5 AS VARCHAR) AS adgroup,
         CAST(trunc(o_totalprice) AS INTEGER) AS impressions,
         CAST(o_orderkey % 1000 AS INTEGER) AS clicks,
         CAST(o_totalprice / 100 AS DECIMAL(18,4)) AS cost,
         o_orderkey AS src_order
  FROM orders),
raw AS (
  SELECT platform, day, campaign, adgroup, impressions, clicks, cost FROM ad
  WHERE platform IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY platform, day, campaign, adgroup ORDER BY src_order) = 1)"""

_GA_SQL = """
ga AS (
  SELECT CAST(o_orderdate AS DATE) AS day,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook' WHEN '2-HIGH' THEN 'google'
              WHEN '3-MEDIUM' THEN 'yahoo' WHEN '4-NOT SPECIFIED' THEN 'criteo' END AS utm_source,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'social' WHEN '2-HIGH' THEN 'ppc'
              WHEN '3-MEDIUM' THEN 'ppc' WHEN '4-NOT SPECIFIED' THEN 'display' END AS utm_medium,
         'camp_' || o_orderstatus AS utm_campaign,
         'ag_' || CAST(o_custkey % 5 AS VARCHAR) AS utm_content,
         CAST(count(*) AS INTEGER) AS total_users,
         CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS INTEGER) AS first_time_purchasers,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS new_users,
         round_even(avg(l_discount), 6) AS bounce_rate,
         CAST(trunc(sum(l_quantity)) AS INTEGER) AS sessions,
         CAST(trunc(sum(CASE WHEN l_discount < 0.05 THEN l_quantity END)) AS INTEGER) AS engaged_sessions,
         round_even(sum(l_extendedprice), 2) AS purchase_revenue,
         CAST(count(DISTINCT l_orderkey) AS INTEGER) AS purchases
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
  GROUP BY ALL),
ga_stg AS (
  SELECT day, utm_source AS source, utm_medium AS medium, utm_campaign AS campaign, utm_content AS adgroup,
         total_users, first_time_purchasers, new_users, bounce_rate, sessions, engaged_sessions,
         purchase_revenue, purchases
  FROM ga)"""


def _raw(spark, sf):
    return ads.platform_raw(table(spark, sf, "orders"))


def _ga(spark, sf):
    return ads.ga_raw(table(spark, sf, "lineitem"), table(spark, sf, "orders"))


@query("ads_first_wins", sql=f"WITH {_AD_SQL} SELECT * FROM raw")
def ads_first_wins(spark, sf):
    return _raw(spark, sf)


@query("ads_union", sql=f"""
WITH {_AD_SQL}
SELECT day, campaign, adgroup, impressions, clicks, cost, 'criteo' AS platform FROM raw WHERE platform = 'criteo'
UNION ALL SELECT day, campaign, adgroup, impressions, clicks, cost, 'facebook' FROM raw WHERE platform = 'facebook'
UNION ALL SELECT day, campaign, adgroup, impressions, clicks, cost, 'google' FROM raw WHERE platform = 'google'
UNION ALL SELECT day, campaign, adgroup, impressions, clicks, cost, 'yahoo' FROM raw WHERE platform = 'yahoo'""")
def ads_union(spark, sf):
    return ads.all_platforms(_raw(spark, sf))  # one scan of the stacked table


@query("ads_ga_staging", sql=f"WITH {_GA_SQL} SELECT * FROM ga_stg")
def ads_ga_staging(spark, sf):
    return ads.ga_staging(_ga(spark, sf))


@query("ads_with_ga", sql=f"""
WITH {_AD_SQL}, {_GA_SQL}
SELECT p.platform, p.day, p.campaign, p.adgroup, p.impressions, p.clicks, p.cost,
       g.total_users, g.first_time_purchasers, g.new_users, g.bounce_rate, g.sessions,
       g.engaged_sessions, g.purchase_revenue, g.purchases
FROM raw p LEFT JOIN ga_stg g
  ON p.day = g.day AND p.campaign = g.campaign AND p.adgroup = g.adgroup AND p.platform = g.source""")
def ads_with_ga(spark, sf):
    return ads.platforms_with_ga(ads.all_platforms(_raw(spark, sf)), ads.ga_staging(_ga(spark, sf)))


@query("load_append_above_max", sql="""
WITH target AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
new AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
SELECT * FROM target
UNION ALL
SELECT * FROM new WHERE (SELECT max(o_orderdate) FROM target) IS NULL
                     OR o_orderdate > (SELECT max(o_orderdate) FROM target)""")
def load_append_above_max(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    target = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    new = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return load.append_above_watermark(target, new, "o_orderdate")


@query("load_upsert", sql="""
WITH upd AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)
SELECT coalesce(t.c_custkey, u.c_custkey) AS c_custkey,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_name ELSE u.c_name END AS c_name,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_nationkey ELSE u.c_nationkey END AS c_nationkey,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE u.c_mktsegment END AS c_mktsegment
FROM customer t FULL JOIN upd u ON t.c_custkey = u.c_custkey""")
def load_upsert(spark, sf):
    c, upd = _customer_update(spark, sf)
    return load.upsert(c, upd, ["c_custkey"], update_cols=["c_acctbal"])


def _customer_update(spark, sf):
    c = table(spark, sf, "customer")
    s = table(spark, sf, "supplier")
    upd = c.filter(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 100) \
        .unionByName(s.select((F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
                              F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
                              F.lit("SUPPLIER").alias("c_mktsegment")))
    return c, upd


@query("keyed_table_upsert", sql=ORACLE["load_upsert"])
def keyed_table_upsert(spark, sf):
    """K2/K3 on a keyed table: the load is a delta, committed twice under one
    number (the second does nothing), merged when read."""
    c, upd = _customer_update(spark, sf)
    t = KeyedTable(spark, f"{checkpoint_dir(spark).rstrip('/')}/loads/{uuid.uuid4().hex}", ["c_custkey"])
    t.replace(c)
    for _ in range(2):
        t.upsert(upd, update_cols=["c_acctbal"], load=("customer", 1))
    return t.read()


@query("load_delete_insert", sql="""
WITH new AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate
             FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders t
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.o_custkey = t.o_custkey AND n.o_orderdate = t.o_orderdate)
UNION ALL SELECT * FROM new""")
def load_delete_insert(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    new = o.filter(F.col("o_orderstatus") == "O").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return load.delete_insert(o, new, ["o_custkey", "o_orderdate"])


# The key of each driver table.
TABLE_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


def _checks_sql():
    parts = []
    for t, keys in TABLE_KEYS.items():
        for k in keys:
            parts.append(f"SELECT 'not_null' AS \"check\", '{t}' AS table_name, '{k}' AS column_name, "
                         f"CAST(count(*) FILTER (WHERE {k} IS NULL) AS BIGINT) AS failing_rows FROM {t}")
        kl = ", ".join(keys)
        parts.append(f"SELECT 'unique', '{t}', '{','.join(keys)}', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
                     f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {kl}) WHERE n > 1")
        parts.append(f"SELECT 'not_empty', '{t}', '*', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM {t}")
    return "\nUNION ALL\n".join(parts)


@query("checks_report", sql=_checks_sql())
def checks_report(spark, sf):
    parts = []
    for t, keys in TABLE_KEYS.items():
        df = table(spark, sf, t)
        parts.append(checks.table_report(df, t, keys, keys))
    return checks.check_report(parts)


@query("duplicate_report", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R' UNION ALL
  SELECT l_orderkey, NULL, l_partkey, l_suppkey, l_shipdate FROM lineitem WHERE l_returnflag = 'A')
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate) > 1""")
def duplicate_report(spark, sf):
    """J4 over the lines, a third of them loaded twice and a third with a null key."""
    t = table(spark, sf, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    no_number = t.filter(F.col("l_returnflag") == "A") \
                 .withColumn("l_linenumber", F.lit(None).cast(t.schema["l_linenumber"].dataType))
    li = t.select(cols).unionByName(t.filter(F.col("l_returnflag") == "R").select(cols)).unionByName(no_number.select(cols))
    return checks.duplicate_rows(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate"]) \
        .drop("l_shipdate")
