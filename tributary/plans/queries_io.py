"""Source, sink, load and date-text queries (A1-A4, A6, A9-A11, A13, H8, H23,
H26, J5, K5, K6).  Written files go under the session's shared checkpoint
folder and are read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import date_text, hour_of_text, n_days_ago, n_months_ago, n_weeks_ago, time_text, yesterday
from tributary.operators import load
from tributary.operators.keyed_table import KeyedTable
from tributary.operators.windows import keep_first
from tributary.plans import ads, passport as P
from tributary.plans.catalog import query, table
from tributary.plans.queries_ads import _AD_SQL, _GA_SQL
from tributary.session import checkpoint_dir
from tributary.sources import readers as R
from tributary.sources import sinks as W
from tributary.streaming.ingest import JSON_OPTIONS, keyed_json


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/files/{uuid.uuid4().hex}"


@query("typed_csv", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def typed_csv(spark, sf):
    base = _scratch(spark)
    c = table(spark, sf, "customer")
    W.export_sorted_csv(c, base, ["c_custkey"], bom=True)
    return R.read_typed_csv(spark, base, c.schema)


@query("file_year", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice FROM orders""")
def file_year(spark, sf):
    base = _scratch(spark)
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice")
    o.write.partitionBy("year").option("header", True).csv(base)
    df = R.read_with_file_value(spark, f"{base}/*/*.csv", "csv", "year", r"year=(\d+)/",
                                schema="o_orderkey long, o_totalprice double")
    return df


@query("export_csv", sql="""
WITH c AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS general_5_years,
                  count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS general_10_years,
                  count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS information_changing,
                  count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS diplomatic,
                  count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS official
           FROM orders GROUP BY 1, 2)
SELECT CAST(year AS INTEGER) AS year, month, category, CAST(application AS BIGINT) AS application FROM (
  UNPIVOT c ON general_5_years, general_10_years, information_changing, diplomatic, official
  INTO NAME category VALUE application)""")
def export_csv(spark, sf):
    base = _scratch(spark)
    long = P.clean_category(P.category_wide(table(spark, sf, "orders")))
    W.export_sorted_csv(long, base, [F.col("year").desc_nulls_last(), F.col("month").desc_nulls_last()],
                        bom=True, single_file=False)
    return R.read_typed_csv(spark, base, "year int, month int, category string, application long")


@query("export_json", sql="SELECT doc_id, lang, source, text FROM documents")
def export_json(spark, sf):
    base = _scratch(spark)
    W.export_json(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"), base)
    return spark.read.schema("doc_id long, lang string, source string, text string").json(base)


@query("create_missing", sql="""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def create_missing(spark, sf):
    """The first call creates an empty table, the second leaves it; two
    appends then give the rows twice."""
    base = _scratch(spark)
    s = table(spark, sf, "supplier")
    load.create_if_missing(spark, base, s.schema)
    load.create_if_missing(spark, base, s.schema)
    load.materialize(spark, s, base, mode="append")
    load.materialize(spark, s, base, mode="append")
    return spark.read.parquet(base)


@query("full_refresh", sql="SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def full_refresh(spark, sf):
    """K5: a full rebuild committed twice equals one; the second names the
    version it replaces, and a reader of the first is not disturbed."""
    t = KeyedTable(spark, _scratch(spark))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = t.replace(o)
    t.replace(t.read(), expected=first)
    return t.read()


PLATFORM_SCHEMA = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("campaign", T.StringType()),
    T.StructField("adgroup", T.StringType()), T.StructField("impressions", T.IntegerType()),
    T.StructField("clicks", T.IntegerType()), T.StructField("cost", T.DecimalType(18, 4))])


def _write_platform_files(spark, sf, base):
    """Two overlapping CSV exports per platform with spreadsheet-style headers; the second has
    its columns in another order and its counts as decimals (``377.0``)."""
    rows = ads.ad_rows(table(spark, sf, "orders"))
    for p in ads.PLATFORMS:
        r = rows.filter(F.col("platform") == p)
        for i, (lo, hi) in enumerate([("1990-01-01", "1998-12-31"), ("1997-01-01", "2100-01-01")]):
            part = r.filter(F.col("day").between(lo, hi)).orderBy("src_order").drop("platform", "src_order")
            if i == 1:
                part = part.withColumn("impressions", F.concat(F.col("impressions").cast("string"), F.lit(".0")))
                part = part.select(*reversed(part.columns))
            part = part.toDF(*[c.replace("_", " ").capitalize() for c in part.columns])
            part.write.option("header", True).csv(f"{base}/{p}/{p}_fake_data_{i}.csv")


@query("ads_csv_load", sql=f"""WITH {_AD_SQL} SELECT * FROM raw""")
def ads_csv_load(spark, sf):
    """Platform CSV files stacked per platform, headers
    normalised, first row per key kept in (file, position) order."""
    base = _scratch(spark)
    _write_platform_files(spark, sf, base)
    parts = []
    for p in ads.PLATFORMS:
        df = R.read_platform_csvs(spark, base, p, PLATFORM_SCHEMA)
        if df is None:
            continue
        parts.append(keep_first(df, ads.PLATFORM_KEY, ["src_file", "src_pos"]).drop("src_file", "src_pos")
                     .withColumn("platform", F.lit(p)))
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d)
    return out.select("platform", *ads.PLATFORM_KEY, "impressions", "clicks", "cost")


@query("load_summary", sql=f"""WITH {_AD_SQL}, {_GA_SQL}
SELECT platform AS source, CAST(count(*) AS BIGINT) AS rows, CAST(1 AS BIGINT) AS version, false AS failed FROM raw GROUP BY 1
UNION ALL SELECT 'ga', CAST(count(*) AS BIGINT), 1, false FROM ga
UNION ALL SELECT 'tiktok', NULL, 0, true""")
def load_summary(spark, sf):
    """K6: every source loaded at the same time into its own keyed table, twice
    (the second load is a repeat); one broken source is reported and stops none."""
    base = _scratch(spark)
    rows = ads.ad_rows(table(spark, sf, "orders"))
    sources = {p: load.Source(lambda p=p: rows.filter(F.col("platform") == p).drop("platform"), ads.PLATFORM_KEY, ["src_order"]) for p in ads.PLATFORMS}
    sources["ga"] = load.Source(lambda: ads.ga_raw(table(spark, sf, "lineitem"), table(spark, sf, "orders")), ads.GA_KEY)
    sources["tiktok"] = load.Source(lambda: spark.read.parquet(f"{base}/missing"), ["day"])
    for _ in range(2):
        rep = load.load_sources(spark, sources, f"{base}/tables", number=1)
    return rep.select("source", "rows", "version", F.col("error").isNotNull().alias("failed"))


@query("key_value_json")
def key_value_json(spark, sf):
    """(key, JSON value) records."""
    return keyed_json(table(spark, sf, "events"), "event_id")


@query("key_value_fields", sql="""
SELECT CAST(event_id AS VARCHAR) AS key, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events""")
def key_value_fields(spark, sf):
    """The records' JSON parsed back: key and every field as in the table."""
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    records = keyed_json(e, "event_id")
    fields = F.from_json("value", e.schema, JSON_OPTIONS)
    return records.select("key", fields.alias("r")).select("key", "r.event_id", F.date_format("r.ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                                                           "r.user_id", "r.event_type", "r.value", "r.props")


@query("column_subset", sql="""
SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND n_chars > 1000""")
def column_subset(spark, sf):
    return R.read_columns(spark, f"{sf.rstrip('/')}/documents.parquet", ["doc_id", "n_chars", "lang"],
                          (F.col("lang") == "en") & (F.col("n_chars") > 1000)).drop("lang")


@query("relative_dates", sql="""
WITH d AS (SELECT event_id, CAST(ts AS DATE) AS d FROM events)
SELECT event_id, d = DATE '2024-01-20' - INTERVAL 1 DAY AS is_yesterday,
       d >= DATE '2024-01-20' - INTERVAL 3 DAY AS in_3_days,
       d >= DATE '2024-01-20' - INTERVAL 14 DAY AS in_2_weeks,
       d >= DATE '2024-01-20' - INTERVAL 1 MONTH AS in_month
FROM d""")
def relative_dates(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("d"))
    a = "2024-01-20"
    return e.select("event_id", (F.col("d") == yesterday(a)).alias("is_yesterday"),
                    (F.col("d") >= n_days_ago(3, a)).alias("in_3_days"),
                    (F.col("d") >= n_weeks_ago(2, a)).alias("in_2_weeks"),
                    (F.col("d") >= n_months_ago(1, a)).alias("in_month"))


@query("timestamp_text", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_text, strftime(ts, '%H:%M:%S.%g') AS time_text,
       strftime(ts, '%Y-%m-%d_%H:%M:%S') AS published_text, CAST(hour(ts) AS INTEGER) AS hour FROM events""")
def timestamp_text(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", date_text("ts").alias("date_text"), time_text("ts").alias("time_text"),
                    date_text("ts", "yyyy-MM-dd_HH:mm:ss").alias("published_text"),
                    hour_of_text(time_text("ts"), "HH:mm:ss.SSS").alias("hour"))


@query("upsert_audit", sql="""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
       true AS created_kept, c_acctbal < 0 AS touched FROM customer""")
def upsert_audit(spark, sf):
    """created_at set on insert only, updated_at on every load; the
    stamps themselves depend on the clock, so the result says which changed."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    then, now = F.lit("2024-01-01 00:00:00").cast("timestamp"), F.current_timestamp()
    target = c.withColumn("created_at", then).withColumn("updated_at", then)
    upd = c.filter(F.col("c_acctbal") < 0).select("c_custkey", F.lit(0.0).alias("c_acctbal"),
                                                  now.alias("created_at"), now.alias("updated_at"))
    out = load.upsert(target, upd, ["c_custkey"], update_cols=["c_acctbal", "updated_at"])
    return out.select("c_custkey", "c_acctbal", (F.col("created_at") == then).alias("created_kept"),
                      (F.col("updated_at") > F.col("created_at")).alias("touched"))


@query("load_partition_replace", sql="""
WITH new AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate,
                    CAST(year(o_orderdate) AS INTEGER) AS year
             FROM orders WHERE o_orderstatus = 'O' AND year(o_orderdate) = 1996),
t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year
      FROM orders)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.o_custkey = t.o_custkey AND n.o_orderdate = t.o_orderdate)
UNION ALL SELECT * FROM new""")
def load_partition_replace(spark, sf):
    """K4 with date-led keys on a year-partitioned table: only the touched
    partition is read, rebuilt and swapped."""
    base = _scratch(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                          F.year("o_orderdate").alias("year"))
    o.write.partitionBy("year").parquet(base)
    new = o.filter((F.col("o_orderstatus") == "O") & (F.col("year") == 1996)) \
           .withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replaced = load.replace_partitions(spark, new, base, ["o_custkey", "o_orderdate"], "year")
    assert replaced == ["year=1996"], replaced
    return spark.read.parquet(base).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                           "o_orderdate", F.col("year").cast("int").alias("year"))


@query("ads_marts_incremental", sql=f"""WITH {_AD_SQL}
SELECT platform, day, campaign, adgroup, impressions, clicks, cost FROM raw""")
def ads_marts_incremental(spark, sf):
    """K1/K5 in the ad lifecycle: two loads (days up to 1997, then all);
    the platform marts append only days above their maximum, the combined
    mart is rebuilt; the result is the combined mart's platform columns."""
    base = _scratch(spark)
    raw = ads.platform_raw(table(spark, sf, "orders"))
    ga = ads.ga_staging(ads.ga_raw(table(spark, sf, "lineitem"), table(spark, sf, "orders")))
    ads.refresh_marts(spark, raw.filter(F.col("day") <= F.lit("1997-12-31").cast("date")), ga, base)
    paths = ads.refresh_marts(spark, raw, ga, base)
    return spark.read.parquet(paths["all"]).select("platform", *ads.PLATFORM_KEY, "impressions", "clicks", "cost")
