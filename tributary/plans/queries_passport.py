"""Public-statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import percent_number, text_number
from tributary.operators.joins import ratio_join
from tributary.operators.reshape import resolve_columns
from tributary.plans import passport as P
from tributary.plans.catalog import query, table

_CITY_VALUES = ", ".join(f"({i}, '{c}', '{e}')" for i, (c, e) in enumerate(P.CITY_MAP))


@query("melt_category", sql="""
WITH c AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS general_5_years,
                  count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS general_10_years,
                  count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS information_changing,
                  count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS diplomatic,
                  count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS official
           FROM orders GROUP BY 1, 2)
SELECT year, month, category, CAST(application AS BIGINT) AS application FROM (
  UNPIVOT c ON general_5_years, general_10_years, information_changing, diplomatic, official
  INTO NAME category VALUE application)""")
def melt_category(spark, sf):
    return P.clean_category(P.category_wide(table(spark, sf, "orders")))


@query("melt_age", sql="""
WITH a AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
                  CASE WHEN l_quantity < 20 THEN 'under_19' WHEN l_quantity < 30 THEN '20-29'
                       WHEN l_quantity < 40 THEN '30-39' WHEN l_quantity < 50 THEN '40-49'
                       WHEN l_quantity < 60 THEN '50-59' WHEN l_quantity < 70 THEN '60-69'
                       WHEN l_quantity < 80 THEN '70-79' ELSE 'over_80' END AS age_group,
                  l_extendedprice / 1000 AS v FROM lineitem)
SELECT year, month, age_group, CAST(round_even(sum(v), 0) AS BIGINT) AS application
FROM a GROUP BY 1, 2, 3""")
def melt_age(spark, sf):
    return P.clean_age(P.age_wide(table(spark, sf, "lineitem")))


@query("melt_gender", sql="""
WITH g AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                  count(*) FILTER (WHERE o_orderstatus = 'F') AS male,
                  count(*) FILTER (WHERE o_orderstatus = 'O') AS female FROM orders GROUP BY 1, 2)
SELECT year, month, gender, CAST(application AS BIGINT) AS application FROM (
  UNPIVOT g ON male, female INTO NAME gender VALUE application)""")
def melt_gender(spark, sf):
    return P.clean_gender(P.gender_sheet(table(spark, sf, "orders")))


@query("melt_city", sql=f"""
WITH cm AS (SELECT * FROM (VALUES {_CITY_VALUES}) AS t(k, city, city_en)),
j AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
             CASE WHEN c_nationkey = 24 THEN '不明県' ELSE coalesce(cm.city_en, cm.city) END AS city
      FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN cm ON c_nationkey = cm.k)
SELECT year, month, city, CAST(count(*) AS BIGINT) AS application FROM j GROUP BY 1, 2, 3""")
def melt_city(spark, sf):
    return P.clean_city(spark, P.city_sheet(spark, table(spark, sf, "orders"), table(spark, sf, "customer")))


@query("melt_age_city", sql=f"""
WITH cm AS (SELECT * FROM (VALUES {_CITY_VALUES}) AS t(k, city, city_en)),
j AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year,
             CASE WHEN c_nationkey = 24 THEN '不明県' ELSE coalesce(cm.city_en, cm.city) END AS city,
             CASE WHEN l_quantity < 20 THEN 'under_19' WHEN l_quantity < 30 THEN '20-29'
                  WHEN l_quantity < 40 THEN '30-39' WHEN l_quantity < 50 THEN '40-49'
                  WHEN l_quantity < 60 THEN '50-59' WHEN l_quantity < 70 THEN '60-69'
                  WHEN l_quantity < 80 THEN '70-79' ELSE 'over_80' END AS age_group
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           LEFT JOIN cm ON c_nationkey = cm.k)
SELECT year, city, age_group, CAST(count(*) AS DOUBLE) AS application FROM j GROUP BY 1, 2, 3""")
def melt_age_city(spark, sf):
    sheet = P.age_city_sheet(spark, table(spark, sf, "lineitem"), table(spark, sf, "orders"),
                             table(spark, sf, "customer"))
    return P.clean_age_city(spark, sheet)


@query("total_row", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def total_row(spark, sf):
    return P.valid_total(P.valid_sheet(table(spark, sf, "orders"), table(spark, sf, "nation"),
                                       table(spark, sf, "customer")))


_POP_SQL = """
pop AS (
  SELECT CASE l_returnflag WHEN 'A' THEN '男' WHEN 'N' THEN '女' ELSE '男女計' END AS sex,
         CASE WHEN l_linestatus = 'O' THEN '総人口' ELSE '日本人人口' END AS population,
         CAST(CAST(floor((l_quantity - 1) / 5) * 5 AS INTEGER) AS VARCHAR) AS lo,
         strftime(l_shipdate, '%Y00%m%m') AS time_code, l_quantity AS value
  FROM lineitem),
b AS (SELECT sex, time_code, value,
             CASE WHEN CAST(lo AS INTEGER) < 20 THEN 'under_19' WHEN CAST(lo AS INTEGER) >= 80 THEN 'over_80'
                  ELSE CAST(CAST(lo AS INTEGER) // 10 * 10 AS VARCHAR) || '-' || CAST(CAST(lo AS INTEGER) // 10 * 10 + 9 AS VARCHAR)
             END AS age_group
      FROM pop WHERE sex <> '男女計' AND population <> '総人口')"""


@query("population_bands", sql=f"""WITH {_POP_SQL}
SELECT CAST(substr(time_code, 1, 4) AS INTEGER) AS year, CAST(substr(time_code, 7, 2) AS INTEGER) AS month,
       CASE sex WHEN '男' THEN 'male' WHEN '女' THEN 'female' END AS gender, age_group AS age, sum(value) AS value
FROM b GROUP BY 1, 2, 3, 4""")
def population_bands(spark, sf):
    return P.population_bands(spark, P.population_long(table(spark, sf, "lineitem")))


_YOY_SQL = """
m AS (SELECT CAST(floor((year(o_orderdate) - 1995) / 3) AS INTEGER) AS file, year(o_orderdate) AS year,
             month(o_orderdate) AS month, sum(o_totalprice) / 1e6 AS value_k FROM orders GROUP BY 1, 2, 3),
f AS (SELECT file, max(CASE WHEN year = 1998 THEN 1 ELSE 0 END) AS has FROM m GROUP BY 1),
yoy AS (SELECT CAST(m.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month, CAST(trunc(value_k * 1000) AS BIGINT) AS value
        FROM m JOIN f USING (file)
        WHERE CASE WHEN has = 1 THEN m.month = 10 ELSE m.month = 12 END AND m.year >= 1996)"""


@query("population_yoy", sql=f"WITH {_YOY_SQL} SELECT * FROM yoy")
def population_yoy(spark, sf):
    return P.population_yoy(table(spark, sf, "orders"))


@query("holding_rate", sql=f"""WITH {_YOY_SQL},
v AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS total
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT year, total, yoy.month, yoy.value, round_even(total / nullif(yoy.value, 0), 9) AS holding_rate
FROM v JOIN yoy USING (year)""")
def holding_rate(spark, sf):
    v = P.valid_total(P.valid_sheet(table(spark, sf, "orders"), table(spark, sf, "nation"),
                                    table(spark, sf, "customer")))
    y = P.population_yoy(table(spark, sf, "orders"))
    r = ratio_join(v, y, "year", "total", "value", "holding_rate")
    return r.withColumn("holding_rate", F.bround("holding_rate", 9))


@query("text_numbers", sql="""
SELECT o_orderkey, round_even(o_totalprice, 2) AS amount, round_even(o_totalprice / 1000, 5) AS rate
FROM orders""")
def text_numbers(spark, sf):
    o = table(spark, sf, "orders")
    txt = o.select("o_orderkey", F.format_number("o_totalprice", 2).alias("amount_text"),
                   F.concat(F.format_number(F.col("o_totalprice") / 1000, 5), F.lit("%")).alias("rate_text"))
    return txt.select("o_orderkey", text_number("amount_text", "double").alias("amount"),
                      percent_number("rate_text").alias("rate"))


@query("fuzzy_columns", sql="SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def fuzzy_columns(spark, sf):
    o = table(spark, sf, "orders")
    cols = resolve_columns(o, ["o_orderkey", "o_totalprise", "o_order_date"])
    return o.drop("no_such_column").select(*cols)
