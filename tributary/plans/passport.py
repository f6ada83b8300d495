"""Public-statistics cleaning flows (L1-L6, B8, B9, B14-B19, D16, H9-H13,
H21, H24, C9) over wide stand-in tables built from the driver tables.

Each "file" is a year; the wide shapes imitate the spreadsheets: months
as rows and categories, age groups or sexes as columns, or cities as rows
and months as columns, with title, subtotal and total rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import remove_literals
from tributary.operators.joins import map_join
from tributary.operators.reshape import from_first_match, melt, per_file_choice, rename_by_position

# Output vocabularies of the cleaning flows.
CATEGORIES = ["general_5_years", "general_10_years", "information_changing", "subtotal",
              "diplomatic", "official", "subtotal2", "total"]
AGE_GROUPS = ["under_19", "20-29", "30-39", "40-49", "50-59", "60-69", "70-79", "over_80"]
GENDERS = ["male", "female", "total"]
# Prefecture names and their romanisation.
CITY_MAP = [
    ("北海道", "Hokkaido"), ("青森", "Aomori"), ("岩手", "Iwate"), ("宮城", "Miyagi"), ("秋田", "Akita"),
    ("山形", "Yamagata"), ("福島", "Fukushima"), ("茨城", "Ibaraki"), ("栃木", "Tochigi"), ("群馬", "Gunma"),
    ("埼玉", "Saitama"), ("千葉", "Chiba"), ("東京", "Tokyo"), ("神奈川", "Kanagawa"), ("新潟", "Niigata"),
    ("富山", "Toyama"), ("石川", "Ishikawa"), ("福井", "Fukui"), ("山梨", "Yamanashi"), ("長野", "Nagano"),
    ("岐阜", "Gifu"), ("静岡", "Shizuoka"), ("愛知", "Aichi"), ("三重", "Mie"), ("滋賀", "Shiga"),
    ("京都", "Kyoto"), ("大阪", "Osaka"), ("兵庫", "Hyogo"), ("奈良", "Nara"), ("和歌山", "Wakayama"),
    ("鳥取", "Tottori"), ("島根", "Shimane"), ("岡山", "Okayama"), ("広島", "Hiroshima"), ("山口", "Yamaguchi"),
    ("徳島", "Tokushima"), ("香川", "Kagawa"), ("愛媛", "Ehime"), ("高知", "Kochi"), ("福岡", "Fukuoka"),
    ("佐賀", "Saga"), ("長崎", "Nagasaki"), ("熊本", "Kumamoto"), ("大分", "Oita"), ("宮崎", "Miyazaki"),
    ("鹿児島", "Kagoshima"), ("沖縄", "Okinawa"),
]
# total/subtotal labels and the ministry row.
TOTAL_LABELS = ["計", "外務省", "合計"]
SUBTOTAL_WORD = "小計"
GRAND_TOTAL = "合計"
GENDER_MAP = [("男", "male"), ("女", "female")]
AGE_WORDS = ["歳", "（再掲）", "うち"]
EXCLUDED_AGE_GROUPS = ["総数", "15未満", "15～64", "65以上", "75以上", "85以上"]
GENDER_TOTAL, POPULATION_TOTAL = "男女計", "総人口"
BAND_WIDTH = 5


def band_group_table(spark: SparkSession) -> DataFrame:
    """Five-year band text -> eight groups, built from the rule
    (under 20, decades 20-79, 80 and over; open top band ``100以上``)."""
    rows = []
    for lo in range(0, 100, BAND_WIDTH):
        g = "under_19" if lo < 20 else ("over_80" if lo >= 80 else f"{lo // 10 * 10}-{lo // 10 * 10 + 9}")
        rows.append((f"{lo}～{lo + BAND_WIDTH - 1}", g))
    rows.append(("100以上", "over_80"))
    return spark.createDataFrame(rows, "age string, age_group string")


def city_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_MAP, "city string, city_en string")


# ---- stand-in wide tables ------------------------------------------------

def _year_month(ts: str) -> list[Column]:
    return [F.year(ts).cast("string").alias("year"), F.month(ts).alias("month")]


def category_wide(orders: DataFrame) -> DataFrame:
    """month x category counts per year, positional columns, plus a total
    row whose month cell is text."""
    p = [F.count_if(F.col("o_orderpriority") == v) for v in
         ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]]
    g = orders.groupBy(*_year_month("o_orderdate")).agg(*[c.alias(f"c{i}") for i, c in enumerate(p)])
    g = g.select("year", F.col("month").cast("string").alias("c_month"), "c0", "c1", "c2",
                 (F.col("c0") + F.col("c1") + F.col("c2")).alias("c_sub"), "c3", "c4",
                 (F.col("c3") + F.col("c4")).alias("c_sub2"),
                 (F.col("c0") + F.col("c1") + F.col("c2") + F.col("c3") + F.col("c4")).alias("c_tot"))
    tot = g.groupBy("year").agg(F.lit(GRAND_TOTAL).alias("c_month"),
                                *[F.sum(c).alias(c) for c in ["c0", "c1", "c2", "c_sub", "c3", "c4", "c_sub2", "c_tot"]])
    return g.unionByName(tot)


def clean_category(wide: DataFrame) -> DataFrame:
    """Category flow: positional rename, drop subtotals/total, melt, year
    first, non-numeric month rows dropped."""
    w = rename_by_position(wide, ["year", "month", *CATEGORIES])
    w = w.drop("subtotal", "subtotal2", "total")
    long = melt(w, ["year", "month"], [c for c in CATEGORIES if c not in ("subtotal", "subtotal2", "total")],
                "category", "application", "long")
    long = long.withColumn("month", F.col("month").try_cast("int")).dropna(subset=["month"])
    return long.select("year", "month", "category", "application")


def _age_group_of(q: Column) -> Column:
    c = F.when(q < 20, F.lit("under_19"))
    for lo in range(20, 80, 10):
        c = c.when(q < lo + 10, F.lit(f"{lo}-{lo + 9}"))
    return c.otherwise(F.lit("over_80"))


def age_wide(lineitem: DataFrame) -> DataFrame:
    """month x age-group amounts (in thousands, fractional) per year."""
    li = lineitem.select(*_year_month("l_shipdate"), _age_group_of(F.col("l_quantity")).alias("g"),
                         (F.col("l_extendedprice") / 1000).alias("v"))
    w = li.groupBy("year", "month").pivot("g", AGE_GROUPS).agg(F.sum("v"))
    return w.withColumn("total", reduce(lambda a, b: a + b, [F.coalesce(F.col(g), F.lit(0.0)) for g in AGE_GROUPS]))


def clean_age(wide: DataFrame) -> DataFrame:
    """Age flow: drop total, melt, number parse, round half to even to an
    integer, drop missing."""
    w = wide.drop("total")
    long = melt(w, ["year", "month"], AGE_GROUPS, "age_group", "application", "string")
    app = F.bround(F.col("application").try_cast("double"), 0).cast("long")
    return long.withColumn("application", app).dropna(subset=["application"]) \
               .select("year", "month", "age_group", "application")


def gender_sheet(orders: DataFrame) -> DataFrame:
    """A sheet with a title row and a header row above the month rows;
    ``row_no`` keeps the sheet order (first cell is text)."""
    g = orders.groupBy(*_year_month("o_orderdate")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("m"), F.count_if(F.col("o_orderstatus") == "O").alias("f"),
        F.count(F.lit(1)).alias("t"))
    body = g.select("year", (F.col("month") + 1).alias("row_no"), F.col("month").cast("string").alias("c0"),
                    F.col("m").cast("string").alias("c1"), F.col("f").cast("string").alias("c2"),
                    F.col("t").cast("string").alias("c3"))
    years = g.select("year").distinct()
    title = years.select("year", F.lit(0).alias("row_no"), F.lit("性別・月別発行数").alias("c0"),
                         F.lit(None).cast("string").alias("c1"), F.lit(None).cast("string").alias("c2"),
                         F.lit(None).cast("string").alias("c3"))
    header = years.select("year", F.lit(1).alias("row_no"), F.lit("月").alias("c0"), F.lit("男").alias("c1"),
                          F.lit("女").alias("c2"), F.lit("計").alias("c3"))
    return body.unionByName(title).unionByName(header)


def clean_gender(sheet: DataFrame) -> DataFrame:
    """Gender flow: data starts at the first row whose first cell is a
    month 1..12 (B19); positional rename; drop total; melt."""
    m = F.col("c0").try_cast("int")
    s = from_first_match(sheet, "year", "row_no", m.between(1, 12))
    s = rename_by_position(s.drop("row_no"), ["year", "month", *GENDERS]).drop("total")
    long = melt(s, ["year", "month"], ["male", "female"], "gender", "application", "string")
    long = long.withColumn("month", F.col("month").try_cast("int")).dropna(subset=["month"])
    return long.withColumn("application", F.col("application").try_cast("long")) \
               .select("year", "month", "gender", "application")


def city_sheet(spark: SparkSession, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """city x month sheet per year: prefecture rows (nation k -> k-th
    prefecture, one unknown name kept), a subtotal row, total rows, and a
    last total column."""
    names = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CITY_MAP)], "k int, city string")
    o = orders.select("o_custkey", *_year_month("o_orderdate"))
    c = customer.select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(names), F.col("c_nationkey") == F.col("k"), "left")
    city = F.when(F.col("c_nationkey") == 24, F.lit("不明県")).otherwise(F.col("city"))
    j = j.withColumn("city", city)
    g = j.groupBy("year", "city").pivot("month", list(range(1, 13))).agg(F.count(F.lit(1)))
    g = g.toDF("year", "city", *[f"m{i}" for i in range(1, 13)])
    months = [f"m{i}" for i in range(1, 13)]
    g = g.withColumn("m_total", reduce(lambda a, b: a + b, [F.coalesce(F.col(m), F.lit(0)) for m in months]))
    sub = g.filter(F.col("city").isin([c for c, _ in CITY_MAP[:7]])).groupBy("year").agg(
        *[F.sum(m).alias(m) for m in [*months, "m_total"]]).withColumn("city", F.lit("東北" + SUBTOTAL_WORD))
    tot = g.groupBy("year").agg(*[F.sum(m).alias(m) for m in [*months, "m_total"]]) \
           .withColumn("city", F.lit(GRAND_TOTAL))
    return g.unionByName(sub).unionByName(tot)


def clean_city(spark: SparkSession, sheet: DataFrame) -> DataFrame:
    """City flow: drop the last (total) column, melt months, drop total and
    subtotal rows (null-safe), drop missing, romanise (unknown kept)."""
    months = [f"m{i}" for i in range(1, 13)]
    s = sheet.drop("m_total")
    long = melt(s, ["year", "city"], months, "month", "application", "long")
    long = long.filter(~F.coalesce(F.col("city").isin(TOTAL_LABELS), F.lit(False))) \
               .dropna(subset=["city", "month", "application"])
    long = map_join(long, city_table(spark), "city", "city_en", "city_name", keep_unknown=True)
    long = long.filter(~F.coalesce(F.col("city_name").contains(SUBTOTAL_WORD), F.lit(False)))
    long = long.withColumn("month", F.regexp_replace("month", "^m", "").try_cast("int")).dropna(subset=["month"])
    return long.select("year", "month", F.col("city_name").alias("city"), "application")


def age_city_sheet(spark: SparkSession, lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """city x age-group sheet per year (lines per customer prefecture and
    quantity band), with a total column, a trailing share column and the
    subtotal/total rows of the city sheet."""
    names = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CITY_MAP)], "k int, city string")
    li = lineitem.select("l_orderkey", _age_group_of(F.col("l_quantity")).alias("g"))
    o = orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("string").alias("year"))
    c = customer.select("c_custkey", "c_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey) \
          .join(F.broadcast(names), F.col("c_nationkey") == F.col("k"), "left")
    j = j.withColumn("city", F.when(F.col("c_nationkey") == 24, F.lit("不明県")).otherwise(F.col("city")))
    g = j.groupBy("year", "city").pivot("g", AGE_GROUPS).agg(F.count(F.lit(1)))
    tot = reduce(lambda a, b: a + b, [F.coalesce(F.col(x), F.lit(0)) for x in AGE_GROUPS])
    g = g.withColumn("total", tot).withColumn("share", F.lit(None).cast("double"))
    sub = g.filter(F.col("city").isin([c for c, _ in CITY_MAP[:7]])).groupBy("year").agg(
        *[F.sum(x).alias(x) for x in [*AGE_GROUPS, "total"]]).withColumn("city", F.lit("東北" + SUBTOTAL_WORD)) \
        .withColumn("share", F.lit(None).cast("double"))
    grand = g.groupBy("year").agg(*[F.sum(x).alias(x) for x in [*AGE_GROUPS, "total"]]) \
             .withColumn("city", F.lit(GRAND_TOTAL)).withColumn("share", F.lit(None).cast("double"))
    return g.unionByName(sub).unionByName(grand).select("year", "city", *AGE_GROUPS, "total", "share")


def clean_age_city(spark: SparkSession, sheet: DataFrame) -> DataFrame:
    """Age x city flow: drop the last column, then the total column;
    positional rename; melt; drop total/subtotal rows (null-safe) and
    missing values; romanise (unknown kept); numeric application."""
    s = sheet.drop(sheet.columns[-1])
    if "total" in s.columns:
        s = s.drop("total")
    s = rename_by_position(s, ["year", "city", *AGE_GROUPS])
    long = melt(s, ["year", "city"], AGE_GROUPS, "age_group", "application", "long")
    long = long.filter(~F.coalesce(F.col("city").isin(TOTAL_LABELS), F.lit(False))) \
               .dropna(subset=["city", "age_group", "application"])
    long = map_join(long, city_table(spark), "city", "city_en", "city_name", keep_unknown=True)
    long = long.filter(~F.coalesce(F.col("city_name").contains(SUBTOTAL_WORD), F.lit(False)))
    return long.select("year", F.col("city_name").alias("city"), "age_group",
                       F.col("application").try_cast("double").alias("application")).dropna(subset=["application"])


def valid_sheet(orders: DataFrame, nation: DataFrame, customer: DataFrame) -> DataFrame:
    """Valid passports per city with a grand-total row, per year."""
    o = orders.select("o_custkey", "o_orderpriority", F.year("o_orderdate").cast("string").alias("year"))
    j = o.join(customer.select("c_custkey", "c_nationkey"), o.o_custkey == F.col("c_custkey"))
    j = j.join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    five = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    g = j.groupBy("year", F.col("n_name").alias("city")).agg(
        F.lit(None).cast("string").alias("na1"), F.lit(None).cast("string").alias("na2"),
        F.count_if(five).alias("5_years"), F.count_if(~five).alias("10_years"), F.count(F.lit(1)).alias("total"))
    tot = g.groupBy("year").agg(F.lit(GRAND_TOTAL).alias("city"), F.lit(None).cast("string").alias("na1"),
                                F.lit(None).cast("string").alias("na2"), F.sum("5_years").alias("5_years"),
                                F.sum("10_years").alias("10_years"), F.sum("total").alias("total"))
    return g.unionByName(tot)


def valid_total(sheet: DataFrame) -> DataFrame:
    """L4: keep the grand-total row and the total column."""
    return sheet.filter(F.col("city") == GRAND_TOTAL).select(F.col("year").cast("int").alias("year"),
                                                             F.col("total").cast("long").alias("total"))


def population_long(lineitem: DataFrame) -> DataFrame:
    """Population in long form with text codes: sex, population kind, age
    band text (some with a re-listed prefix), time code yyyy00MMMM, value."""
    lo = (F.floor((F.col("l_quantity") - 1) / BAND_WIDTH) * BAND_WIDTH).cast("int")
    band = F.concat(lo.cast("string"), F.lit("～"), (lo + BAND_WIDTH - 1).cast("string"), F.lit("歳"))
    band = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("（再掲）"), band)).otherwise(band)
    return lineitem.select(
        F.when(F.col("l_returnflag") == "A", F.lit("男")).when(F.col("l_returnflag") == "N", F.lit("女"))
         .otherwise(F.lit(GENDER_TOTAL)).alias("sex"),
        F.when(F.col("l_linestatus") == "O", F.lit(POPULATION_TOTAL)).otherwise(F.lit("日本人人口")).alias("population"),
        band.alias("age_text"),
        F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("00"), F.date_format("l_shipdate", "MM"),
                 F.date_format("l_shipdate", "MM")).alias("time_code"),
        F.col("l_quantity").alias("value"))


def population_bands(spark: SparkSession, pop: DataFrame) -> DataFrame:
    """Remove words from the band text, drop the
    aggregate bands, roll five-year bands into eight groups (one map join,
    one aggregation), split the time code, map the sex (unknown -> null)."""
    keep = (~F.col("sex").eqNullSafe(F.lit(GENDER_TOTAL))) & (~F.col("population").eqNullSafe(F.lit(POPULATION_TOTAL)))
    p = pop.filter(keep)
    p = p.withColumn("age", remove_literals("age_text", AGE_WORDS)).filter(~F.coalesce(F.col("age").isin(EXCLUDED_AGE_GROUPS), F.lit(False)))
    p = p.join(F.broadcast(band_group_table(spark)), "age")
    g = p.groupBy("sex", "time_code", "age_group").agg(F.sum("value").alias("value"))
    g = g.select(F.substring("time_code", 1, 4).try_cast("int").alias("year"),
                 F.substring("time_code", 7, 2).try_cast("int").alias("month"), "sex", "age_group", "value")
    g = map_join(g, spark.createDataFrame(GENDER_MAP, "sex string, gender string"), "sex", "gender", "gender",
                 keep_unknown=False)
    return g.groupBy("year", "month", "gender", F.col("age_group").alias("age")).agg(F.sum("value").alias("value"))


def population_yoy(orders: DataFrame, marker_year: int = 1998, min_year: int = 1996) -> DataFrame:
    """Per file (three-year spans of order years), month 10 when
    the file holds ``marker_year`` else month 12; value in thousands scaled
    to an integer; years from ``min_year``."""
    o = orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_totalprice")
    o = o.withColumn("file", F.floor((F.col("year") - 1995) / 3))
    m = o.groupBy("file", "year", "month").agg((F.sum("o_totalprice") / 1e6).alias("value_k"))
    c = per_file_choice(m, "file", F.col("year") == marker_year, F.col("month") == 10, F.col("month") == 12)
    return c.select("year", "month", (F.col("value_k") * 1000).cast("long").alias("value")) \
            .filter(F.col("year") >= min_year)
