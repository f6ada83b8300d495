"""Delivery and player-spend analyses.

Stand-in views over the driver tables:
* player spend: one row per lineitem, account = ``acct_<custkey>``,
  currency = customer nation, date = order date, amount = extended price,
  attempts = quantity, wins = line number unless returned, treasure =
  price x discount x 10.
* deliveries: ``events`` (time = ts, measure = value, category = type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import day_period, day_type, late_hours, month_text, quarter_text
from tributary.operators import narrowing
from tributary.operators.aggregates import drop_null_keys, sums_with_ratios
from tributary.session import cut_lineage

# The sentinel the delivery CSV uses for a missing value.
SENTINEL = "NaN "


def player_spend(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = customer.select("c_custkey", "c_nationkey")
    n = nation.select("n_nationkey", "n_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey) \
          .join(n, F.col("c_nationkey") == n.n_nationkey)
    return j.select(
        F.concat(F.lit("acct_"), F.col("o_custkey").cast("string")).alias("account"),
        F.col("n_name").alias("currency"),
        F.to_date("o_orderdate").alias("date"),
        F.col("l_extendedprice").alias("amount_spent"),
        F.col("l_quantity").alias("gacha_attempts"),
        F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(F.col("l_linenumber")).alias("wins"),
        (F.col("l_extendedprice") * F.col("l_discount") * 10).alias("treasure_value"),
    )


def account_roi(spend: DataFrame) -> DataFrame:
    """Spend and prize per account, ROI = prize / spend (null on 0)."""
    return sums_with_ratios(spend, ["account"], {"amount_spent": "amount_spent", "treasure_value": "treasure_value"},
                            {"roi": ("treasure_value", "amount_spent")})


def lucky_accounts(roi: DataFrame, exclude: list[str], roi_q: float = 0.75, spend_q: float = 0.25) -> DataFrame:
    """Accounts whose spend is at most the lower quartile and
    ROI at least the upper quartile, after removing the named outliers.  The
    accounts are summed once and written out; both thresholds come from the same
    two passes over them and are used as scalar subqueries."""
    r = cut_lineage(roi.filter(~F.col("account").isin(exclude)) if exclude else roi)
    q = cut_lineage(narrowing.quantiles(r, ["roi", "amount_spent"], {"low": spend_q, "high": roi_q}))
    most = q.filter("column_name = 'amount_spent'").select("low").scalar()
    least = q.filter("column_name = 'roi'").select("high").scalar()
    return r.filter((F.col("amount_spent") <= most) & (F.col("roi") >= least))


def quarter_currency(spend: DataFrame) -> DataFrame:
    """Per (quarter, currency): account rows, sum/median/mean.  The
    joined rows are written out once; both medians come from the same passes."""
    keys, cols = ["quarter", "currency"], ["amount_spent", "gacha_attempts"]
    s = cut_lineage(drop_null_keys(spend.withColumn("quarter", quarter_text("date")), keys).select(*keys, "account", *cols))
    base = s.groupBy(*keys).agg(F.count("account").cast("long").alias("account"),
                                *[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("sum", F.sum), ("mean", F.avg))])
    m = narrowing.quantiles(s, cols, {"m": 0.5}, keys)
    medians = m.groupBy(*keys).agg(*[F.max(F.when(F.col("column_name") == c, F.col("m"))).alias(f"{c}_median") for c in cols])
    return base.join(medians, keys, "left")


def month_rates(spend: DataFrame) -> DataFrame:
    """Monthly sums per currency, win rate and ROI."""
    s = spend.withColumn("month", month_text("date"))
    return sums_with_ratios(s, ["month", "currency"],
                            {"gacha_attempts": "gacha_attempts", "amount_spent": "amount_spent",
                             "wins": "wins", "treasure_value": "treasure_value"},
                            {"win_rate": ("wins", "gacha_attempts"), "roi": ("treasure_value", "amount_spent")})


def top_share_by(df: DataFrame, value: str, label: str, threshold: float = 0.8) -> DataFrame:
    """Composition (shares by ``label``) of the rows whose average
    percentile rank of ``value`` is at least ``threshold``: the least such value
    is found by narrowing and used as a scalar."""
    top = df.filter(F.col(value) >= narrowing.value_at_share(df, value, threshold))
    g = top.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    from tributary.operators.windows import share_of_total
    return share_of_total(g, "n", "proportion").select(label, "proportion")


def deliveries(events: DataFrame) -> DataFrame:
    """Delivery stand-in with hour, weekday type and day period."""
    h = F.hour("ts")
    return events.select("event_id", "ts", "user_id", "event_type", "value",
                         h.alias("hour"), day_type("ts").alias("day_type"), day_period(h).alias("pickup_period"))


def with_sentinels(events: DataFrame) -> DataFrame:
    """A text column carrying the missing-value sentinel where the measure
    is small (a fixture derived from the table)."""
    return events.select("event_id", "user_id", "value",
                         F.when(F.col("value") < 2.0, F.lit(SENTINEL)).otherwise(F.col("event_type")).alias("event_type"))


def sentinel_to_null(df: DataFrame) -> DataFrame:
    """The sentinel text becomes null in every text column."""
    return df.replace(SENTINEL, None)


def late_low_rows(d: DataFrame, max_value: float = 350.0) -> DataFrame:
    """Wrap-around late hours and a range filter."""
    return d.filter(late_hours("hour") & (F.col("value") < max_value))
