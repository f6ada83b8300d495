"""Delivery and player-spend queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions.dates import DAY_PERIOD_ORDER
from tributary.operators import aggregates as A
from tributary.operators import stats
from tributary.plans import analysis as X
from tributary.plans.catalog import query, table

D = 6  # digits kept for doubles compared with the oracle


def _r(df, cols, d=D):
    return df.select(*[F.bround(F.col(c), d).alias(c) if c in cols else F.col(c) for c in df.columns])


def _spend(spark, sf):
    return X.player_spend(table(spark, sf, "lineitem"), table(spark, sf, "orders"),
                          table(spark, sf, "customer"), table(spark, sf, "nation"))


_SPEND = """
spend AS (
  SELECT 'acct_' || CAST(o_custkey AS VARCHAR) AS account, n_name AS currency, CAST(o_orderdate AS DATE) AS date,
         l_extendedprice AS amount_spent, l_quantity AS gacha_attempts,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_linenumber END AS wins,
         l_extendedprice * l_discount * 10 AS treasure_value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey)"""

_ROI = _SPEND + """,
roi AS (SELECT account, sum(amount_spent) AS amount_spent, sum(treasure_value) AS treasure_value,
               sum(treasure_value) / nullif(sum(amount_spent), 0) AS roi
        FROM spend WHERE account IS NOT NULL GROUP BY account)"""


@query("group_mean_std", sql="""
SELECT o_orderpriority, round_even(avg(o_totalprice), 2) AS mean, round_even(stddev_samp(o_totalprice), 2) AS std
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def group_mean_std(spark, sf):
    return A.mean_std(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice", digits=2)


@query("group_mean_sorted", sql="""
SELECT l_returnflag, round_even(avg(l_quantity), 6) AS avg_quantity FROM lineitem
WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY avg_quantity DESC NULLS LAST""")
def group_mean_sorted(spark, sf):
    li = A.drop_null_keys(table(spark, sf, "lineitem"), ["l_returnflag"])
    g = li.groupBy("l_returnflag").agg(F.bround(F.avg("l_quantity"), D).alias("avg_quantity"))
    return g.orderBy(F.col("avg_quantity").desc_nulls_last())


@query("group_size_vs_count", sql="""
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS size,
       CAST(count(CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END) AS BIGINT) AS non_null
FROM lineitem GROUP BY 1, 2""")
def group_size_vs_count(spark, sf):
    li = table(spark, sf, "lineitem")
    x = F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("size"), F.count(x).alias("non_null"))


@query("account_roi", sql=f"WITH {_ROI} SELECT account, round_even(amount_spent, 6) AS amount_spent, "
       "round_even(treasure_value, 6) AS treasure_value, round_even(roi, 6) AS roi FROM roi "
       "ORDER BY roi DESC NULLS LAST, amount_spent ASC NULLS LAST")
def account_roi(spark, sf):
    r = X.account_roi(_spend(spark, sf))
    r = r.orderBy(F.col("roi").desc_nulls_last(), F.col("amount_spent").asc_nulls_last())
    return _r(r, {"amount_spent", "treasure_value", "roi"})


# Fixed value: the one account removed as an outlier (a caller parameter).
LUCKY_EXCLUDE = ["acct_0"]


@query("lucky_cohort", sql=f"""WITH {_ROI},
r AS (SELECT * FROM roi WHERE account NOT IN ('acct_0')),
t AS (SELECT quantile_cont(roi, 0.75) AS q, quantile_cont(amount_spent, 0.25) AS s FROM r)
SELECT account, round_even(amount_spent, 6) AS amount_spent, round_even(treasure_value, 6) AS treasure_value,
       round_even(roi, 6) AS roi
FROM r, t WHERE r.amount_spent <= t.s AND r.roi >= t.q""")
def lucky_cohort(spark, sf):
    r = X.lucky_accounts(X.account_roi(_spend(spark, sf)), LUCKY_EXCLUDE)
    return _r(r, {"amount_spent", "treasure_value", "roi"})


@query("quarter_currency", sql=f"""WITH {_SPEND}
SELECT CAST(year(date) AS VARCHAR) || 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter, currency,
       CAST(count(account) AS BIGINT) AS account,
       round_even(sum(amount_spent), 6) AS amount_spent_sum, round_even(median(amount_spent), 6) AS amount_spent_median,
       round_even(avg(amount_spent), 6) AS amount_spent_mean,
       round_even(sum(gacha_attempts), 6) AS gacha_attempts_sum,
       round_even(median(gacha_attempts), 6) AS gacha_attempts_median,
       round_even(avg(gacha_attempts), 6) AS gacha_attempts_mean
FROM spend WHERE date IS NOT NULL AND currency IS NOT NULL GROUP BY 1, 2""")
def quarter_currency(spark, sf):
    q = X.quarter_currency(_spend(spark, sf))
    return _r(q, {c for c in q.columns if c.startswith(("amount", "gacha"))})


@query("month_rates", sql=f"""WITH {_SPEND}
SELECT strftime(date, '%Y-%m') AS month, currency,
       round_even(sum(gacha_attempts), 6) AS gacha_attempts, round_even(sum(amount_spent), 6) AS amount_spent,
       CAST(sum(wins) AS BIGINT) AS wins, round_even(sum(treasure_value), 6) AS treasure_value,
       round_even(sum(wins) / nullif(sum(gacha_attempts), 0), 6) AS win_rate,
       round_even(sum(treasure_value) / nullif(sum(amount_spent), 0), 6) AS roi
FROM spend WHERE date IS NOT NULL AND currency IS NOT NULL GROUP BY 1, 2""")
def month_rates(spark, sf):
    m = X.month_rates(_spend(spark, sf)).withColumn("wins", F.col("wins").cast("long"))
    return _r(m, {"gacha_attempts", "amount_spent", "treasure_value", "win_rate", "roi"})


@query("value_counts", sql="""
SELECT event_type, CAST(count(*) AS BIGINT) AS count FROM events WHERE event_type IS NOT NULL GROUP BY 1""")
def value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "events"), "event_type")


@query("value_shares", sql="""
SELECT event_type, round_even(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM events WHERE event_type IS NOT NULL GROUP BY 1""")
def value_shares(spark, sf):
    v = A.value_counts(table(spark, sf, "events"), "event_type", normalize=True, scale=100.0, name="percentage")
    return _r(v, {"percentage"})


_SENT = """
s AS (SELECT event_id, user_id, value,
             CASE WHEN value < 2.0 THEN NULL ELSE event_type END AS event_type FROM events)"""


@query("sentinel_null", sql=f"""WITH {_SENT}
SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1""")
def sentinel_null(spark, sf):
    s = X.sentinel_to_null(X.with_sentinels(table(spark, sf, "events")))
    return s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("null_counts", sql=f"""WITH {_SENT}
SELECT 'event_id' AS column_name, CAST(count(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS nulls FROM s
UNION ALL SELECT 'user_id', CAST(count(*) FILTER (WHERE user_id IS NULL) AS BIGINT) FROM s
UNION ALL SELECT 'value', CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) FROM s
UNION ALL SELECT 'event_type', CAST(count(*) FILTER (WHERE event_type IS NULL) AS BIGINT) FROM s""")
def null_counts(spark, sf):
    return A.null_counts(X.sentinel_to_null(X.with_sentinels(table(spark, sf, "events"))))


@query("dropna", sql=f"""WITH {_SENT}
SELECT event_id, user_id, value, event_type FROM s WHERE event_type IS NOT NULL AND value IS NOT NULL""")
def dropna(spark, sf):
    s = X.sentinel_to_null(X.with_sentinels(table(spark, sf, "events")))
    return s.dropna(subset=["event_type", "value"])


_ORDER_NUMBERS, _ORDER_TEXTS = ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderpriority"]


@query("profile", sql="\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, round_even(avg({c}), 6) AS mean, round_even(stddev_samp({c}), 6) AS std,
       round_even(CAST(min({c}) AS DOUBLE), 6) AS min, round_even(quantile_cont({c}, 0.25), 6) AS q25, round_even(quantile_cont({c}, 0.5), 6) AS q50,
       round_even(quantile_cont({c}, 0.75), 6) AS q75, round_even(CAST(max({c}) AS DOUBLE), 6) AS max
FROM orders""" for c in _ORDER_NUMBERS))
def profile(spark, sf):
    """Every numeric column of a table."""
    return _r(A.profile_numeric(table(spark, sf, "orders")), {"mean", "std", "min", "q25", "q50", "q75", "max"})


@query("profile_text", sql="\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, coalesce(CAST(sum(n) AS BIGINT), 0) AS count, CAST(count(*) AS BIGINT) AS "unique",
       arg_min(v, (-n, v)) AS top, CAST(max(n) AS BIGINT) AS freq
FROM (SELECT {c} AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)""" for c in _ORDER_TEXTS))
def profile_text(spark, sf):
    """Every text column of a table."""
    return A.profile_text(table(spark, sf, "orders"))


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("profile_schema", sql="\nUNION ALL ".join(f"""
SELECT {i} AS position, '{c}' AS column_name,
       CASE any_value(typeof({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int'
            ELSE lower(any_value(typeof({c}))) END AS type, CAST(count({c}) AS BIGINT) AS not_null FROM orders""" for i, c in enumerate(_ORDER_COLUMNS)))
def profile_schema(spark, sf):
    """Position, type and values of every column of a table."""
    return A.schema_profile(table(spark, sf, "orders"))


@query("profile_filtered", sql="""
SELECT 'value' AS column_name, CAST(count(value) AS BIGINT) AS count, round_even(avg(value), 6) AS mean,
       round_even(stddev_samp(value), 6) AS std, round_even(min(value), 6) AS min,
       round_even(quantile_cont(value, 0.25), 6) AS q25, round_even(quantile_cont(value, 0.5), 6) AS q50,
       round_even(quantile_cont(value, 0.75), 6) AS q75, round_even(max(value), 6) AS max
FROM events WHERE event_type = 'purchase'""")
def profile_filtered(spark, sf):
    e = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return _r(A.profile_numeric(e, ["value"]), {"mean", "std", "min", "q25", "q50", "q75", "max"})


@query("box_stats", sql="""
WITH q AS (
  SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
         quantile_cont(l_extendedprice, 0.75) AS q3
  FROM lineitem WHERE l_returnflag IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1),
j AS (SELECT l.l_returnflag, l.l_extendedprice AS v, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr
      FROM lineitem l JOIN q USING (l_returnflag) WHERE l.l_extendedprice IS NOT NULL)
SELECT l_returnflag, round_even(any_value(q1), 6) AS q1, round_even(any_value(median), 6) AS median,
       round_even(any_value(q3), 6) AS q3, round_even(any_value(iqr), 6) AS iqr,
       round_even(min(CASE WHEN v >= q1 - 1.5 * iqr THEN v END), 6) AS whisker_low,
       round_even(max(CASE WHEN v <= q3 + 1.5 * iqr THEN v END), 6) AS whisker_high,
       CAST(count(*) FILTER (WHERE v < q1 - 1.5 * iqr OR v > q3 + 1.5 * iqr) AS BIGINT) AS outliers
FROM j GROUP BY 1""")
def box_stats(spark, sf):
    b = A.box_stats(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return _r(b, {"q1", "median", "q3", "iqr", "whisker_low", "whisker_high"})


@query("date_pivot", sql="""
WITH c AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT date, avg(n) FILTER (WHERE o_orderstatus = 'F') AS F, avg(n) FILTER (WHERE o_orderstatus = 'O') AS O,
       avg(n) FILTER (WHERE o_orderstatus = 'P') AS P
FROM c GROUP BY 1""")
def date_pivot(spark, sf):
    o = table(spark, sf, "orders").withColumn("date", F.to_date("o_orderdate"))
    c = o.groupBy("date", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return A.pivot_mean(c, "date", "o_orderstatus", "n", ["F", "O", "P"])


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql():
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round_even(corr({a}, {b}), 6) AS corr FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@query("correlations", sql=_corr_sql())
def correlations(spark, sf):
    return _r(A.correlation_matrix(table(spark, sf, "lineitem"), _CORR_COLS), {"corr"})


@query("pct_rank_top20", sql="""
WITH r AS (
  SELECT o_orderpriority,
         (rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0)
           / count(*) OVER () AS pct
  FROM orders WHERE o_totalprice IS NOT NULL),
t AS (SELECT o_orderpriority, count(*) AS n FROM r WHERE pct >= 0.8 AND o_orderpriority IS NOT NULL GROUP BY 1)
SELECT o_orderpriority, round_even(n * 1.0 / sum(n) OVER (), 6) AS proportion FROM t""")
def pct_rank_top20(spark, sf):
    return _r(X.top_share_by(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority"), {"proportion"})


@query("anova", sql="""
WITH g AS (SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS s, sum(l_quantity * l_quantity) AS ss
           FROM lineitem WHERE l_returnflag IS NOT NULL AND l_quantity IS NOT NULL GROUP BY 1),
t AS (SELECT count(*) AS k, sum(n) AS N, sum(s) AS S, sum(ss) AS SS, sum(s * s / n) AS b FROM g),
f AS (SELECT k, N, ((b - S * S / N) / (k - 1)) / nullif((SS - b) / (N - k), 0) AS f FROM t)
SELECT CAST(k AS BIGINT) AS groups, CAST(N AS BIGINT) AS n, round_even(f, 6) AS f_statistic,
       round_even(CASE WHEN k = 3 THEN pow(1 + 2 * f / (N - k), -(N - k) / 2.0) END, 6) AS p_value FROM f""")
def anova(spark, sf):
    return _r(stats.one_way_anova(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity"),
              {"f_statistic", "p_value"})


@query("kruskal", sql="""
WITH d AS (SELECT l_returnflag AS g, l_quantity AS v FROM lineitem WHERE l_returnflag IS NOT NULL AND l_quantity IS NOT NULL),
r AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM d),
s AS (SELECT g, sum(rk) AS R, count(*) AS ni FROM r GROUP BY g),
t AS (SELECT sum(c * c * c - c) AS T, sum(c) AS N FROM (SELECT count(*)::DOUBLE AS c FROM d GROUP BY v)),
h AS (SELECT count(*) AS k, any_value(N) AS N,
             (12.0 / (any_value(N) * (any_value(N) + 1)) * sum(R * R / ni) - 3 * (any_value(N) + 1))
               / (1 - any_value(T) / (any_value(N) ^ 3 - any_value(N))) AS H
      FROM s, t)
SELECT CAST(k AS BIGINT) AS groups, CAST(N AS BIGINT) AS n, round_even(H, 6) AS h_statistic,
       round_even(CASE WHEN k = 3 THEN exp(-H / 2) END, 6) AS p_value FROM h""")
def kruskal(spark, sf):
    return _r(stats.kruskal_wallis(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity"),
              {"h_statistic", "p_value"})


_DEL = """
d AS (SELECT event_id, ts, user_id, event_type, value, hour(ts) AS hour,
             CASE WHEN isodow(ts) - 1 >= 5 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
             CASE WHEN hour(ts) >= 6 AND hour(ts) < 12 THEN 'Morning'
                  WHEN hour(ts) >= 12 AND hour(ts) < 18 THEN 'Afternoon' ELSE 'Evening' END AS pickup_period
      FROM events)"""


@query("day_period", sql=f"""WITH {_DEL}
SELECT pickup_period, CASE pickup_period WHEN 'Morning' THEN 0 WHEN 'Afternoon' THEN 1 ELSE 2 END AS position,
       round_even(avg(value), 6) AS mean_value, CAST(count(*) AS BIGINT) AS n
FROM d GROUP BY 1 ORDER BY position""")
def day_period(spark, sf):
    d = X.deliveries(table(spark, sf, "events"))
    order = spark.createDataFrame([(p, i) for i, p in enumerate(DAY_PERIOD_ORDER)], "pickup_period string, position int")
    g = d.groupBy("pickup_period").agg(F.bround(F.avg("value"), D).alias("mean_value"), F.count(F.lit(1)).alias("n"))
    return g.join(F.broadcast(order), "pickup_period").orderBy("position")


@query("weekend", sql=f"""WITH {_DEL}
SELECT day_type, round_even(avg(value), 6) AS mean, round_even(stddev_samp(value), 6) AS std FROM d GROUP BY 1""")
def weekend(spark, sf):
    return A.mean_std(X.deliveries(table(spark, sf, "events")), ["day_type"], "value", digits=D)


@query("late_hours", sql=f"""WITH {_DEL}
SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM d
WHERE (hour >= 22 OR hour < 1) AND value < 350 GROUP BY 1""")
def late_hours_q(spark, sf):
    d = X.late_low_rows(X.deliveries(table(spark, sf, "events")))
    return d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("share_and_rating", sql=f"""WITH {_DEL},
f AS (SELECT * FROM d WHERE (hour >= 22 OR hour < 1) AND value < 350 AND event_type IS NOT NULL)
SELECT event_type, round_even(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage,
       round_even(avg(value), 6) AS avg_value, round_even(stddev_samp(value), 6) AS std_value
FROM f GROUP BY 1""")
def share_and_rating(spark, sf):
    f = A.drop_null_keys(X.late_low_rows(X.deliveries(table(spark, sf, "events"))), ["event_type"])
    g = f.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value"),
                                    F.stddev_samp("value").alias("std_value"))
    from tributary.operators.windows import share_of_total
    g = share_of_total(g, "n", "percentage", 100.0).select("event_type", "percentage", "avg_value", "std_value")
    return _r(g, {"percentage", "avg_value", "std_value"})


_SHAPES = {"orders": 6, "lineitem": 11, "customer": 5, "events": 6}


@query("table_shape", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows, CAST({c} AS BIGINT) AS columns FROM {t}"
    for t, c in _SHAPES.items()))
def table_shape(spark, sf):
    """Shape of the analysed tables."""
    parts = [A.table_shape(table(spark, sf, t), t) for t in _SHAPES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
