"""Portfolio risk reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlens.catalog.registry import FINE, query, rounded
from cardlens.catalog.sql import (
    AVG_AMOUNT,
    FRAUD_AMOUNT,
    FRAUD_SHARE,
    FRAUDS,
    LABELLED,
    fine,
    on_features,
    on_orders,
    on_tx,
)
from cardlens.catalog.stored import stored_order_lines, stored_transactions
from cardlens.operators import features as features_ops
from cardlens.operators import portfolio as P
from cardlens.sources.star import order_lines, transactions


@query(
    "agg_15_by_distance_tier",
    on_features(
        f"""SELECT CASE WHEN merch_distance_km < 10 THEN '< 10 km' WHEN merch_distance_km < 50 THEN '10-50 km'
            WHEN merch_distance_km < 100 THEN '50-100 km' WHEN merch_distance_km < 300 THEN '100-300 km'
            ELSE '> 300 km' END AS dist_bin, {LABELLED}, {FRAUDS}, {AVG_AMOUNT}, {FRAUD_AMOUNT}, {FRAUD_SHARE}
FROM fx WHERE merch_distance_km >= 0 GROUP BY 1"""
    ),
)
def by_distance_tier(spark, folder):
    df = transactions(spark, folder).transform(features_ops.add_distance)
    return rounded(P.by_distance_tier(df), fraud_amount=2, avg_amount=FINE)


@query(
    "agg_17_by_age_tier",
    on_features(
        f"""SELECT CASE WHEN cardholder_age < 25 THEN 'Under 25' WHEN cardholder_age < 35 THEN '25-34'
            WHEN cardholder_age < 45 THEN '35-44' WHEN cardholder_age < 55 THEN '45-54'
            WHEN cardholder_age < 65 THEN '55-64' ELSE '65+' END AS age_group,
       CAST(count(is_fraud) AS BIGINT) AS tx_count, {AVG_AMOUNT}, {FRAUDS}, {FRAUD_AMOUNT}, {FRAUD_SHARE}
FROM fx WHERE cardholder_age >= 0 AND cardholder_age < 200 GROUP BY 1"""
    ),
)
def by_age_tier(spark, folder):
    df = transactions(spark, folder).transform(features_ops.add_cardholder)
    return rounded(P.by_age_tier(df), fraud_amount=2, avg_amount=FINE)


@query(
    "agg_19_gender_risk",
    on_tx(
        f"SELECT gender, {LABELLED}, {FRAUDS}, {AVG_AMOUNT}, {FRAUD_AMOUNT}, {FRAUD_SHARE} "
        "FROM tx GROUP BY gender"
    ),
)
def gender_risk(spark, folder):
    return rounded(P.by_gender(transactions(spark, folder)), fraud_amount=2, avg_amount=FINE)


_MONTHS = f""", months AS (
  SELECT strftime(transaction_ts, '%Y-%m') AS year_month, count(is_fraud) AS tx_count,
         sum(amount) AS total_spend, avg(amount) AS avg_amount, sum(is_fraud) AS fraud_count,
         {FRAUD_AMOUNT}, {FRAUD_SHARE}
  FROM tx_orders GROUP BY 1),
series AS (SELECT *, row_number() OVER (ORDER BY year_month) - 1 AS t FROM months),
line AS (SELECT regr_slope(total_spend, t) AS s, regr_intercept(total_spend, t) AS i FROM series)
"""


@query(
    "agg_29_monthly_risk",
    on_orders(
        _MONTHS
        + f"""SELECT year_month, CAST(tx_count AS BIGINT) AS tx_count, round(total_spend, 2) AS total_spend,
       {fine('avg_amount')} AS avg_amount, CAST(fraud_count AS BIGINT) AS fraud_count, fraud_amount,
       {fine('fraud_count * 100.0 / tx_count')} AS fraud_rate, CAST(t AS INT) AS t, round(i + s * t, 2) AS spend_trend
FROM series, line"""
    ),
)
def monthly_risk(spark, folder):
    return rounded(P.by_month(order_lines(spark, folder)), 2, avg_amount=FINE, fraud_rate=FINE)


_KPIS = """SELECT CAST(count(*) AS BIGINT) AS total_tx, CAST(sum(is_fraud) AS BIGINT) AS fraud_tx,
       CAST(count(DISTINCT card_id) AS BIGINT) AS unique_cards,
       CAST(count(DISTINCT merchant) AS BIGINT) AS unique_merchants,
       CAST(count(DISTINCT state) AS BIGINT) AS num_states,
       CAST(count(DISTINCT category) AS BIGINT) AS num_categories,
       CAST(count(DISTINCT card_id) FILTER (is_fraud = 1) AS BIGINT) AS cards_with_fraud,
       round(avg(amount), 6) AS avg_amount,
       strftime(min(transaction_ts), '%b %Y') AS first_month, strftime(max(transaction_ts), '%b %Y') AS last_month,
       round(sum(amount), 2) AS total_spend, round(sum(amount) FILTER (is_fraud = 1), 2) AS fraud_amount_total,
       round(avg(amount) FILTER (is_fraud = 1), 6) AS fraud_amount_avg,
       round(avg(amount) FILTER (is_fraud = 0), 6) AS legit_amount_avg,
       round(sum(is_fraud) * 100.0 / count(*), 6) AS fraud_rate,
       round(sum(amount) FILTER (is_fraud = 1) * 100.0 / sum(amount), 6) AS fraud_loss_pct
FROM """


@query("agg_38_portfolio_kpis", on_tx(_KPIS + "tx"))
def portfolio_kpis(spark, folder):
    df = P.kpis(stored_transactions(spark, folder))
    return rounded(df, total_spend=2, fraud_amount_total=2)


@query(
    "agg_39_detection_value",
    on_tx(
        """, totals AS (
  SELECT CAST(sum(is_fraud) AS BIGINT) AS fraud_tx, sum(amount) FILTER (is_fraud = 1) AS exposure FROM tx)
SELECT fraud_tx, round(exposure, 2) AS exposure, round(exposure * 0.987::DOUBLE, 2) AS caught,
       round(exposure * (1 - 0.987::DOUBLE), 2) AS missed,
       CAST(floor(fraud_tx * 0.987::DOUBLE * (1 - 0.912::DOUBLE) / 0.912::DOUBLE) AS BIGINT) AS false_positives
FROM totals"""
    ),
)
def detection_value(spark, folder):
    return rounded(P.detection_value(transactions(spark, folder)), 2)


@query(
    "agg_40_category_risk",
    on_tx(
        f"SELECT category, {LABELLED}, {FRAUDS}, {AVG_AMOUNT}, {FRAUD_AMOUNT}, {FRAUD_SHARE} "
        "FROM tx GROUP BY category"
    ),
)
def category_risk(spark, folder):
    return rounded(P.by_category(transactions(spark, folder)), fraud_amount=2, avg_amount=FINE)


@query(
    "agg_41_hour_risk",
    on_tx(
        f"SELECT CAST(hour(transaction_ts) AS INT) AS tx_hour, {LABELLED}, {FRAUDS}, {FRAUD_AMOUNT}, "
        f"{FRAUD_SHARE} FROM tx GROUP BY 1"
    ),
)
def hour_risk(spark, folder):
    return rounded(P.by_hour(transactions(spark, folder)), fraud_amount=2)


@query(
    "agg_42_weekday_risk",
    on_tx(
        f"SELECT CAST(isodow(transaction_ts) - 1 AS INT) AS tx_dow, {LABELLED}, {FRAUDS}, {FRAUD_SHARE}, "
        "['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][isodow(transaction_ts)] AS day_name "
        "FROM tx GROUP BY 1, 5"
    ),
)
def weekday_risk(spark, folder):
    return rounded(P.by_weekday(transactions(spark, folder)))


_STATES = (
    f"SELECT state, {LABELLED}, {FRAUDS}, {AVG_AMOUNT}, {FRAUD_AMOUNT}, {FRAUD_SHARE} "
    "FROM tx GROUP BY state HAVING count(is_fraud) >= 100 "
)


@query("agg_43_riskiest_states", on_tx(_STATES + "ORDER BY fraud_rate DESC, state LIMIT 20"))
def riskiest_states(spark, folder):
    return rounded(P.riskiest_states(transactions(spark, folder)), fraud_amount=2, avg_amount=FINE)


@query("agg_44_exposed_states", on_tx(_STATES + "ORDER BY fraud_amount DESC, state LIMIT 20"))
def exposed_states(spark, folder):
    return rounded(P.most_exposed_states(transactions(spark, folder)), fraud_amount=2, avg_amount=FINE)


@query(
    "agg_45_amount_tier_risk",
    on_tx(
        f"""SELECT CASE WHEN amount < 10 THEN '< $10' WHEN amount < 50 THEN '$10-50' WHEN amount < 100 THEN '$50-100'
            WHEN amount < 250 THEN '$100-250' WHEN amount < 500 THEN '$250-500' ELSE '> $500' END AS amount_tier,
       {LABELLED}, {FRAUDS}, {FRAUD_AMOUNT}, {FRAUD_SHARE}
FROM tx WHERE amount >= 0 GROUP BY 1"""
    ),
)
def amount_tier_risk(spark, folder):
    return rounded(P.by_amount_tier(transactions(spark, folder)), fraud_amount=2)


@query(
    "agg_46_time_of_day_risk",
    on_features(
        f"SELECT tx_time_of_day, {LABELLED}, {FRAUDS}, {AVG_AMOUNT}, {FRAUD_SHARE} FROM fx GROUP BY 1"
    ),
)
def time_of_day_risk(spark, folder):
    return rounded(P.by_time_of_day(transactions(spark, folder)), avg_amount=FINE)


@query(
    "agg_47_merchant_risk",
    on_tx(
        f"SELECT merchant, CAST(count(is_fraud) AS BIGINT) AS tx_count, {FRAUDS}, {FRAUD_AMOUNT}, {FRAUD_SHARE}, "
        "replace(merchant, 'fraud_', '') AS merchant_short FROM tx GROUP BY merchant "
        "HAVING count(is_fraud) >= 20 ORDER BY fraud_rate DESC, merchant LIMIT 15"
    ),
)
def merchant_risk(spark, folder):
    return rounded(P.riskiest_merchants(transactions(spark, folder)), fraud_amount=2)


@query(
    "agg_48_merchant_rate_marks",
    on_tx(
        """, rates AS (SELECT sum(is_fraud) * 100.0 / count(is_fraud) AS fraud_rate FROM tx GROUP BY merchant
                     HAVING count(is_fraud) >= 20)
SELECT round(avg(fraud_rate), 6) AS avg_fraud_rate, round(quantile_cont(fraud_rate, 0.9), 6) AS p90_fraud_rate
FROM rates"""
    ),
)
def merchant_rate_marks(spark, folder):
    return rounded(P.merchant_rate_marks(transactions(spark, folder)))


@query(
    "agg_49_cards",
    on_tx(
        "SELECT card_id, CAST(count(is_fraud) AS BIGINT) AS tx_count, round(sum(amount), 2) AS total_spend, "
        f"{AVG_AMOUNT}, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, {FRAUD_SHARE} "
        "FROM tx GROUP BY card_id"
    ),
)
def cards(spark, folder):
    return rounded(P.by_card(transactions(spark, folder)), total_spend=2, avg_amount=FINE)


@query(
    "agg_50_high_velocity_cards",
    on_tx(
        """, cards AS (SELECT card_id, count(is_fraud) AS n FROM tx GROUP BY card_id),
mark AS (SELECT CAST(floor(quantile_cont(n, 0.99)) AS BIGINT) AS p99 FROM cards)
SELECT (SELECT p99 FROM mark) AS p99_tx_count, CAST(count(*) AS BIGINT) AS high_velocity_cards
FROM cards WHERE n >= (SELECT p99 FROM mark)"""
    ),
)
def high_velocity_cards(spark, folder):
    return P.high_velocity_cards(transactions(spark, folder))


_HOURS = ", ".join(
    f"round(coalesce(avg(is_fraud) FILTER (hour(transaction_ts) = {h}), 0) * 100, 6) AS h{h}"
    for h in range(24)
)


@query(
    "agg_51_weekday_hour_heatmap",
    on_tx(
        f"SELECT CAST(isodow(transaction_ts) - 1 AS INT) AS tx_dow, {_HOURS} FROM tx GROUP BY 1"
    ),
)
def weekday_hour_heatmap(spark, folder):
    return rounded(P.weekday_hour_heatmap(transactions(spark, folder)))


_DISTINCT = ["card_id", "merchant", "state", "category"]


@query(
    "agg_52_distinct_counts",
    on_tx(
        "SELECT "
        + ", ".join(f"CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_{c}" for c in _DISTINCT)
        + " FROM tx"
    ),
)
def distinct_counts(spark, folder):
    return P.distinct_counts(transactions(spark, folder), _DISTINCT)


@query("agg_53_approximate_distinct_counts")
def approximate_distinct_counts(spark, folder):
    return P.approximate_distinct_counts(stored_order_lines(spark, folder), ["transaction_id", *_DISTINCT])


_COUNTED = ["transaction_id", *_DISTINCT]


@query(
    "agg_53_approximation_error",
    on_orders(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS exact, true AS within_bounds "
            "FROM tx_orders"
            for c in _COUNTED
        )
    ),
)
def approximation_error(spark, folder):
    """Exact counts, and whether the approximate ones are within three deviations of them."""
    df = stored_order_lines(spark, folder)
    both = P.distinct_counts(df, _COUNTED).select(
        "*", P.approximate_distinct_counts(df, _COUNTED, 0.02).select(F.struct("*")).scalar().alias("a")
    )
    lines = []
    for c in _COUNTED:
        exact, approximate = F.col(f"distinct_{c}"), F.col("a").getField(f"approx_{c}")
        within = F.abs(approximate - exact) <= exact * (3 * 0.02)
        lines.append(
            F.struct(
                F.lit(c).alias("column_name"), exact.alias("exact"), within.alias("within_bounds")
            )
        )
    return both.select(F.inline(F.array(*lines)))
