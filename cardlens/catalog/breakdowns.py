"""Exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.catalog.registry import FINE, query, rounded
from cardlens.catalog.sql import AVG_AMOUNT, CARD_PROFILES, on_features, on_orders, on_tx
from cardlens.catalog.stored import stored_order_lines, stored_transactions
from cardlens.operators import exploration as E
from cardlens.operators import features as features_ops
from cardlens.operators import models
from cardlens.operators import portfolio
from cardlens.operators import statistics as stats
from cardlens.sources.star import order_lines, transactions

NUMERIC = ["amount", "is_fraud", "lat", "long", "city_pop", "unix_time", "merch_lat", "merch_long"]


@query(
    "agg_01_shape",
    on_tx("SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(17 AS INT) AS column_count FROM tx"),
)
def shape(spark, folder):
    return E.shape(transactions(spark, folder))


@query(
    "agg_02_describe",
    on_tx(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, "
            f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
            f"round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max "
            "FROM tx"
            for c in NUMERIC
        )
    ),
)
def describe(spark, folder):
    return rounded(E.describe(transactions(spark, folder), NUMERIC), 4)


@query(
    "agg_03_class_balance",
    on_tx(
        """SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (is_fraud = 0) AS BIGINT) AS legit,
       CAST(count(*) FILTER (is_fraud = 1) AS BIGINT) AS fraud,
       round(count(*) FILTER (is_fraud = 0) * 100.0 / count(*), 6) AS legit_pct,
       round(count(*) FILTER (is_fraud = 1) * 100.0 / count(*), 6) AS fraud_rate_pct,
       round(count(*) FILTER (is_fraud = 0) * 1.0 / nullif(count(*) FILTER (is_fraud = 1), 0), 6)
           AS legit_per_fraud
FROM tx"""
    ),
)
def class_balance(spark, folder):
    return rounded(E.class_balance(transactions(spark, folder)))


@query(
    "agg_04_amount_by_label",
    on_tx(
        """SELECT CAST(is_fraud AS INT) AS is_fraud, round(avg(amount), 2) AS mean,
       round(quantile_disc(amount, 0.5), 2) AS median, round(stddev_samp(amount), 2) AS std,
       round(min(amount), 2) AS min, round(quantile_disc(amount, 0.25), 2) AS p25,
       round(quantile_disc(amount, 0.75), 2) AS p75, round(quantile_disc(amount, 0.95), 2) AS p95,
       round(max(amount), 2) AS max
FROM tx GROUP BY is_fraud"""
    ),
)
def amount_by_label(spark, folder):
    return E.amount_by_label(transactions(spark, folder))


@query(
    "agg_05_by_hour",
    on_tx(
        "SELECT CAST(hour(transaction_ts) AS INT) AS tx_hour, CAST(count(*) AS BIGINT) AS tx_count, "
        "round(avg(is_fraud) * 100, 6) AS fraud_rate_pct FROM tx GROUP BY 1"
    ),
)
def by_hour(spark, folder):
    return rounded(E.by_hour(transactions(spark, folder)))


@query(
    "agg_06_riskiest_hours",
    on_tx(
        "SELECT CAST(hour(transaction_ts) AS INT) AS tx_hour, CAST(count(*) AS BIGINT) AS tx_count, "
        "round(avg(is_fraud) * 100, 6) AS fraud_rate_pct FROM tx GROUP BY 1 "
        "ORDER BY avg(is_fraud) DESC, tx_hour LIMIT 5"
    ),
)
def riskiest_hours(spark, folder):
    return rounded(E.riskiest_hours(transactions(spark, folder)))


@query(
    "agg_07_by_weekday",
    on_tx(
        "SELECT CAST(dayofweek(transaction_ts) + 1 AS INT) AS tx_day_of_week, "
        "CAST(count(*) AS BIGINT) AS tx_count, round(avg(is_fraud) * 100, 6) AS fraud_rate_pct, "
        "['Sun','Mon','Tue','Wed','Thu','Fri','Sat'][dayofweek(transaction_ts) + 1] AS day_label "
        "FROM tx GROUP BY 1, 4"
    ),
)
def by_weekday(spark, folder):
    return rounded(E.by_weekday(transactions(spark, folder)))


@query(
    "agg_08_by_month",
    on_orders(
        "SELECT strftime(transaction_ts, '%Y-%m') AS tx_month_str, CAST(count(*) AS BIGINT) AS tx_count, "
        "round(avg(is_fraud) * 100, 6) AS fraud_rate_pct FROM tx_orders GROUP BY 1"
    ),
)
def by_month(spark, folder):
    return rounded(E.by_month(order_lines(spark, folder)))


@query(
    "agg_09_category_breakdown",
    on_tx(
        "SELECT category, CAST(count(*) AS BIGINT) AS tx_count, round(avg(amount), 2) AS avg_amount, "
        "round(avg(is_fraud) * 100, 3) AS fraud_rate_pct, round(sum(amount), 2) AS total_spend "
        "FROM tx GROUP BY category"
    ),
)
def by_category(spark, folder):
    return E.by_category(transactions(spark, folder))


@query(
    "agg_10_riskiest_merchants",
    on_tx(
        "SELECT merchant, CAST(count(*) AS BIGINT) AS tx_count, "
        "round(avg(is_fraud) * 100, 3) AS fraud_rate_pct FROM tx GROUP BY merchant "
        "HAVING count(*) >= 50 ORDER BY fraud_rate_pct DESC, merchant LIMIT 10"
    ),
)
def riskiest_merchants(spark, folder):
    return E.riskiest_merchants(transactions(spark, folder))


@query(
    "agg_11_busiest_states",
    on_tx(
        "SELECT state, CAST(count(*) AS BIGINT) AS tx_count, "
        "round(avg(is_fraud) * 100, 3) AS fraud_rate_pct FROM tx GROUP BY state "
        "ORDER BY tx_count DESC, state LIMIT 15"
    ),
)
def busiest_states(spark, folder):
    return E.busiest_states(transactions(spark, folder))


@query(
    "agg_12_overall_fraud_rate",
    on_tx("SELECT round(avg(is_fraud) * 100, 6) AS fraud_rate_pct FROM tx"),
)
def overall_fraud_rate(spark, folder):
    return rounded(E.overall_fraud_rate(transactions(spark, folder)))


@query(
    "agg_13_by_distance",
    on_features(
        """, bands(dist_bin) AS (VALUES ('< 10 km'), ('10-50 km'), ('50-100 km'), ('100-300 km')),
grouped AS (
  SELECT CASE WHEN merch_distance_km < 10 THEN '< 10 km' WHEN merch_distance_km < 50 THEN '10-50 km'
              WHEN merch_distance_km < 100 THEN '50-100 km' ELSE '100-300 km' END AS dist_bin,
         CAST(count(*) AS BIGINT) AS tx_count, round(avg(is_fraud) * 100, 3) AS fraud_rate_pct
  FROM fx GROUP BY 1)
SELECT dist_bin, tx_count, fraud_rate_pct FROM bands LEFT JOIN grouped USING (dist_bin)"""
    ),
)
def by_distance(spark, folder):
    return E.by_distance(transactions(spark, folder).transform(features_ops.add_distance))


@query(
    "agg_14_by_distance_five_bands",
    on_features(
        """SELECT CASE WHEN merch_distance_km < 10 THEN '< 10 km'
            WHEN merch_distance_km < 50 THEN '10–50 km' WHEN merch_distance_km < 100 THEN '50–100 km'
            WHEN merch_distance_km < 300 THEN '100–300 km' ELSE '> 300 km' END AS dist_bin,
       CAST(count(*) AS BIGINT) AS total, round(avg(amount_log1p), 2) AS avg_amount_log1p,
       round(avg(is_fraud) * 100, 3) AS fraud_rate_pct
FROM fx GROUP BY 1"""
    ),
)
def by_distance_five_bands(spark, folder):
    df = transactions(spark, folder).transform(features_ops.add_distance)
    return E.by_distance_five_bands(df.transform(features_ops.add_amount_shape))


_AGE = """CASE WHEN cardholder_age < 25 THEN 'Under 25' WHEN cardholder_age < 35 THEN '25{0}34'
              WHEN cardholder_age < 45 THEN '35{0}44' WHEN cardholder_age < 55 THEN '45{0}54'
              WHEN cardholder_age < 65 THEN '55{0}64' ELSE '65+' END AS age_group"""


@query(
    "agg_16_by_age",
    on_features(
        f""", bands(age_group) AS (
  VALUES ('Under 25'), ('25-34'), ('35-44'), ('45-54'), ('55-64'), ('65+')),
grouped AS (
  SELECT {_AGE.format('-')}, CAST(count(*) AS BIGINT) AS tx_count,
         round(avg(amount), 2) AS avg_amount, round(avg(is_fraud) * 100, 3) AS fraud_rate_pct
  FROM fx GROUP BY 1)
SELECT age_group, tx_count, avg_amount, fraud_rate_pct FROM bands LEFT JOIN grouped USING (age_group)"""
    ),
)
def by_age(spark, folder):
    return E.by_age(transactions(spark, folder).transform(features_ops.add_cardholder))


@query(
    "agg_16_by_age_log_amount",
    on_features(
        f"""SELECT {_AGE.format('–')}, CAST(count(*) AS BIGINT) AS tx_count,
       round(avg(amount_log1p), 2) AS avg_amount_log1p, round(avg(is_fraud) * 100, 3) AS fraud_rate_pct
FROM fx GROUP BY 1"""
    ),
)
def by_age_log_amount(spark, folder):
    df = transactions(spark, folder).transform(features_ops.add_cardholder)
    return E.by_age_log_amount(df.transform(features_ops.add_amount_shape))


@query(
    "agg_18_by_gender",
    on_tx(
        "SELECT gender, CAST(count(*) AS BIGINT) AS tx_count, round(avg(amount), 2) AS avg_amount, "
        "round(avg(is_fraud) * 100, 3) AS fraud_rate_pct, round(sum(amount), 2) AS total_spend "
        "FROM tx GROUP BY gender"
    ),
)
def by_gender(spark, folder):
    return E.by_gender(transactions(spark, folder))


@query(
    "agg_20_gender_encoding",
    on_features(
        "SELECT gender, gender_encoded, CAST(count(*) AS BIGINT) AS n FROM fx "
        "GROUP BY gender, gender_encoded"
    ),
)
def gender_encoding(spark, folder):
    return E.gender_encoding(transactions(spark, folder).transform(features_ops.add_cardholder))


_CORRELATED = {
    "amount": "amount",
    "city_pop": "city_pop",
    "is_fraud": "is_fraud",
    "age": "cardholder_age",
    "dist_km": "merch_distance_km",
    "tx_hour": "tx_hour",
    "tx_month_num": "tx_month",
}
_COMPLETE = ", ".join(f"CAST({x} AS DOUBLE) AS {name}" for name, x in _CORRELATED.items())
_COMPLETE = (
    f", wide AS (SELECT {_COMPLETE} FROM fx), complete AS (SELECT * FROM wide WHERE "
    + " AND ".join(f"{name} IS NOT NULL" for name in _CORRELATED)
    + ")\n"
)


def _pair(a: str, b: str) -> str:
    if a == b:
        return f"CASE WHEN stddev_samp({a}) > 0 THEN 1.0::DOUBLE END"
    return f"round(covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0), 6)"


@query(
    "agg_21_correlation_matrix",
    on_features(
        _COMPLETE
        + "\nUNION ALL ".join(
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_pair(a, b)} AS r FROM complete"
            for a in _CORRELATED
            for b in _CORRELATED
        )
    ),
)
def correlation_matrix(spark, folder):
    df = stats.correlation_input(transactions(spark, folder))
    return rounded(stats.correlation_matrix(df, df.columns))


@query(
    "agg_21_vector_correlation_matrix",
    on_features(
        _COMPLETE
        + "\nUNION ALL ".join(
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, {'min(1.0::DOUBLE)' if a == b else _pair(a, b)} AS r "
            "FROM complete"
            for a in _CORRELATED
            for b in _CORRELATED
        )
    ),
)
def vector_correlation_matrix(spark, folder):
    df = stats.correlation_input(transactions(spark, folder))
    return rounded(stats.vector_correlation_matrix(df, df.columns))


@query(
    "agg_22_label_correlations",
    on_features(
        _COMPLETE
        + "\nUNION ALL ".join(
            f"SELECT '{b}' AS feature, {_pair('is_fraud', b)} AS r FROM complete"
            for b in _CORRELATED
            if b != "is_fraud"
        )
    ),
)
def label_correlations(spark, folder):
    df = stats.correlation_input(transactions(spark, folder))
    return rounded(stats.label_correlations(df, df.columns))


@query(
    "agg_23_amount_moments",
    on_tx("SELECT round(avg(amount), 6) AS mean, round(stddev_samp(amount), 6) AS stddev FROM tx"),
)
def amount_moments(spark, folder):
    return rounded(features_ops.amount_moments(transactions(spark, folder)))


@query(
    "agg_24_merchant_rates",
    on_tx(
        "SELECT merchant, round(avg(is_fraud), 6) AS merchant_fraud_rate, "
        "CAST(count(*) AS BIGINT) AS merchant_tx_count FROM tx GROUP BY merchant "
        "ORDER BY avg(is_fraud) DESC, merchant LIMIT 10"
    ),
)
def merchant_rates(spark, folder):
    return rounded(E.riskiest_merchant_rates(transactions(spark, folder)))


@query("agg_26_card_profiles", on_features(CARD_PROFILES + "SELECT * FROM complete"))
def card_profiles(spark, folder):
    df = (
        transactions(spark, folder)
        .transform(features_ops.add_temporal)
        .transform(features_ops.add_amount_shape)
        .transform(features_ops.add_distance)
        .transform(features_ops.add_cardholder)
    )
    return models.card_profiles(df)


@query(
    "agg_28_monthly_series",
    on_orders(
        """SELECT strftime(transaction_ts, '%Y-%m') AS year_month, CAST(count(*) AS BIGINT) AS tx_count,
       round(sum(ln(1 + amount)), 2) AS total_spend_log1p, round(avg(ln(1 + amount)), 2) AS avg_amount_log1p,
       CAST(sum(is_fraud) AS BIGINT) AS fraud_count, round(avg(is_fraud) * 100, 3) AS fraud_rate_pct
FROM tx_orders GROUP BY 1"""
    ),
)
def monthly_series(spark, folder):
    df = order_lines(spark, folder).transform(features_ops.add_amount_shape)
    return E.monthly_series(df).drop("t")


_MONTHS = """, months AS (
  SELECT strftime(transaction_ts, '%Y-%m') AS year_month, round(sum(ln(1 + amount)), 2) AS spend,
         round(avg(is_fraud) * 100, 3) AS rate
  FROM tx_orders GROUP BY 1),
series AS (SELECT *, row_number() OVER (ORDER BY year_month) - 1 AS t FROM months)
"""


@query(
    "agg_30_trend_line",
    on_orders(
        _MONTHS
        + """SELECT 'spend' AS measure, round(regr_slope(spend, t), 4) AS slope,
       round(regr_intercept(spend, t), 4) AS intercept FROM series
UNION ALL SELECT 'fraud_rate', round(regr_slope(rate, t), 4), round(regr_intercept(rate, t), 4) FROM series"""
    ),
)
def trend_line(spark, folder):
    df = order_lines(spark, folder).transform(features_ops.add_amount_shape)
    months = E.monthly_series(df)
    lines = [
        stats.trend(months, column).select(F.lit(name).alias("measure"), "slope", "intercept")
        for name, column in (("spend", "total_spend_log1p"), ("fraud_rate", "fraud_rate_pct"))
    ]
    return rounded(lines[0].unionByName(lines[1]), 4)


@query(
    "agg_30_fitted_trend",
    on_orders(
        _MONTHS
        + """, line AS (SELECT regr_slope(spend, t) AS s, regr_intercept(spend, t) AS i,
                     regr_slope(rate, t) AS rs, regr_intercept(rate, t) AS ri FROM series)
SELECT year_month, CAST(t AS INT) AS t, round(spend, 2) AS total_spend_log1p, round(rate, 3) AS fraud_rate_pct,
       round(i + s * t, 3) AS spend_trend, round(ri + rs * t, 3) AS fraud_trend
FROM series, line"""
    ),
)
def fitted_trend(spark, folder):
    df = order_lines(spark, folder).transform(features_ops.add_amount_shape)
    months = E.monthly_series(df).select("year_month", "t", "total_spend_log1p", "fraud_rate_pct")
    fitted = portfolio.with_trend(months, "total_spend_log1p", "spend_trend")
    return rounded(portfolio.with_trend(fitted, "fraud_rate_pct", "fraud_trend"), 3)


_PEOPLE = """, top AS (SELECT category FROM fx GROUP BY category ORDER BY count(*) DESC, category LIMIT 6),
people AS (
  SELECT category, amount_log1p, CASE WHEN CAST(transaction_id AS BIGINT) % 11 = 0 THEN 'X'
         WHEN CAST(transaction_id AS BIGINT) % 13 = 0 THEN NULL ELSE gender END AS gender FROM fx)
"""


@query(
    "agg_31_gender_by_category",
    on_features(
        _PEOPLE
        + """SELECT category, gender, round(avg(amount_log1p), 2) AS avg_amount_log1p
FROM people WHERE category IN (SELECT category FROM top) GROUP BY category, gender"""
    ),
)
def gender_by_category(spark, folder):
    """With a third gender and missing ones among the rows."""
    return E.gender_by_top_category(_people(spark, folder))


@query(
    "agg_31_gender_by_category_pivot",
    on_features(
        _PEOPLE
        + "SELECT category, "
        + ", ".join(
            f'round(avg(amount_log1p) FILTER (coalesce(gender, \'missing\') = \'{g}\'), 2) AS "{g}"'
            for g in ("F", "M", "X", "missing")
        )
        + " FROM people WHERE category IN (SELECT category FROM top) GROUP BY category"
    ),
)
def gender_pivot(spark, folder):
    """The report as a table with a column for each gender."""
    return E.gender_pivot(_people(spark, folder))


def _people(spark, folder) -> DataFrame:
    number = F.col("transaction_id").cast("bigint")
    gender = F.when(number % 11 == 0, "X").when(number % 13 != 0, F.col("gender"))
    df = transactions(spark, folder).transform(features_ops.add_amount_shape)
    return df.withColumn("gender", gender)


@query(
    "agg_32_category_by_state",
    on_orders(
        f"SELECT category, state, CAST(count(*) AS BIGINT) AS tx_count, {AVG_AMOUNT}, "
        "CAST(sum(is_fraud) AS BIGINT) AS fraud_count, round(stddev_samp(amount), 5) AS std_amount "
        "FROM tx_orders GROUP BY category, state"
    ),
)
def category_by_state(spark, folder):
    return rounded(E.by_category_and_state(stored_order_lines(spark, folder)), 5, avg_amount=FINE)


@query(
    "agg_33_reused_pair",
    on_orders(
        "SELECT category AS name, round(avg(amount), 2) AS measure FROM tx_orders GROUP BY category "
        "UNION ALL SELECT state, CAST(sum(is_fraud) AS DOUBLE) FROM tx_orders GROUP BY state"
    ),
)
def reused_pair(spark, folder):
    df = stored_order_lines(spark, folder).select("category", "state", "amount", "is_fraud")
    means = E.mean_amount_by_category(df).toDF("name", "measure")
    frauds = E.frauds_by_state(df).toDF("name", "measure")
    return rounded(means.unionByName(frauds.withColumn("measure", F.col("measure").cast("double"))), 2)


@query(
    "agg_34_fraud_by_category_and_state",
    on_orders(
        f"SELECT category, state, CAST(count(*) AS BIGINT) AS fraud_count, {AVG_AMOUNT} "
        "FROM tx_orders WHERE is_fraud = 1 GROUP BY category, state"
    ),
)
def fraud_by_category_and_state(spark, folder):
    return rounded(E.fraud_by_category_and_state(stored_order_lines(spark, folder)), FINE)


@query(
    "agg_35_category_lookup",
    on_orders(
        "SELECT category, round(avg(is_fraud) * 100, 3) AS cat_fraud_rate, "
        "round(avg(amount), 2) AS cat_avg_amount, CAST(count(*) AS BIGINT) AS cat_tx_count "
        "FROM tx_orders GROUP BY category"
    ),
)
def category_lookup(spark, folder):
    return E.category_lookup(stored_order_lines(spark, folder))


@query(
    "agg_36_state_category_hour",
    on_tx(
        "SELECT state, category, CAST(hour(transaction_ts) AS INT) AS hr, round(sum(amount), 2) AS total, "
        "CAST(count(*) AS BIGINT) AS cnt FROM tx GROUP BY 1, 2, 3"
    ),
)
def state_category_hour(spark, folder):
    return rounded(E.by_state_category_hour(stored_transactions(spark, folder)), 2)


@query(
    "agg_37_card_category_hour",
    on_tx(
        "SELECT card_id, category, CAST(hour(transaction_ts) AS INT) AS hr, CAST(count(*) AS BIGINT) AS cnt, "
        "round(sum(amount), 2) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud_sum FROM tx GROUP BY 1, 2, 3"
    ),
)
def card_category_hour(spark, folder):
    return rounded(E.by_card_category_hour(stored_transactions(spark, folder)), 2)
