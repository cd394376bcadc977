"""Feature expressions, velocity windows, the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlens.catalog.registry import query, rounded
from cardlens.catalog.sql import on_features, on_orders, on_tx
from cardlens.functions import expressions as X
from cardlens.operators import features as ops
from cardlens.sources.star import order_lines, transactions

@query(
    "fea_01_calendar",
    on_features("SELECT transaction_id, tx_hour, tx_day_of_week, tx_month FROM fx"),
)
def calendar(spark, folder):
    df = transactions(spark, folder).transform(ops.add_temporal)
    return df.select("transaction_id", "tx_hour", "tx_day_of_week", "tx_month")


@query("fea_02_weekend", on_features("SELECT transaction_id, tx_is_weekend FROM fx"))
def weekend(spark, folder):
    return transactions(spark, folder).transform(ops.add_temporal).select("transaction_id", "tx_is_weekend")


@query("fea_03_time_of_day", on_features("SELECT transaction_id, tx_time_of_day FROM fx"))
def time_of_day(spark, folder):
    return transactions(spark, folder).transform(ops.add_temporal).select("transaction_id", "tx_time_of_day")


@query(
    "fea_04_log_amount",
    on_features("SELECT transaction_id, round(amount_log1p, 6) AS amount_log1p FROM fx"),
)
def log_amount(spark, folder):
    df = transactions(spark, folder).transform(ops.add_amount_shape)
    return rounded(df.select("transaction_id", "amount_log1p"))


@query(
    "fea_05_amount_zscore",
    on_tx(
        """, m AS (SELECT avg(amount) AS mean, stddev_samp(amount) AS sd FROM tx)
SELECT transaction_id, round((amount - mean) / sd, 6) AS amount_zscore FROM tx, m"""
    ),
)
def amount_zscore(spark, folder):
    df = transactions(spark, folder).transform(ops.add_amount_zscore)
    return rounded(df.select("transaction_id", "amount_zscore"))


@query("fea_06_amount_bin", on_features("SELECT transaction_id, amount_bin FROM fx"))
def amount_bin(spark, folder):
    return transactions(spark, folder).transform(ops.add_amount_shape).select("transaction_id", "amount_bin")


@query(
    "fea_07_merchant_distance",
    on_features("SELECT transaction_id, round(merch_distance_km, 6) AS merch_distance_km FROM fx"),
)
def merchant_distance(spark, folder):
    df = transactions(spark, folder).transform(ops.add_distance)
    return rounded(df.select("transaction_id", "merch_distance_km"))


@query("fea_08_cardholder_age", on_features("SELECT transaction_id, cardholder_age FROM fx"))
def cardholder_age(spark, folder):
    return transactions(spark, folder).transform(ops.add_cardholder).select("transaction_id", "cardholder_age")


@query("fea_09_gender_flag", on_features("SELECT transaction_id, gender_encoded FROM fx"))
def gender_flag(spark, folder):
    return transactions(spark, folder).transform(ops.add_cardholder).select("transaction_id", "gender_encoded")


@query(
    "fea_10_merchant_target_rate",
    on_orders(
        """, rates AS (SELECT merchant, avg(is_fraud) AS rate FROM tx_orders GROUP BY merchant)
SELECT merchant, CAST(is_fraud AS INT) AS is_fraud, round(rate, 6) AS merchant_fraud_rate,
       CAST(count(*) AS BIGINT) AS n
FROM tx_orders JOIN rates USING (merchant) GROUP BY ALL"""
    ),
)
def merchant_target_rate(spark, folder):
    df = order_lines(spark, folder).select("transaction_id", "merchant", "is_fraud")
    encoded = rounded(ops.add_merchant_rate(df))
    return encoded.groupBy("merchant", "is_fraud", "merchant_fraud_rate").agg(F.count("*").alias("n"))


@query(
    "fea_11_category_index",
    on_tx(
        """, labels AS (
  SELECT category, row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS idx FROM tx GROUP BY category)
SELECT transaction_id, category, CAST(idx AS DOUBLE) AS category_encoded FROM tx LEFT JOIN labels USING (category)"""
    ),
)
def category_index(spark, folder):
    df = transactions(spark, folder).select("transaction_id", "category")
    return ops.add_category_index(df)


@query(
    "fea_12_month_keys",
    on_orders(
        "SELECT strftime(transaction_ts, '%Y-%m') AS month_key, strftime(transaction_ts, '%Y-%m') AS month_key_parts, "
        "CAST(count(*) AS BIGINT) AS n FROM tx_orders GROUP BY 1, 2"
    ),
)
def month_keys(spark, folder):
    at = F.col("transaction_ts")
    keys = [X.month_key(at).alias("month_key"), X.month_key_from_parts(at).alias("month_key_parts")]
    return order_lines(spark, folder).groupBy(*keys).agg(F.count("*").alias("n"))


@query("fea_13_epoch_seconds", on_features("SELECT transaction_id, tx_unix FROM fx"))
def epoch_seconds(spark, folder):
    return transactions(spark, folder).transform(ops.add_epoch_seconds).select("transaction_id", "tx_unix")


_VELOCITY = """count(transaction_id) OVER lastHour AS velocity_n, sum(amount) OVER lastHour AS velocity_sum FROM fx
  WINDOW lastHour AS (PARTITION BY card_id ORDER BY tx_unix RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING)"""


@query(
    "win_01_velocity_count",
    on_features(
        f""", v AS (SELECT transaction_id, {_VELOCITY})
SELECT transaction_id, CAST(velocity_n AS BIGINT) AS card_tx_count_1h FROM v"""
    ),
)
def velocity_count(spark, folder):
    df = transactions(spark, folder).transform(ops.add_epoch_seconds).transform(ops.add_velocity)
    return df.select("transaction_id", "card_tx_count_1h")


@query(
    "win_02_velocity_amount",
    on_features(
        f""", v AS (SELECT transaction_id, {_VELOCITY})
SELECT transaction_id, round(velocity_sum, 6) AS card_amount_sum_1h FROM v"""
    ),
)
def velocity_amount(spark, folder):
    df = transactions(spark, folder).transform(ops.add_epoch_seconds).transform(ops.add_velocity)
    return rounded(df.select("transaction_id", "card_amount_sum_1h"))


@query(
    "fea_14_feature_table",
    on_features(
        f""", v AS (SELECT transaction_id AS vid, {_VELOCITY}),
m AS (SELECT avg(amount) AS mean, stddev_samp(amount) AS sd FROM tx),
rates AS (SELECT merchant, avg(is_fraud) AS rate FROM tx GROUP BY merchant),
labels AS (SELECT category, row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS idx FROM tx GROUP BY category)
SELECT transaction_id, transaction_ts, card_id, merchant, CAST(is_fraud AS INT) AS is_fraud, category, gender, state,
       lat, long, round(merch_lat, 6) AS merch_lat, round(merch_long, 6) AS merch_long, city_pop, dob,
       tx_hour, tx_day_of_week, tx_month, tx_is_weekend, tx_time_of_day, round(amount_log1p, 6) AS amount_log1p,
       round((amount - mean) / sd, 6) AS amount_zscore, amount_bin, round(merch_distance_km, 6) AS merch_distance_km,
       tx_unix, CAST(velocity_n AS BIGINT) AS card_tx_count_1h, round(velocity_sum, 6) AS card_amount_sum_1h,
       cardholder_age, gender_encoded, round(rate, 6) AS merchant_fraud_rate, CAST(idx AS DOUBLE) AS category_encoded
FROM fx JOIN v ON vid = transaction_id JOIN m ON true JOIN rates USING (merchant) JOIN labels USING (category)"""
    ),
)
def feature_table(spark, folder):
    return rounded(ops.feature_table(transactions(spark, folder)))
