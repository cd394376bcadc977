"""Projection, schema standardisation, predicates, data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.catalog.registry import query, rounded
from cardlens.catalog.sql import on_features, on_orders, on_raw, on_tx
from cardlens.catalog.sources import raw_transactions
from cardlens.operators import features as features_ops
from cardlens.operators import prepare, quality, selection
from cardlens.sources.star import order_lines, transactions

def event() -> Column:
    """The number behind a transaction id."""
    return F.col("transaction_id").cast("bigint")


@query(
    "prj_01_normalize_headers",
    on_raw("SELECT trans_num, amt AS amt_usd, row_number AS unnamed_0, is_fraud FROM raw"),
)
def normalize_headers(spark, folder):
    raw = raw_transactions(spark, folder).select(
        F.col("trans_num").alias(" Trans--Num "),
        F.col("amt").alias("Amt (USD)"),
        "`Unnamed: 0`",
        F.col("is_fraud").alias("__IS Fraud"),
    )
    return prepare.normalize_headers(raw)


@query(
    "prj_02_rename_aliases",
    on_raw(
        "SELECT trans_num AS transaction_id, cc_num AS card_id, amt AS amount, is_fraud, "
        "CAST(is_fraud + 1 AS INT) AS class, trans_date_trans_time AS transaction_ts, dob AS date "
        "FROM raw"
    ),
)
def rename_aliases(spark, folder):
    """``class`` stays because the label is there; ``date`` stays because a better alias is."""
    raw = raw_transactions(spark, folder).select(
        "trans_num",
        "cc_num",
        "amt",
        "is_fraud",
        (F.col("is_fraud") + 1).alias("class"),
        "trans_date_trans_time",
        F.col("dob").alias("date"),
    )
    return prepare.rename_aliases(raw)


@query(
    "prj_03_relative_seconds",
    on_tx(
        "SELECT transaction_id, CASE WHEN CAST(transaction_id AS BIGINT) % 11 = 0 THEN NULL ELSE "
        "strftime(make_timestamp(unix_time * 1000000), '%Y-%m-%d %H:%M:%S') END AS transaction_ts "
        "FROM tx"
    ),
)
def relative_seconds(spark, folder):
    seconds = F.concat(F.col("unix_time").cast("string"), F.lit(".5"))
    raw = transactions(spark, folder).select(
        "transaction_id", F.when(event() % 11 == 0, "soon").otherwise(seconds).alias("time")
    )
    typed = prepare.type_columns(raw)
    return typed.select(
        "transaction_id",
        F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_ts"),
    )


@query(
    "prj_04_timestamp_layouts",
    on_tx(
        """SELECT transaction_id, CASE CAST(transaction_id AS BIGINT) % 4
         WHEN 0 THEN strftime(transaction_ts, '%Y-%m-%d %H:%M:%S')
         WHEN 1 THEN strftime(transaction_ts, '%Y-%m-%d %H:%M:00')
         WHEN 2 THEN strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') END AS transaction_ts
FROM tx"""
    ),
)
def timestamp_layouts(spark, folder):
    at = F.col("transaction_ts")
    text = (
        F.when(event() % 4 == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(event() % 4 == 1, F.date_format(at, "MM/dd/yyyy HH:mm"))
        .when(event() % 4 == 2, F.date_format(at, "dd-MM-yyyy HH:mm:ss"))
        .otherwise("no date")
    )
    raw = transactions(spark, folder).select("transaction_id", text.alias("transaction_ts"))
    return prepare.type_columns(raw).select(
        "transaction_id",
        F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_ts"),
    )


@query(
    "prj_05_amount_text",
    on_tx(
        "SELECT transaction_id, CASE WHEN CAST(transaction_id AS BIGINT) % 9 = 0 THEN NULL "
        "ELSE amount END AS amount FROM tx"
    ),
)
def amount_text(spark, folder):
    text = F.when(event() % 9 == 0, "n/a").otherwise(F.col("amount").cast("string"))
    return prepare.type_columns(
        transactions(spark, folder).select("transaction_id", text.alias("amount"))
    )


@query(
    "prj_06_label_text",
    on_tx(
        "SELECT transaction_id, CASE WHEN CAST(transaction_id AS BIGINT) % 9 = 0 THEN NULL "
        "ELSE CAST(is_fraud AS INT) END AS is_fraud FROM tx"
    ),
)
def label_text(spark, folder):
    flag = F.col("is_fraud")
    text = (
        F.when(event() % 9 == 0, "x")
        .when(event() % 2 == 0, flag.cast("double").cast("string"))
        .otherwise(flag.cast("string"))
    )
    return prepare.type_columns(
        transactions(spark, folder).select("transaction_id", text.alias("is_fraud"))
    )


@query(
    "prj_07_content_id",
    on_tx(
        "SELECT merchant, card_id, dob, merch_zipcode, sha256(concat_ws('||', card_id, "
        "coalesce(dob, ''), coalesce(merch_zipcode, ''), merchant)) AS transaction_id FROM tx"
    ),
)
def content_id(spark, folder):
    rows = transactions(spark, folder).select("merchant", "card_id", "dob", "merch_zipcode")
    return prepare.ensure_transaction_id(rows)


@query(
    "prj_08_column_order",
    on_tx(
        "SELECT transaction_id, card_id, merchant, amount, CAST(is_fraud AS INT) AS is_fraud, "
        "state, category FROM tx"
    ),
)
def column_order(spark, folder):
    rows = transactions(spark, folder).select(
        "state", "is_fraud", "amount", "category", "merchant", "card_id", "transaction_id"
    )
    return prepare.order_columns(rows)


@query(
    "prj_09_model_names",
    on_features(
        "SELECT transaction_id, tx_day_of_week AS tx_dow, "
        "round(merch_distance_km, 6) AS merch_dist_km, cardholder_age AS age, "
        "gender_encoded AS gender_bin FROM fx"
    ),
)
def model_names(spark, folder):
    df = (
        transactions(spark, folder)
        .transform(features_ops.add_temporal)
        .transform(features_ops.add_distance)
        .transform(features_ops.add_cardholder)
    )
    renamed = selection.rename_for_models(df)
    return rounded(
        renamed.select("transaction_id", "tx_dow", "merch_dist_km", "age", "gender_bin")
    )


@query(
    "prj_10_feature_selection",
    on_tx(
        "SELECT transaction_id, transaction_ts, card_id, merchant, CAST(is_fraud AS INT) AS is_fraud, "
        "category, gender, state, lat, long, merch_lat, merch_long, city_pop, dob FROM tx"
    ),
)
def feature_selection(spark, folder):
    return selection.select_features(transactions(spark, folder))


@query(
    "prj_11_projection",
    on_tx("SELECT transaction_id, transaction_ts, amount, CAST(is_fraud AS INT) AS is_fraud FROM tx"),
)
def projection(spark, folder):
    return selection.project(
        transactions(spark, folder),
        "transaction_id",
        "transaction_ts",
        "amount",
        "no_such_column",
        "is_fraud",
    )


@query(
    "flt_01_valid_amounts",
    on_tx(
        "SELECT transaction_id, round(amount - 20, 6) AS amount FROM tx "
        "WHERE amount IS NOT NULL AND amount - 20 >= 0 AND CAST(transaction_id AS BIGINT) % 5 <> 0"
    ),
)
def valid_amounts(spark, folder):
    shifted = F.when(event() % 5 != 0, F.col("amount") - 20)
    rows = transactions(spark, folder).select("transaction_id", shifted.alias("amount"))
    return rounded(prepare.keep_valid_amounts(rows))


@query(
    "flt_02_known_labels",
    on_tx(
        "SELECT transaction_id, CAST(CAST(transaction_id AS BIGINT) % 4 AS INT) AS is_fraud FROM tx "
        "WHERE CAST(transaction_id AS BIGINT) % 4 IN (0, 1)"
    ),
)
def known_labels(spark, folder):
    label = F.when(event() % 4 != 3, (event() % 4).cast("int"))
    rows = transactions(spark, folder).select("transaction_id", label.alias("is_fraud"))
    return prepare.keep_known_labels(rows)


@query(
    "flt_03_deduplicate",
    on_orders(
        """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_ts, card_id,
         merchant, amount, is_fraud, category, state) AS place FROM tx_orders)
SELECT transaction_id, transaction_ts, card_id, merchant, amount, CAST(is_fraud AS INT) AS is_fraud,
       category, state
FROM ranked WHERE place = 1"""
    ),
)
def deduplicate(spark, folder):
    return prepare.deduplicate(order_lines(spark, folder))


@query(
    "flt_04_label_filter",
    on_orders(
        "SELECT CAST(count(*) AS BIGINT) AS n, round(sum(amount), 2) AS total "
        "FROM tx_orders WHERE is_fraud = 1"
    ),
)
def label_filter(spark, folder):
    fraud = selection.with_label(order_lines(spark, folder), 1)
    return rounded(fraud.agg(F.count("*").alias("n"), F.sum("amount").alias("total")), 2)


@query(
    "flt_05_bounding_box",
    on_features(
        "SELECT lat, long, CAST(is_fraud AS INT) AS is_fraud, round(amount_log1p, 6) AS amount_log1p "
        "FROM fx WHERE lat BETWEEN 24 AND 50 AND long BETWEEN -130 AND -60 AND lat <> 49"
    ),
)
def bounding_box(spark, folder):
    rows = transactions(spark, folder).transform(features_ops.add_amount_shape)
    moved = rows.withColumn("lat", F.when(F.col("lat") == 49, 51.0).otherwise(F.col("lat")))
    return rounded(selection.in_box(moved).select("lat", "long", "is_fraud", "amount_log1p"))


@query(
    "flt_06_top_categories",
    on_orders(
        """, top AS (SELECT category FROM tx_orders GROUP BY category
                   ORDER BY count(*) DESC, category LIMIT 3)
SELECT category, CAST(count(*) AS BIGINT) AS n, round(sum(amount), 2) AS total
FROM tx_orders WHERE category IN (SELECT category FROM top) GROUP BY category"""
    ),
)
def top_categories(spark, folder):
    kept = selection.in_top_groups(order_lines(spark, folder), "category", 3)
    return rounded(
        kept.groupBy("category").agg(F.count("*").alias("n"), F.sum("amount").alias("total")), 2
    )


@query(
    "flt_07_group_floor",
    on_tx(
        "SELECT merchant, CAST(count(*) AS BIGINT) AS tx_count FROM tx GROUP BY merchant "
        "HAVING count(*) >= 100"
    ),
)
def group_floor(spark, folder):
    groups = transactions(spark, folder).groupBy("merchant").agg(F.count("*").alias("tx_count"))
    return selection.with_at_least(groups, "tx_count", 100)


@query(
    "flt_08_complete_rows",
    on_tx(
        "SELECT transaction_id, dob, merch_long FROM tx "
        "WHERE dob IS NOT NULL AND merch_long IS NOT NULL"
    ),
)
def complete_rows(spark, folder):
    kept = selection.complete_rows(transactions(spark, folder), ["dob", "merch_long"])
    return kept.select("transaction_id", "dob", "merch_long")


def _with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with missing, zero and very large amounts."""
    amount = (
        F.when(event() % 19 == 0, F.lit(None).cast("double"))
        .when(event() % 23 == 0, F.lit(0.0))
        .otherwise(F.col("amount") * 10)
    )
    return transactions(spark, folder).withColumn("amount", amount)


_GAPS = """, gaps AS (
  SELECT CASE WHEN CAST(transaction_id AS BIGINT) % 19 = 0 THEN NULL
              WHEN CAST(transaction_id AS BIGINT) % 23 = 0 THEN 0 ELSE amount * 10 END AS amount,
         is_fraud FROM tx)
"""


@query(
    "dq_01_missing_amounts",
    on_tx(_GAPS + "SELECT CAST(count(*) AS BIGINT) AS null_amounts FROM gaps WHERE amount IS NULL"),
)
def missing_amounts(spark, folder):
    return quality.missing_amounts(_with_gaps(spark, folder))


@query(
    "dq_02_repeated_keys",
    on_orders(
        "SELECT transaction_id, CAST(count(*) AS BIGINT) AS copies FROM tx_orders "
        "GROUP BY transaction_id HAVING count(*) > 1"
    ),
)
def repeated_keys(spark, folder):
    return quality.repeated_keys(order_lines(spark, folder))


@query(
    "dq_03_null_report",
    on_tx(
        """, counted AS (
  SELECT 'merch_long' AS column_name, count(*) - count(merch_long) AS null_count, count(*) AS n FROM tx
  UNION ALL SELECT 'dob', count(*) - count(dob), count(*) FROM tx
  UNION ALL SELECT 'merch_zipcode', count(*) - count(merch_zipcode), count(*) FROM tx
  UNION ALL SELECT 'amount', count(*) - count(amount), count(*) FROM tx)
SELECT column_name, CAST(null_count AS BIGINT) AS null_count,
       round(null_count * 100.0 / n, 2) AS null_pct
FROM counted WHERE null_count > 0"""
    ),
)
def null_report(spark, folder):
    return quality.null_report(transactions(spark, folder))


@query(
    "dq_04_row_audit",
    on_tx(
        _GAPS
        + """SELECT CAST(count(*) AS BIGINT) AS row_count,
       CAST(count(*) FILTER (amount IS NULL) AS BIGINT) AS null_amount,
       CAST(count(*) FILTER (amount <= 0) AS BIGINT) AS non_positive_amount,
       CAST(count(*) FILTER (amount > 1000) AS BIGINT) AS high_amount,
       CAST(count(*) FILTER (is_fraud = 1) AS BIGINT) AS fraud_count,
       round(count(*) FILTER (amount > 1000) * 100.0 / count(*), 6) AS high_pct,
       round(count(*) FILTER (is_fraud = 1) * 100.0 / count(*), 6) AS fraud_pct
FROM gaps"""
    ),
)
def row_audit(spark, folder):
    return rounded(quality.audit(_with_gaps(spark, folder)))


@query(
    "dq_05_feature_coverage",
    on_features(
        """, lines AS (
  SELECT 'tx_hour' AS feature, true AS present, count(tx_hour) AS filled_rows FROM fx
  UNION ALL SELECT 'tx_day_of_week', true, count(tx_day_of_week) FROM fx
  UNION ALL SELECT 'tx_month', true, count(tx_month) FROM fx
  UNION ALL SELECT 'tx_is_weekend', true, count(tx_is_weekend) FROM fx
  UNION ALL SELECT 'tx_time_of_day', true, count(tx_time_of_day) FROM fx
  UNION ALL SELECT 'amount_log1p', false, 0
  UNION ALL SELECT 'amount_zscore', false, 0
  UNION ALL SELECT 'amount_bin', false, 0
  UNION ALL SELECT 'merch_distance_km', true, count(merch_distance_km) FROM fx
  UNION ALL SELECT 'card_tx_count_1h', false, 0
  UNION ALL SELECT 'card_amount_sum_1h', false, 0
  UNION ALL SELECT 'cardholder_age', true, count(cardholder_age) FROM fx
  UNION ALL SELECT 'gender_encoded', true, count(gender_encoded) FROM fx
  UNION ALL SELECT 'merchant_fraud_rate', false, 0
  UNION ALL SELECT 'category_encoded', false, 0)
SELECT feature, present, CAST(filled_rows AS BIGINT) AS filled_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM fx) AS row_count
FROM lines"""
    ),
)
def feature_coverage(spark, folder):
    """Coverage of a table with the temporal, distance and cardholder features only."""
    df = (
        transactions(spark, folder)
        .transform(features_ops.add_temporal)
        .transform(features_ops.add_distance)
        .transform(features_ops.add_cardholder)
    )
    return quality.feature_coverage(df)


@query(
    "dq_06_fraud_alert",
    on_tx(
        "SELECT round(sum(is_fraud) * 100.0 / count(is_fraud), 6) AS fraud_rate, "
        "round(sum(CASE WHEN is_fraud = 1 THEN amount ELSE 0 END), 2) AS exposure, "
        "sum(is_fraud) * 100.0 / count(is_fraud) > 1.0 AS alert FROM tx"
    ),
)
def fraud_alert(spark, folder):
    return rounded(quality.fraud_alert(transactions(spark, folder)), exposure=2)
