"""Joins that enrich transactions."""

from __future__ import annotations

from cardlens.catalog.registry import query, rounded
from cardlens.catalog.sql import on_features, on_orders, on_tx
from cardlens.catalog.stored import stored_order_lines
from cardlens.operators import exploration, joins
from cardlens.operators import features as features_ops
from cardlens.sources.star import transactions


@query(
    "jon_01_merchant_rate",
    on_tx(
        """, rates AS (SELECT merchant, avg(is_fraud) AS rate FROM tx GROUP BY merchant)
SELECT transaction_id, merchant, round(rate, 6) AS merchant_fraud_rate FROM tx LEFT JOIN rates USING (merchant)"""
    ),
)
def merchant_rate(spark, folder):
    df = transactions(spark, folder).select("transaction_id", "merchant", "is_fraud")
    return rounded(features_ops.add_merchant_rate(df).drop("is_fraud"))


_CATEGORY = """, stats AS (
  SELECT category, round(avg(is_fraud) * 100, 3) AS cat_fraud_rate, round(avg(amount), 2) AS cat_avg_amount,
         count(*) AS n FROM tx_orders GROUP BY category)
SELECT transaction_id, amount, category, cat_fraud_rate, cat_avg_amount, CAST(n AS BIGINT) AS cat_tx_count
FROM tx_orders LEFT JOIN stats USING (category)"""


@query("jon_02_broadcast_category", on_orders(_CATEGORY))
def broadcast_category(spark, folder):
    facts = stored_order_lines(spark, folder).select("transaction_id", "amount", "category")
    lookup = exploration.category_lookup(stored_order_lines(spark, folder))
    return joins.lookup_join(facts, lookup, "category")


@query("jon_03_merge_category", on_orders(_CATEGORY))
def merge_category(spark, folder):
    facts = stored_order_lines(spark, folder).select("transaction_id", "amount", "category")
    return joins.merge_lookup(facts, exploration.category_lookup(stored_order_lines(spark, folder)), "category")


@query("jon_03_salted_category", on_orders(_CATEGORY))
def salted_category(spark, folder):
    facts = stored_order_lines(spark, folder).select("transaction_id", "amount", "category")
    return joins.salted_lookup(facts, exploration.category_lookup(stored_order_lines(spark, folder)), "category")


@query(
    "jon_04_band_order",
    on_features(
        """, bands(dist_bin) AS (VALUES ('< 10 km'), ('10-50 km'), ('50-100 km'), ('100-300 km')),
grouped AS (
  SELECT CASE WHEN merch_distance_km < 10 THEN '< 10 km' WHEN merch_distance_km < 50 THEN '10-50 km'
              WHEN merch_distance_km < 100 THEN '50-100 km' ELSE '100-300 km' END AS dist_bin,
         CAST(count(*) AS BIGINT) AS tx_count, round(avg(is_fraud) * 100, 3) AS fraud_rate_pct
  FROM fx WHERE merch_distance_km >= 50 GROUP BY 1)
SELECT dist_bin, tx_count, fraud_rate_pct FROM bands LEFT JOIN grouped USING (dist_bin)"""
    ),
)
def band_order(spark, folder):
    """Bands without rows appear with NULL measures."""
    df = transactions(spark, folder).transform(features_ops.add_distance)
    return exploration.by_distance(df.where("merch_distance_km >= 50"))


_WEIGHTS = """, weights AS (
  SELECT is_fraud, (SELECT count(*) FROM tx) / (2.0::DOUBLE * count(*)) AS class_weight FROM tx GROUP BY is_fraud)
"""


@query(
    "jon_05_row_weights",
    on_tx(
        _WEIGHTS
        + "SELECT transaction_id, CAST(is_fraud AS INT) AS is_fraud, round(class_weight, 6) AS class_weight "
        "FROM tx LEFT JOIN weights USING (is_fraud)"
    ),
)
def row_weights(spark, folder):
    df = transactions(spark, folder).select("transaction_id", "is_fraud")
    return rounded(joins.with_class_weight(df))


@query(
    "agg_25_class_weights",
    on_tx(
        _WEIGHTS
        + "SELECT CAST(is_fraud AS INT) AS is_fraud, round(class_weight, 6) AS class_weight FROM weights"
    ),
)
def class_weights(spark, folder):
    return rounded(joins.class_weights(transactions(spark, folder)))
