"""Data-quality checks, each a single aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions import measures as M

# The columns that feature engineering adds.
ENGINEERED_COLUMNS = (
    "tx_hour",
    "tx_day_of_week",
    "tx_month",
    "tx_is_weekend",
    "tx_time_of_day",
    "amount_log1p",
    "amount_zscore",
    "amount_bin",
    "merch_distance_km",
    "card_tx_count_1h",
    "card_amount_sum_1h",
    "cardholder_age",
    "gender_encoded",
    "merchant_fraud_rate",
    "category_encoded",
)


def missing_amounts(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("amount").isNull()).alias("null_amounts"))


def repeated_keys(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(M.rows("copies")).where(F.col("copies") > 1)


def null_report(df: DataFrame) -> DataFrame:
    """Columns that have NULLs, with count and percentage."""
    counted = df.agg(
        M.rows("row_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count"))
        for c in df.columns
    ]
    return (
        counted.select("row_count", F.inline(F.array(*lines)))
        .where(F.col("null_count") > 0)
        .select(
            "column_name",
            "null_count",
            F.round(F.try_divide("null_count", "row_count") * 100, 2).alias("null_pct"),
        )
    )


def audit_counts(high: float = 1000.0) -> list[Column]:
    """The counts of :func:`audit`, as aggregates; a write can observe them, too."""
    amount = F.col("amount")
    return [
        M.rows("row_count"),
        F.count_if(amount.isNull()).alias("null_amount"),
        F.count_if(amount <= 0).alias("non_positive_amount"),
        F.count_if((amount > 0) & (amount > high)).alias("high_amount"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_count"),
    ]


def audit(df: DataFrame, high: float = 1000.0) -> DataFrame:
    """Missing, non-positive and high amounts plus frauds, with shares of all rows.

    A conditional aggregate stays exact when a task is retried; side-effect
    counters do not.
    """
    return with_shares(df.agg(*audit_counts(high)))


def with_shares(counts: DataFrame) -> DataFrame:
    """Counts of :func:`audit_counts` with the shares of high amounts and of frauds."""
    return counts.withColumns(
        {
            "high_pct": F.try_divide("high_amount", "row_count") * 100,
            "fraud_pct": F.try_divide("fraud_count", "row_count") * 100,
        }
    )


def feature_coverage(df: DataFrame) -> DataFrame:
    """For every engineered column: is it there, and how many rows have a value."""
    present = [c for c in ENGINEERED_COLUMNS if c in df.columns]
    counted = df.agg(*[F.count(c).alias(c) for c in present], M.rows("row_count"))
    lines = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(c in present).alias("present"),
            (F.col(c) if c in present else F.lit(0).cast("bigint")).alias("filled_rows"),
        )
        for c in ENGINEERED_COLUMNS
    ]
    return counted.select(F.inline(F.array(*lines)), "row_count")


def fraud_alert(df: DataFrame, threshold_pct: float = 1.0) -> DataFrame:
    """Fraud rate, exposure and whether the rate is above the alert threshold."""
    return df.agg(M.fraud_share("fraud_rate"), M.fraud_amount("exposure")).withColumn(
        "alert", F.coalesce(F.col("fraud_rate") > threshold_pct, F.lit(False))
    )
