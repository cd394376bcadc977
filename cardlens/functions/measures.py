"""Aggregate measures. Each is algebraic, so Spark combines it map-side and a hot
group reaches its reducer as one partial row per task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows(name: str = "tx_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def labelled(name: str = "total") -> Column:
    """Rows with a known label."""
    return F.count("is_fraud").alias(name)


def frauds(name: str = "fraud") -> Column:
    return F.sum("is_fraud").alias(name)


def mean_of(column: str, name: str, digits: int | None = None) -> Column:
    return _round(F.avg(column), digits).alias(name)


def sum_of(column: str, name: str, digits: int | None = None) -> Column:
    return _round(F.sum(column), digits).alias(name)


def fraud_rate_pct(name: str = "fraud_rate_pct", digits: int | None = None) -> Column:
    return _round(F.avg("is_fraud") * 100, digits).alias(name)


def fraud_share(name: str = "fraud_rate") -> Column:
    """Frauds per hundred labelled rows; NULL for a group without labels."""
    return (F.try_divide(F.sum("is_fraud"), F.count("is_fraud")) * 100).alias(name)


def fraud_amount(name: str = "fraud_amount") -> Column:
    """Amount on fraudulent rows, 0 where there are none."""
    stolen = F.sum(F.when(F.col("is_fraud") == 1, F.col("amount")))
    return F.coalesce(stolen, F.lit(0.0)).alias(name)


def _round(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)
