"""Projections and row filters used by the reports and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Feature names of the feature table and their model-side names.
MODEL_NAMES = {
    "tx_day_of_week": "tx_dow",
    "merch_distance_km": "merch_dist_km",
    "cardholder_age": "age",
    "gender_encoded": "gender_bin",
    "category_encoded": "category_idx",
}

# Columns left out of the feature table.
UNUSED_IN_FEATURES = ("merch_zipcode", "amount", "street", "first", "last", "unix_time")


def rename_for_models(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(MODEL_NAMES)


def select_features(df: DataFrame) -> DataFrame:
    return df.drop(*UNUSED_IN_FEATURES)


def with_label(df: DataFrame, label: int) -> DataFrame:
    return df.where(F.col("is_fraud") == label)


def in_box(
    df: DataFrame,
    lat: tuple[float, float] = (24, 50),
    long: tuple[float, float] = (-130, -60),
) -> DataFrame:
    """Rows inside a latitude/longitude box, borders included (default: continental US)."""
    return df.where(F.col("lat").between(*lat) & F.col("long").between(*long))


def in_top_groups(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of the ``k`` most frequent values of ``key``.

    The list has at most ``k`` rows, which bounds the broadcast.
    """
    top = df.groupBy(key).count().orderBy(F.desc("count"), key).limit(k).select(key)
    return df.join(F.broadcast(top), key, "left_semi").select(*df.columns)


def with_at_least(groups: DataFrame, column: str, floor: int) -> DataFrame:
    return groups.where(F.col(column) >= floor)


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def project(df: DataFrame, *columns: str) -> DataFrame:
    """The listed columns that exist."""
    return df.select(*[c for c in columns if c in df.columns])
