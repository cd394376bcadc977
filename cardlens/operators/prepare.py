"""From a raw table with arbitrary headers to the canonical transaction table."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions import expressions as X

# Leading columns of the canonical table, in order.
CANONICAL_ORDER = (
    "transaction_id",
    "transaction_ts",
    "card_id",
    "merchant",
    "amount",
    "is_fraud",
)

# Other names under which a canonical column may arrive, best first.
KNOWN_ALIASES = {
    "transaction_ts": ("trans_date_trans_time", "timestamp", "datetime", "date"),
    "is_fraud": ("class", "fraud", "label"),
    "amount": ("amt",),
    "transaction_id": ("trans_num",),
    "card_id": ("cc_num",),
    "merchant": ("merchant_name",),
}


def plain_name(header: str) -> str:
    """``" Trans-Date  Time "`` becomes ``trans_date_time``."""
    return "_".join(re.findall("[a-z0-9]+", header.lower()))


def normalize_headers(df: DataFrame) -> DataFrame:
    names = [plain_name(c) for c in df.columns]
    clashes = [name for name, uses in Counter(names).items() if uses > 1]
    if clashes:
        raise ValueError(f"several headers become {clashes}; rename them in the source")
    return df.toDF(*names)


def rename_aliases(df: DataFrame) -> DataFrame:
    """Renames the best alias of each canonical column that is missing."""
    present = set(df.columns)
    renames = {}
    for canonical, aliases in KNOWN_ALIASES.items():
        found = [alias for alias in aliases if alias in present]
        if found and canonical not in present:
            renames[found[0]] = canonical
    return df.withColumnsRenamed(renames)


def type_columns(df: DataFrame) -> DataFrame:
    """Types timestamp, amount and label. Unreadable text becomes NULL; no row is lost."""
    kinds = dict(df.dtypes)
    typed = {}
    if "transaction_ts" not in kinds and "time" in kinds:
        typed["transaction_ts"] = X.relative_seconds_timestamp(F.col("time"))
    elif kinds.get("transaction_ts") == "string":
        typed["transaction_ts"] = X.tolerant_timestamp(F.col("transaction_ts"))
    elif "transaction_ts" in kinds:
        typed["transaction_ts"] = F.col("transaction_ts").cast("timestamp")
    if "amount" in kinds:
        typed["amount"] = F.col("amount").try_cast("double")
    if "is_fraud" in kinds:
        typed["is_fraud"] = X.tolerant_flag(F.col("is_fraud"))
    return df.withColumns(typed)


def ensure_transaction_id(df: DataFrame) -> DataFrame:
    """Content hash as id for sources without one; equal rows get equal ids."""
    if "transaction_id" in df.columns:
        return df
    return df.withColumn("transaction_id", X.fingerprint(df.columns))


def order_columns(df: DataFrame) -> DataFrame:
    leading = [c for c in CANONICAL_ORDER if c in df.columns]
    return df.select(*leading, *[c for c in df.columns if c not in leading])


def standardize(df: DataFrame) -> DataFrame:
    return (
        df.transform(rename_aliases)
        .transform(type_columns)
        .transform(ensure_transaction_id)
        .transform(order_columns)
    )


def keep_valid_amounts(df: DataFrame) -> DataFrame:
    """Drops NULL and negative amounts; zero and NaN stay."""
    return df.where(F.col("amount") >= 0) if "amount" in df.columns else df


def keep_known_labels(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_fraud").isin(0, 1)) if "is_fraud" in df.columns else df


def deduplicate(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per ``key``: the smallest by the remaining columns, left to right.

    A minimum over a struct is combined map-side, so an id shared by a third of
    the table still sends one row per task to its reducer. A ranked window would
    pull all copies of that id into one task.
    """
    rest = [c for c in df.columns if c != key]
    if key not in df.columns or not rest:
        return df.distinct()
    survivor = F.min(F.struct(*rest)).alias("survivor")
    return df.groupBy(key).agg(survivor).select(key, "survivor.*").select(*df.columns)


def clean(df: DataFrame) -> DataFrame:
    return (
        df.transform(keep_valid_amounts).transform(keep_known_labels).transform(deduplicate)
    )


def prepare(raw: DataFrame) -> DataFrame:
    """Headers, names, types, id, order, filters, dedup: one lazy plan with one shuffle."""
    return raw.transform(normalize_headers).transform(standardize).transform(clean)
