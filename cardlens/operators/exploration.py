"""Exploratory reports: shape, class balance, breakdowns and bands.

A NULL group key is a group of its own here; the portfolio reports drop it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import bands as B
from cardlens.functions import expressions as X
from cardlens.functions import measures as M
from cardlens.operators.joins import in_band_order
from cardlens.operators.ranking import quantiles, value_counts
from cardlens.operators.selection import in_top_groups, with_at_least, with_label
from cardlens.session import settled


def shape(df: DataFrame) -> DataFrame:
    return df.agg(M.rows("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum: one typed row per column."""
    wide, lines = [], []
    for c in [c for c in columns if c in df.columns]:
        x = F.col(c).cast("double")
        wide += [
            F.count(x).alias(f"{c}_n"),
            F.avg(x).alias(f"{c}_mean"),
            F.stddev_samp(x).alias(f"{c}_std"),
            F.min(x).alias(f"{c}_min"),
            F.max(x).alias(f"{c}_max"),
        ]
        lines.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}_n").alias("n"),
                F.col(f"{c}_mean").alias("mean"),
                F.col(f"{c}_std").alias("stddev"),
                F.col(f"{c}_min").alias("min"),
                F.col(f"{c}_max").alias("max"),
            )
        )
    return df.agg(*wide).select(F.inline(F.array(*lines)))


def class_balance(df: DataFrame) -> DataFrame:
    counts = df.agg(
        M.rows("total"),
        F.count_if(F.col("is_fraud") == 0).alias("legit"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud"),
    )
    return counts.withColumns(
        {
            "legit_pct": F.try_divide("legit", "total") * 100,
            "fraud_rate_pct": F.try_divide("fraud", "total") * 100,
            "legit_per_fraud": F.try_divide("legit", "fraud"),
        }
    )


def amount_by_label(df: DataFrame) -> DataFrame:
    """Moments and quantiles of the amount per label, to cents.

    Quantiles are exact: a sketch per label would put all partial sketches of the
    table on one reducer per label.
    """
    moments = df.groupBy("is_fraud").agg(
        F.avg("amount").alias("mean"),
        F.stddev_samp("amount").alias("std"),
        F.min("amount").alias("min"),
        F.max("amount").alias("max"),
    )
    marks = quantiles(
        value_counts(df, "amount", ("is_fraud",)),
        "amount",
        {"median": 0.5, "p25": 0.25, "p75": 0.75, "p95": 0.95},
        by=("is_fraud",),
        discrete=True,
    ).withColumnRenamed("is_fraud", "label")
    stats = ["mean", "median", "std", "min", "p25", "p75", "p95", "max"]
    return (
        moments.join(marks, F.col("is_fraud").eqNullSafe(F.col("label")), "left")
        .select("is_fraud", *[F.round(c, 2).alias(c) for c in stats])
        .orderBy("is_fraud")
    )


def _volume_and_rate(df: DataFrame, key: Column, digits: int | None = None) -> DataFrame:
    return df.groupBy(key).agg(M.rows(), M.fraud_rate_pct(digits=digits))


def by_hour(df: DataFrame) -> DataFrame:
    return _volume_and_rate(df, F.hour("transaction_ts").alias("tx_hour")).orderBy("tx_hour")


def riskiest_hours(df: DataFrame, k: int = 5) -> DataFrame:
    return by_hour(df).orderBy(F.desc("fraud_rate_pct"), "tx_hour").limit(k)


def by_weekday(df: DataFrame) -> DataFrame:
    """Sunday is day 1."""
    days = _volume_and_rate(df, F.dayofweek("transaction_ts").alias("tx_day_of_week"))
    label = B.weekday_label(F.col("tx_day_of_week"), B.WEEKDAYS_FROM_SUNDAY)
    return days.withColumn("day_label", label).orderBy("tx_day_of_week")


def by_month(df: DataFrame) -> DataFrame:
    key = X.month_key(F.col("transaction_ts")).alias("tx_month_str")
    return _volume_and_rate(df, key).orderBy("tx_month_str")


def by_category(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("category")
        .agg(
            M.rows(),
            M.mean_of("amount", "avg_amount", 2),
            M.fraud_rate_pct(digits=3),
            M.sum_of("amount", "total_spend", 2),
        )
        .orderBy(F.desc("tx_count"), "category")
    )


def riskiest_merchants(df: DataFrame, floor: int = 50, k: int = 10) -> DataFrame:
    return (
        _volume_and_rate(df, F.col("merchant"), 3)
        .transform(with_at_least, "tx_count", floor)
        .orderBy(F.desc("fraud_rate_pct"), "merchant")
        .limit(k)
    )


def busiest_states(df: DataFrame, k: int = 15) -> DataFrame:
    return (
        _volume_and_rate(df, F.col("state"), 3).orderBy(F.desc("tx_count"), "state").limit(k)
    )


def overall_fraud_rate(df: DataFrame) -> DataFrame:
    return df.agg(M.fraud_rate_pct())


def by_distance(df: DataFrame, distance: str = "merch_distance_km") -> DataFrame:
    """Four bands; a missing distance and anything from 100 km count as the last band."""
    band = B.DISTANCE_EXPLORATORY
    groups = _volume_and_rate(df, band.of(F.col(distance)).alias(band.name), 3)
    return in_band_order(groups, band)


def by_distance_five_bands(df: DataFrame, distance: str = "merch_distance_km") -> DataFrame:
    """Five bands, amounts on the log scale; a missing distance counts as the last band."""
    band = B.DISTANCE_BEHAVIOUR
    groups = df.groupBy(band.of(F.col(distance)).alias(band.name)).agg(
        M.rows("total"),
        M.mean_of("amount_log1p", "avg_amount_log1p", 2),
        M.fraud_rate_pct(digits=3),
    )
    return in_band_order(groups, band, fill=False)


def by_age(df: DataFrame, age: str = "cardholder_age") -> DataFrame:
    """Six groups; a missing age counts as the last one."""
    band = B.AGE_EXPLORATORY
    groups = df.groupBy(band.of(F.col(age)).alias(band.name)).agg(
        M.rows(), M.mean_of("amount", "avg_amount", 2), M.fraud_rate_pct(digits=3)
    )
    return in_band_order(groups, band)


def by_age_log_amount(df: DataFrame, age: str = "cardholder_age") -> DataFrame:
    """The same groups with amounts on the log scale; only groups that occur."""
    band = B.AGE_BEHAVIOUR
    groups = df.groupBy(band.of(F.col(age)).alias(band.name)).agg(
        M.rows(),
        M.mean_of("amount_log1p", "avg_amount_log1p", 2),
        M.fraud_rate_pct(digits=3),
    )
    return in_band_order(groups, band, fill=False)


def by_gender(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("gender")
        .agg(
            M.rows(),
            M.mean_of("amount", "avg_amount", 2),
            M.fraud_rate_pct(digits=3),
            M.sum_of("amount", "total_spend", 2),
        )
        .orderBy("gender")
    )


def gender_encoding(df: DataFrame) -> DataFrame:
    return df.groupBy("gender", "gender_encoded").agg(M.rows("n"))


def riskiest_merchant_rates(df: DataFrame, k: int = 10) -> DataFrame:
    """Merchants with the highest mean label, as used by the target encoding."""
    return (
        df.groupBy("merchant")
        .agg(F.avg("is_fraud").alias("merchant_fraud_rate"), M.rows("merchant_tx_count"))
        .orderBy(F.desc("merchant_fraud_rate"), F.asc_nulls_last("merchant"))
        .limit(k)
    )


def monthly_series(df: DataFrame) -> DataFrame:
    """Monthly volume, log-scale spend and fraud, with a 0-based time index ``t``.

    The index is a window over the aggregated months, one row per calendar month.
    """
    months = df.groupBy(
        X.month_key_from_parts(F.col("transaction_ts")).alias("year_month")
    ).agg(
        M.rows(),
        M.sum_of("amount_log1p", "total_spend_log1p", 2),
        M.mean_of("amount_log1p", "avg_amount_log1p", 2),
        M.frauds("fraud_count"),
        M.fraud_rate_pct(digits=3),
    )
    return with_time_index(months).orderBy("year_month")


def with_time_index(months: DataFrame) -> DataFrame:
    in_time = Window.partitionBy(F.lit(0)).orderBy("year_month")
    return months.withColumn("t", F.row_number().over(in_time) - 1)


def gender_by_top_category(df: DataFrame, k: int = 6) -> DataFrame:
    """Mean log amount of the ``k`` most frequent categories by gender.

    A row for each gender that occurs, the missing one included: which there are is data.
    """
    return (
        in_top_groups(df, "category", k)
        .groupBy("category", "gender")
        .agg(F.round(F.avg("amount_log1p"), 2).alias("avg_amount_log1p"))
        .orderBy("category", "gender")
    )


def gender_pivot(df: DataFrame, k: int = 6, missing: str = "missing") -> DataFrame:
    """The same means with a column for each gender that occurs.

    The genders are found first, on the aggregated rows, so none is left out; NULL gets the
    column ``missing``.
    """
    long = settled(gender_by_top_category(df, k).withColumn("gender", F.coalesce("gender", F.lit(missing))))
    genders = [r["gender"] for r in long.select("gender").distinct().orderBy("gender").collect()]
    return long.groupBy("category").pivot("gender", genders).agg(F.max("avg_amount_log1p")).orderBy("category")


def by_category_and_state(df: DataFrame) -> DataFrame:
    return df.groupBy("category", "state").agg(
        M.rows(),
        M.mean_of("amount", "avg_amount"),
        M.frauds("fraud_count"),
        F.stddev_samp("amount").alias("std_amount"),
    )


def mean_amount_by_category(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(M.mean_of("amount", "avg_amount"))


def frauds_by_state(df: DataFrame) -> DataFrame:
    return df.groupBy("state").agg(M.frauds("fraud_count"))


def fraud_by_category_and_state(df: DataFrame) -> DataFrame:
    return (
        with_label(df, 1)
        .groupBy("category", "state")
        .agg(M.rows("fraud_count"), M.mean_of("amount", "avg_amount"))
        .orderBy(F.desc("fraud_count"), "category", "state")
    )


def category_lookup(df: DataFrame) -> DataFrame:
    """Per-category rate, mean amount and volume for enriching transactions."""
    return df.groupBy("category").agg(
        M.fraud_rate_pct("cat_fraud_rate", 3),
        M.mean_of("amount", "cat_avg_amount", 2),
        M.rows("cat_tx_count"),
    )


def by_state_category_hour(df: DataFrame) -> DataFrame:
    return df.groupBy("state", "category", F.hour("transaction_ts").alias("hr")).agg(
        M.sum_of("amount", "total"), M.rows("cnt")
    )


def by_card_category_hour(df: DataFrame) -> DataFrame:
    return df.groupBy("card_id", "category", F.hour("transaction_ts").alias("hr")).agg(
        M.rows("cnt"), M.sum_of("amount", "total"), M.frauds("fraud_sum")
    )
