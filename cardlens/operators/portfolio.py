"""Portfolio risk reports.

Group keys that are NULL are dropped and volumes count labelled rows; the exploratory
reports do neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import bands as B
from cardlens.functions import expressions as X
from cardlens.functions import measures as M
from cardlens.operators.exploration import with_time_index
from cardlens.operators.joins import in_band_order
from cardlens.operators.ranking import quantiles, value_counts
from cardlens.operators.selection import with_at_least

# Fixed value: prefix that the source puts before every merchant name.
MERCHANT_PREFIX = "fraud_"


def _known(df: DataFrame, name: str, key: Column) -> DataFrame:
    return df.withColumn(name, key).where(F.col(name).isNotNull())


def kpis(df: DataFrame) -> DataFrame:
    """One row of portfolio figures.

    Distinct counts are subqueries over one or two columns each. Asked for in one
    aggregate they would multiply every row by the number of counted columns.
    """
    amount, fraud = F.col("amount"), F.col("is_fraud") == 1
    figures = df.agg(
        M.rows("total_tx"),
        M.frauds("fraud_tx"),
        F.avg("amount").alias("avg_amount"),
        F.date_format(F.min("transaction_ts"), "MMM yyyy").alias("first_month"),
        F.date_format(F.max("transaction_ts"), "MMM yyyy").alias("last_month"),
        F.sum("amount").alias("total_spend"),
        M.fraud_amount("fraud_amount_total"),
        F.avg(F.when(fraud, amount)).alias("fraud_amount_avg"),
        F.avg(F.when(F.col("is_fraud") == 0, amount)).alias("legit_amount_avg"),
    )
    cards = (
        _known(df, "card_id", F.col("card_id"))
        .groupBy("card_id")
        .agg(F.max(fraud.cast("int")).alias("hit"))
        .select(F.struct(F.count(F.lit(1)).alias("cards"), F.count_if(F.col("hit") == 1).alias("hit")))
        .scalar()
    )
    return figures.select(
        "*",
        cards.getField("cards").alias("unique_cards"),
        cards.getField("hit").alias("cards_with_fraud"),
        _distinct(df, "merchant").alias("unique_merchants"),
        _distinct(df, "state").alias("num_states"),
        _distinct(df, "category").alias("num_categories"),
        (F.try_divide("fraud_tx", "total_tx") * 100).alias("fraud_rate"),
        (F.try_divide("fraud_amount_total", "total_spend") * 100).alias("fraud_loss_pct"),
    )


def _distinct(df: DataFrame, column: str) -> Column:
    """Number of different known values, as a subquery over that column."""
    return df.select(column).distinct().agg(F.count(column)).scalar()


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct counts, one row; each reads its own column only."""
    first, *rest = columns
    counted = df.select(first).distinct().agg(F.count(first).alias(f"distinct_{first}"))
    return counted.select("*", *[_distinct(df, c).alias(f"distinct_{c}") for c in rest])


def approximate_distinct_counts(
    df: DataFrame, columns: list[str], relative_sd: float = 0.02
) -> DataFrame:
    """Sketch-based counts: fixed-size state per task, no shuffle of the values."""
    return df.agg(
        *[F.approx_count_distinct(c, relative_sd).alias(f"approx_{c}") for c in columns]
    )


def detection_value(df: DataFrame, recall: float = 0.987, precision: float = 0.912) -> DataFrame:
    """Exposure a model of given recall and precision would catch and miss, and the
    legitimate transactions it would block."""
    totals = df.agg(M.frauds("fraud_tx"), M.fraud_amount("exposure"))
    blocked = F.col("fraud_tx") * recall * (1 - precision) / precision
    return totals.withColumns(
        {
            "caught": F.col("exposure") * recall,
            "missed": F.col("exposure") * (1 - recall),
            "false_positives": blocked.cast("bigint"),
        }
    )


def by_category(df: DataFrame) -> DataFrame:
    return (
        _known(df, "category", F.col("category"))
        .groupBy("category")
        .agg(
            M.labelled(),
            M.frauds(),
            M.mean_of("amount", "avg_amount"),
            M.fraud_amount(),
            M.fraud_share(),
        )
        .orderBy("category")
    )


def by_hour(df: DataFrame) -> DataFrame:
    return (
        _known(df, "tx_hour", F.hour("transaction_ts"))
        .groupBy("tx_hour")
        .agg(M.labelled(), M.frauds(), M.fraud_amount(), M.fraud_share())
        .orderBy("tx_hour")
    )


def by_weekday(df: DataFrame) -> DataFrame:
    """Monday is day 0."""
    return (
        _known(df, "tx_dow", F.weekday("transaction_ts"))
        .groupBy("tx_dow")
        .agg(M.labelled(), M.frauds(), M.fraud_share())
        .withColumn("day_name", B.weekday_label(F.col("tx_dow") + 1, B.WEEKDAYS_FROM_MONDAY))
        .orderBy("tx_dow")
    )


def by_month(df: DataFrame) -> DataFrame:
    """Monthly volume, spend and fraud with the least-squares spend trend."""
    months = (
        _known(df, "year_month", X.month_key(F.col("transaction_ts")))
        .groupBy("year_month")
        .agg(
            M.labelled("tx_count"),
            M.sum_of("amount", "total_spend"),
            M.mean_of("amount", "avg_amount"),
            M.frauds("fraud_count"),
            M.fraud_amount(),
            M.fraud_share(),
        )
    )
    indexed = with_time_index(months)
    return with_trend(indexed, "total_spend", "spend_trend").orderBy("year_month")


def with_trend(series: DataFrame, value: str, name: str, index: str = "t") -> DataFrame:
    """Adds the fitted straight line of ``value`` over ``index``. For aggregated series:
    the fit is a window over all rows of ``series``."""
    everything = Window.partitionBy(F.lit(0))
    slope = F.regr_slope(value, index).over(everything)
    intercept = F.regr_intercept(value, index).over(everything)
    return series.withColumn(name, intercept + slope * F.col(index))


def by_state(df: DataFrame, floor: int = 100) -> DataFrame:
    """States with at least ``floor`` transactions."""
    return (
        _known(df, "state", F.col("state"))
        .groupBy("state")
        .agg(
            M.labelled(),
            M.frauds(),
            M.mean_of("amount", "avg_amount"),
            M.fraud_amount(),
            M.fraud_share(),
        )
        .transform(with_at_least, "total", floor)
    )


def riskiest_states(df: DataFrame, floor: int = 100, k: int = 20) -> DataFrame:
    return by_state(df, floor).orderBy(F.desc("fraud_rate"), "state").limit(k)


def most_exposed_states(df: DataFrame, floor: int = 100, k: int = 20) -> DataFrame:
    return by_state(df, floor).orderBy(F.desc("fraud_amount"), "state").limit(k)


def by_amount_tier(df: DataFrame) -> DataFrame:
    band = B.AMOUNT_TIERS
    groups = (
        _known(df, band.name, band.of(F.col("amount")))
        .groupBy(band.name)
        .agg(M.labelled(), M.frauds(), M.fraud_amount(), M.fraud_share())
    )
    return in_band_order(groups, band, fill=False)


def by_age_tier(df: DataFrame, age: str = "cardholder_age") -> DataFrame:
    """Ages outside 0..199 and unknown ages are left out."""
    band = B.AGE_TIERS
    groups = (
        _known(df, band.name, band.of(F.col(age)))
        .groupBy(band.name)
        .agg(
            M.labelled("tx_count"),
            M.mean_of("amount", "avg_amount"),
            M.frauds(),
            M.fraud_amount(),
            M.fraud_share(),
        )
    )
    return in_band_order(groups, band, fill=False)


def by_gender(df: DataFrame) -> DataFrame:
    return (
        _known(df, "gender", F.col("gender"))
        .groupBy("gender")
        .agg(
            M.labelled(),
            M.frauds(),
            M.mean_of("amount", "avg_amount"),
            M.fraud_amount(),
            M.fraud_share(),
        )
        .orderBy("gender")
    )


def by_distance_tier(df: DataFrame, distance: str = "merch_distance_km") -> DataFrame:
    """Unknown distances are left out."""
    band = B.DISTANCE_TIERS
    groups = (
        _known(df, band.name, band.of(F.col(distance)))
        .groupBy(band.name)
        .agg(
            M.labelled(),
            M.frauds(),
            M.mean_of("amount", "avg_amount"),
            M.fraud_amount(),
            M.fraud_share(),
        )
    )
    return in_band_order(groups, band, fill=False)


def by_time_of_day(df: DataFrame) -> DataFrame:
    band = B.TIME_OF_DAY
    groups = (
        _known(df, band.name, band.of(F.hour("transaction_ts")))
        .groupBy(band.name)
        .agg(M.labelled(), M.frauds(), M.mean_of("amount", "avg_amount"), M.fraud_share())
    )
    return in_band_order(groups, band, fill=False)


def by_merchant(df: DataFrame, floor: int = 20) -> DataFrame:
    """Merchants with at least ``floor`` transactions."""
    return (
        _known(df, "merchant", F.col("merchant"))
        .groupBy("merchant")
        .agg(M.labelled("tx_count"), M.frauds(), M.fraud_amount(), M.fraud_share())
        .transform(with_at_least, "tx_count", floor)
    )


def riskiest_merchants(df: DataFrame, floor: int = 20, k: int = 15) -> DataFrame:
    short = F.replace(F.col("merchant"), F.lit(MERCHANT_PREFIX), F.lit(""))
    return (
        by_merchant(df, floor)
        .orderBy(F.desc("fraud_rate"), "merchant")
        .limit(k)
        .withColumn("merchant_short", short)
    )


def merchant_rate_marks(df: DataFrame, floor: int = 20) -> DataFrame:
    """Mean and 90th percentile of the merchants' fraud rates."""
    rates = value_counts(by_merchant(df, floor), "fraud_rate")
    mean = F.sum(F.col("fraud_rate") * F.col("n")) / F.sum("n")
    return quantiles(rates, "fraud_rate", {"p90_fraud_rate": 0.9}).select(
        rates.agg(mean).scalar().alias("avg_fraud_rate"), "p90_fraud_rate"
    )


def by_card(df: DataFrame) -> DataFrame:
    return (
        _known(df, "card_id", F.col("card_id"))
        .groupBy("card_id")
        .agg(
            M.labelled("tx_count"),
            M.sum_of("amount", "total_spend"),
            M.mean_of("amount", "avg_amount"),
            M.frauds("fraud_count"),
            M.fraud_share(),
        )
    )


def high_velocity_cards(df: DataFrame, share: float = 0.99) -> DataFrame:
    """The whole-number ``share`` quantile of transactions per card, and how many
    cards reach it."""
    cards = value_counts(by_card(df), "tx_count")
    mark = quantiles(cards, "tx_count", {"mark": share}).select(F.floor("mark")).scalar()
    return cards.agg(
        mark.alias("p99_tx_count"),
        F.sum(F.when(F.col("tx_count") >= mark, F.col("n")).otherwise(0)).alias(
            "high_velocity_cards"
        ),
    )


def weekday_hour_heatmap(df: DataFrame) -> DataFrame:
    """Fraud rate by weekday (rows, Monday 0) and hour (columns ``h0``..``h23``); 0 if empty."""
    at = F.col("transaction_ts")
    cells = (
        df.where(at.isNotNull())
        .select(
            F.weekday(at).alias("tx_dow"),
            F.concat(F.lit("h"), F.hour(at).cast("string")).alias("hour_name"),
            "is_fraud",
        )
        .groupBy("tx_dow")
        .pivot("hour_name", [f"h{hour}" for hour in range(24)])
        .agg(F.avg("is_fraud") * 100)
    )
    return cells.na.fill(0.0).orderBy("tx_dow")


def segment_exposure(segments: DataFrame) -> DataFrame:
    """Spend at risk per segment, largest first."""
    return segments.withColumn(
        "fraud_exposure", F.col("total_spend") * F.col("fraud_rate_pct") / 100
    ).orderBy(F.desc("fraud_exposure"), "prediction")
