"""Batch job: every exploratory and portfolio report of the feature table.

    python -m cardlens.jobs.reports --input features --output reports

The feature table is columnar, so each report reads just its own two to five columns.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.operators import exploration, portfolio, quality
from cardlens.operators import statistics as stats
from cardlens.operators.ranking import cumulative_distribution, value_counts
from cardlens.plans.layout import fitted_to
from cardlens.session import create_session
from cardlens.sources.columnar import read_parquet, restore_amount, write_parquet

DESCRIBED = ("amount", "amount_log1p", "city_pop", "cardholder_age", "merch_distance_km")


def _correlations(report: Callable[[DataFrame, list[str]], DataFrame], df: DataFrame) -> DataFrame:
    rows = stats.correlation_input(df)
    return report(rows, rows.columns)


def _trends(df: DataFrame) -> DataFrame:
    """Lines of the monthly spend and fraud rate."""
    months = exploration.monthly_series(df)
    lines = [
        stats.trend(months, value).withColumn("series", F.lit(value))
        for value in ("total_spend_log1p", "fraud_rate_pct")
    ]
    return lines[0].unionByName(lines[1])


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "describe": lambda df: exploration.describe(df, [c for c in DESCRIBED if c in df.columns]),
    "null_report": quality.null_report,
    "correlation_matrix": lambda df: _correlations(stats.correlation_matrix, df),
    "label_correlations": lambda df: _correlations(stats.label_correlations, df),
    "monthly_trends": _trends,
    "distance_histogram": lambda df: stats.histogram(df, "merch_distance_km", 60),
    "card_volume_histogram": lambda df: stats.histogram(
        portfolio.by_card(df), "tx_count", 60, label=None
    ),
    "merchant_rate_histogram": lambda df: stats.histogram(
        portfolio.by_merchant(df), "fraud_rate", 40, label=None
    ),
    "category_lookup": exploration.category_lookup,
    "state_category_hour": exploration.by_state_category_hour,
    "card_category_hour": exploration.by_card_category_hour,
    "riskiest_merchant_rates": exploration.riskiest_merchant_rates,
    "class_balance": exploration.class_balance,
    "amount_by_label": exploration.amount_by_label,
    "hours": exploration.by_hour,
    "riskiest_hours": exploration.riskiest_hours,
    "weekdays": exploration.by_weekday,
    "months": exploration.by_month,
    "categories": exploration.by_category,
    "riskiest_merchants": exploration.riskiest_merchants,
    "busiest_states": exploration.busiest_states,
    "distance": exploration.by_distance,
    "distance_five_bands": exploration.by_distance_five_bands,
    "age": exploration.by_age,
    "age_log_amount": exploration.by_age_log_amount,
    "gender": exploration.by_gender,
    "gender_by_category": exploration.gender_by_top_category,
    "monthly_series": exploration.monthly_series,
    "category_by_state": exploration.by_category_and_state,
    "fraud_by_category_and_state": exploration.fraud_by_category_and_state,
    "amount_histogram": lambda df: stats.histogram(df, "amount", 80),
    "amount_five_numbers": stats.clipped_five_numbers,
    "amount_cdf": lambda df: cumulative_distribution(
        value_counts(df, "amount", ("is_fraud",)), "amount", ("is_fraud",)
    ),
    "iqr_outliers": stats.iqr_outliers,
    "zscore_outliers": stats.zscore_outliers,
    "kpis": portfolio.kpis,
    "detection_value": portfolio.detection_value,
    "category_risk": portfolio.by_category,
    "hour_risk": portfolio.by_hour,
    "weekday_risk": portfolio.by_weekday,
    "monthly_risk": portfolio.by_month,
    "riskiest_states": portfolio.riskiest_states,
    "most_exposed_states": portfolio.most_exposed_states,
    "amount_tier_risk": portfolio.by_amount_tier,
    "age_tier_risk": portfolio.by_age_tier,
    "gender_risk": portfolio.by_gender,
    "distance_tier_risk": portfolio.by_distance_tier,
    "time_of_day_risk": portfolio.by_time_of_day,
    "merchant_risk": portfolio.riskiest_merchants,
    "merchant_rate_marks": portfolio.merchant_rate_marks,
    "cards": portfolio.by_card,
    "high_velocity_cards": portfolio.high_velocity_cards,
    "heatmap": portfolio.weekday_hour_heatmap,
}


_GROUPED = ("is_fraud",)
_MONEY = ("is_fraud", "amount")

# Columns without which a report has nothing to say.
NEEDS: dict[str, tuple[str, ...]] = {
    "describe": ("amount",),
    "null_report": (),
    "correlation_matrix": _MONEY,
    "label_correlations": _MONEY,
    "monthly_trends": (*_GROUPED, "transaction_ts", "amount_log1p"),
    "distance_histogram": (*_GROUPED, "merch_distance_km"),
    "card_volume_histogram": (*_MONEY, "card_id"),
    "merchant_rate_histogram": (*_MONEY, "merchant"),
    "category_lookup": (*_MONEY, "category"),
    "state_category_hour": ("amount", "state", "category", "transaction_ts"),
    "card_category_hour": ("amount", "card_id", "category", "transaction_ts"),
    "riskiest_merchant_rates": (*_GROUPED, "merchant"),
    "class_balance": _GROUPED,
    "amount_by_label": _MONEY,
    "hours": (*_GROUPED, "transaction_ts"),
    "riskiest_hours": (*_GROUPED, "transaction_ts"),
    "weekdays": (*_GROUPED, "transaction_ts"),
    "months": (*_GROUPED, "transaction_ts"),
    "categories": (*_MONEY, "category"),
    "riskiest_merchants": (*_MONEY, "merchant"),
    "busiest_states": (*_MONEY, "state"),
    "distance": (*_GROUPED, "merch_distance_km"),
    "distance_five_bands": (*_GROUPED, "merch_distance_km"),
    "age": (*_MONEY, "cardholder_age"),
    "age_log_amount": (*_GROUPED, "cardholder_age", "amount_log1p"),
    "gender": (*_MONEY, "gender"),
    "gender_by_category": ("gender", "category", "amount_log1p"),
    "monthly_series": (*_GROUPED, "transaction_ts", "amount_log1p"),
    "category_by_state": (*_MONEY, "category", "state"),
    "fraud_by_category_and_state": (*_MONEY, "category", "state"),
    "amount_histogram": _MONEY,
    "amount_five_numbers": _MONEY,
    "amount_cdf": _MONEY,
    "iqr_outliers": _MONEY,
    "zscore_outliers": _MONEY,
    "kpis": (*_MONEY, "transaction_ts", "card_id", "merchant", "state", "category"),
    "detection_value": _MONEY,
    "category_risk": (*_MONEY, "category"),
    "hour_risk": (*_MONEY, "transaction_ts"),
    "weekday_risk": (*_MONEY, "transaction_ts"),
    "monthly_risk": (*_MONEY, "transaction_ts"),
    "riskiest_states": (*_MONEY, "state"),
    "most_exposed_states": (*_MONEY, "state"),
    "amount_tier_risk": _MONEY,
    "age_tier_risk": (*_MONEY, "cardholder_age"),
    "gender_risk": (*_MONEY, "gender"),
    "distance_tier_risk": (*_MONEY, "merch_distance_km"),
    "time_of_day_risk": (*_MONEY, "transaction_ts"),
    "merchant_risk": (*_MONEY, "merchant"),
    "merchant_rate_marks": (*_MONEY, "merchant"),
    "cards": (*_MONEY, "card_id"),
    "high_velocity_cards": (*_MONEY, "card_id"),
    "heatmap": (*_GROUPED, "transaction_ts"),
}


def available(features: DataFrame) -> list[str]:
    """Names of the reports for which ``features`` has the columns."""
    return [name for name in REPORTS if set(NEEDS[name]) <= set(features.columns)]


def run(
    spark: SparkSession, source: str, target: str, names: list[str] | None = None
) -> list[str]:
    """Writes the named reports (default: all) below ``target``; returns the names.

    Reports on columns that the source does not have are left out.
    """
    features = restore_amount(read_parquet(spark, source))
    chosen = [n for n in available(features) if names is None or n in names]

    def write_all() -> None:
        for name in chosen:
            write_parquet(REPORTS[name](features), f"{target}/{name}")

    fitted_to(spark, source, write_all)
    return chosen


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write the transaction reports.")
    parser.add_argument("--input", required=True, help="Parquet folder of features")
    parser.add_argument("--output", required=True, help="folder that gets one folder per report")
    parser.add_argument("--report", action="append", choices=list(REPORTS), help="only these")
    options = parser.parse_args(arguments)
    spark = create_session("cardlens-reports")
    for name in run(spark, options.input, options.output, options.report):
        print(f"Wrote {name}")


if __name__ == "__main__":
    main()
