"""Batch job: train all models on the feature table and write their reports.

    python -m cardlens.jobs.models --input features --output model_reports
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cardlens.operators import models, portfolio
from cardlens.operators.models import ForestSettings, FraudSettings
from cardlens.plans.layout import fitted_to
from cardlens.session import create_session
from cardlens.sources.columnar import read_parquet, write_parquet


def reports(
    features: DataFrame,
    fraud: FraudSettings = FraudSettings(),
    forest: ForestSettings = ForestSettings(),
) -> dict[str, DataFrame]:
    """Fits every model and gives the report tables by name."""
    study = models.fit_fraud_models(features, fraud)
    confusion = models.confusion_matrix(study.predictions("GBT"), "is_fraud")

    cards = models.segment_vectors(models.card_profiles(features))
    sweep = models.segment_sweep(cards)
    best = models.best_by(sweep, "k", "silhouette").first()["k"]
    segments = models.assign_segments(cards, best)
    profiles = models.segment_profiles(segments)

    category, category_predictions = models.fit_category_model(features, forest)
    category_confusion = models.confusion_matrix(category_predictions, "category_idx")
    amount, amount_predictions = models.fit_amount_model(features, forest)

    importances = models.feature_importances(
        study.models["Random Forest"], models.FRAUD_FEATURES, "fraud"
    )
    for model, inputs, name in (
        (category, models.CATEGORY_FEATURES, "category"),
        (amount, models.AMOUNT_FEATURES, "amount"),
    ):
        importances = importances.unionByName(models.feature_importances(model, inputs, name))

    return {
        "fraud_scores": models.fraud_scores(study),
        "fraud_confusion": models.square_confusion_matrix(confusion, [0, 1]),
        "fraud_report": models.classification_report(confusion, models.LABEL_NAMES),
        "importances": importances,
        "segment_sweep": sweep,
        "segments": segments.select("card_id", "prediction"),
        "segment_exposure": portfolio.segment_exposure(profiles),
        "category_report": models.classification_report(
            category_confusion, models.category_names(features)
        ),
        "category_scores": models.category_scores(category_confusion),
        "amount_scores": models.regression_scores(amount_predictions),
    }


def run(
    spark: SparkSession,
    source: str,
    target: str,
    fraud: FraudSettings = FraudSettings(),
    forest: ForestSettings = ForestSettings(),
) -> list[str]:
    """Writes every model report below ``target``; returns the names."""

    def write_all() -> list[str]:
        tables = reports(read_parquet(spark, source), fraud, forest)
        for name, table in tables.items():
            # The square matrix has the classes as column names.
            named = [c if not c.isdigit() else f"predicted_{c}" for c in table.columns]
            write_parquet(table.toDF(*named), f"{target}/{name}")
        return list(tables)

    return fitted_to(spark, source, write_all)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train the models and write their reports.")
    parser.add_argument("--input", required=True, help="Parquet folder of features")
    parser.add_argument("--output", required=True, help="folder that gets one folder per report")
    options = parser.parse_args(arguments)
    spark = create_session("cardlens-models")
    for name in run(spark, options.input, options.output):
        print(f"Wrote {name}")


if __name__ == "__main__":
    main()
