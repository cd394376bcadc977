"""Batch job: canonical transactions to the feature table.

    python -m cardlens.jobs.features --input transactions --output features
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cardlens.jobs.prepare import write_counted
from cardlens.operators.features import feature_table
from cardlens.plans.layout import fitted_to
from cardlens.session import create_session
from cardlens.sources.columnar import WRITE_MODES, read_parquet


def build(transactions: DataFrame, target: str, mode: str = "overwrite") -> int:
    """Writes the features of ``transactions``; returns the number of rows."""
    return write_counted(feature_table(transactions), target, mode)


def run(spark: SparkSession, source: str, target: str, mode: str = "overwrite") -> int:
    return fitted_to(
        spark, source, lambda: build(read_parquet(spark, source), target, mode)
    )


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the transaction feature table.")
    parser.add_argument("--input", required=True, help="Parquet folder of transactions")
    parser.add_argument("--output", required=True, help="Parquet folder to write")
    parser.add_argument("--mode", default="overwrite", choices=WRITE_MODES)
    options = parser.parse_args(arguments)
    spark = create_session("cardlens-features")
    rows = run(spark, options.input, options.output, options.mode)
    print(f"Feature rows: {rows}")


if __name__ == "__main__":
    main()
