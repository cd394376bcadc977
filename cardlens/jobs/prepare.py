"""Batch job: raw CSV to the canonical Parquet table.

    python -m cardlens.jobs.prepare --input raw.csv --output transactions
"""

from __future__ import annotations

import argparse

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardlens.operators import quality
from cardlens.operators.prepare import prepare
from cardlens.plans.layout import fitted_to
from cardlens.session import create_session
from cardlens.sources.columnar import WRITE_MODES, exists, new_rows, read_parquet, write_parquet
from cardlens.sources.delimited import read_text_csv


def write_counted(df: DataFrame, path: str, mode: str) -> int:
    """Writes ``df`` and returns the number of rows written, counted during the write.

    An existing target makes mode ``ignore`` write nothing: 0.
    """
    if mode == "ignore" and exists(df.sparkSession, path):
        return 0
    seen = Observation("written")
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode)
    return seen.get["rows"]


#: Appends only transactions whose id is not stored yet, so that a job can be repeated.
APPEND_NEW = "append-new"
JOB_MODES = (*WRITE_MODES, APPEND_NEW)


@dataclass(frozen=True)
class Written:
    """What a run has written: the audit's counts, observed while writing."""

    counts: dict[str, int]

    @property
    def rows(self) -> int:
        return self.counts["row_count"]

    def audit(self, spark: SparkSession) -> DataFrame:
        """The row of :func:`cardlens.operators.quality.audit` for the rows written."""
        schema = ", ".join(f"{name} long" for name in self.counts)
        return quality.with_shares(spark.createDataFrame([tuple(self.counts.values())], schema))


def write_audited(df: DataFrame, path: str, mode: str) -> Written:
    """Writes ``df`` with amount and label; the audit costs no pass of its own."""
    spark = df.sparkSession
    names = ["row_count", "null_amount", "non_positive_amount", "high_amount", "fraud_count"]
    there = mode in ("ignore", APPEND_NEW) and exists(spark, path)
    if mode == "ignore" and there:
        return Written(dict.fromkeys(names, 0))
    if mode == APPEND_NEW:
        mode = "append"
        if there:
            df = new_rows(df, read_parquet(spark, path).select("transaction_id"), "transaction_id")
    lacking = {c: F.lit(None).cast(t) for c, t in (("amount", "double"), ("is_fraud", "int")) if c not in df.columns}
    seen = Observation("audit")
    write_parquet(df.withColumns(lacking).observe(seen, *quality.audit_counts()).drop(*lacking), path, mode)
    return Written({n: seen.get[n] for n in names})


def run_audited(
    spark: SparkSession, source: str, target: str, mode: str = "overwrite"
) -> Written:
    """Prepares ``source`` into ``target``; returns the audit of the prepared rows.

    A source without an amount or a label counts as one where all are missing.
    """
    return fitted_to(
        spark, source, lambda: write_audited(prepare(read_text_csv(spark, source)), target, mode)
    )


def run(spark: SparkSession, source: str, target: str, mode: str = "overwrite") -> int:
    """Prepares ``source`` into ``target``; returns the number of prepared rows."""
    return run_audited(spark, source, target, mode).rows


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Prepare card transactions from CSV.")
    parser.add_argument("--input", required=True, help="CSV file, folder or glob")
    parser.add_argument("--output", required=True, help="Parquet folder to write")
    parser.add_argument("--mode", default="overwrite", choices=JOB_MODES)
    options = parser.parse_args(arguments)
    spark = create_session("cardlens-prepare")
    written = run_audited(spark, options.input, options.output, options.mode)
    print(f"Prepared rows: {written.rows}")
    print(f"Audit: {written.counts}")
    print(f"Parquet written to: {options.output}")


if __name__ == "__main__":
    main()
