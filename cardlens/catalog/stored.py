"""Tables that several queries read, written once for each state of their sources.

The queries on volume read a prepared table, as a deployment would: the joins that derive it
run once. A table is known by the names, sizes and times of its source files, so changed files
give a new one. ``release`` forgets all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.jobs import features as features_job
from cardlens.session import scratch_folder
from cardlens.sources.columnar import read_parquet, write_parquet
from cardlens.sources.star import order_lines, transactions

Made = TypeVar("Made")

EVENT_TABLES = ("events", "customer", "nation")
ORDER_TABLES = ("lineitem", "orders", "customer", "supplier", "part", "nation")

_made: dict[tuple[str, str, str], tuple[str, object]] = {}


def _state(spark: SparkSession, folder: str, tables: tuple[str, ...]) -> str:
    """A digest of the source files' names, sizes and times; no file is read."""
    paths = [f"{folder}/{name}.parquet" for name in tables]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    facts = files.select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    return str(facts.agg(F.sum(F.col("h").cast("decimal(20,0)"))).first()[0])


def once(
    spark: SparkSession,
    folder: str,
    name: str,
    make: Callable[[], Made],
    tables: tuple[str, ...] = EVENT_TABLES,
) -> Made:
    """What ``make`` returns, made again only if the files of ``tables`` have changed."""
    key = (spark.sparkContext.applicationId, folder, name)
    state = _state(spark, folder, tables)
    if key not in _made or _made[key][0] != state:
        _made[key] = (state, make())
    return _made[key][1]


def release() -> None:
    """Forgets everything, so that the next query makes its own."""
    _made.clear()


def _written(df: DataFrame, name: str) -> str:
    path = scratch_folder(df.sparkSession, name)
    write_parquet(df, path)
    return path


def stored_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = once(
        spark, folder, "order_lines", lambda: _written(order_lines(spark, folder), "order_lines"), ORDER_TABLES
    )
    return read_parquet(spark, path)


def stored_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = once(
        spark, folder, "transactions", lambda: _written(transactions(spark, folder), "transactions")
    )
    return read_parquet(spark, path)


def built_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table, written by the feature job."""

    def make() -> str:
        path = scratch_folder(spark, "features")
        features_job.build(transactions(spark, folder), path)
        return path

    return read_parquet(spark, once(spark, folder, "features", make))
