"""Partition layout, reuse, session settings and salted aggregation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from math import ceil
from typing import TypeVar

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.session import scratch_released, settled

Result = TypeVar("Result")


def rebalance(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Full shuffle into ``partitions``: round robin, or by a hash of ``keys``."""
    return df.repartition(partitions, *keys)


def shrink(df: DataFrame, partitions: int) -> DataFrame:
    """At most ``partitions`` partitions, merged without a shuffle. For use before a write."""
    return df.coalesce(partitions)


@contextmanager
def reused(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """``df`` persisted while the block runs, for two or more passes over it.

    A block lost with its executor is computed again from the lineage.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def under_settings(
    spark: SparkSession, settings: dict[str, str], work: Callable[[], Result]
) -> Result:
    """Runs ``work`` with session settings and restores the previous ones.

    ``work`` has to finish its actions: a DataFrame executed later runs under the
    settings of that moment.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return work()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
SCAN_TASK_BYTES = 128 * 1024 * 1024
LARGEST_SCAN_TASK_BYTES = 1024 * 1024 * 1024
MOST_SCAN_TASKS = 100_000


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files under ``paths``; lists them without reading any."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.sum("length")).first()[0] or 0


def partitions_for(size: int, partition_bytes: int = SHUFFLE_PARTITION_BYTES) -> int:
    """Partitions of about ``partition_bytes`` for ``size`` bytes, at least one."""
    return max(1, ceil(size / partition_bytes))


def fitting_settings(spark: SparkSession, *sources: str) -> dict[str, str]:
    """Session settings for scanning and shuffling the tables ``sources``.

    Adaptive execution merges small shuffle partitions but never adds any, so their
    number has to follow the input; it is only ever raised. Scan tasks grow beyond
    Spark's default once there would be more of them than the scheduler and the map
    output tracking handle well, unless their size was set by hand.
    """
    size = stored_bytes(spark, *sources)
    shuffle, scan = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    settings = {shuffle: str(max(partitions_for(size), int(spark.conf.get(shuffle))))}
    per_task = min(ceil(size / MOST_SCAN_TASKS), LARGEST_SCAN_TASK_BYTES)
    if per_task > SCAN_TASK_BYTES and spark.conf.get(scan) == f"{SCAN_TASK_BYTES}b":
        settings[scan] = f"{per_task}b"
    return settings


def fitted_to(spark: SparkSession, source: str, work: Callable[[], Result]) -> Result:
    """Runs ``work`` under settings that fit the size of ``source``, and deletes the
    intermediate tables that it has stored."""
    with scratch_released(spark):
        return under_settings(spark, fitting_settings(spark, source), work)


def with_adaptive_execution(
    spark: SparkSession, enabled: bool, partitions: int, work: Callable[[], Result]
) -> Result:
    """Runs ``work`` with adaptive execution on or off and ``partitions`` shuffle partitions."""
    settings = {
        "spark.sql.adaptive.enabled": str(enabled).lower(),
        "spark.sql.shuffle.partitions": str(partitions),
    }
    return under_settings(spark, settings, work)


def salted_totals(
    df: DataFrame,
    keys: list[str],
    value: str,
    salts: int = 16,
    spread_by: str = "transaction_id",
) -> DataFrame:
    """Count, sum and mean per key in two shuffles, the first on (key, slice).

    Spark already combines sums map-side, so this pays off when the partial rows of
    a hot key are themselves too many for one reducer.
    """
    sliced = df.withColumn("slice", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    partial = sliced.groupBy(*keys, "slice").agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("known"), F.sum(value).alias("part")
    )
    return partial.groupBy(*keys).agg(
        F.sum("n").alias("tx_count"),
        F.sum("part").alias("total"),
        F.try_divide(F.sum("part"), F.sum("known")).alias("mean"),
    )


#: Rows and counters of a count-min sketch; heavy keys are those above a share of a task.
SKETCH_ROWS, SKETCH_WIDTH = 4, 1 << 12
HEAVY_SHARE = 0.5


def key_sketch(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``counters``: a count-min sketch of the rows of each key.

    Every row adds 1 to a counter in each of ``SKETCH_ROWS`` rows of ``SKETCH_WIDTH`` counters;
    tasks add up their own before the shuffle, and what meets is as small as the sketch,
    however many keys there are.
    """
    slots = df.select(F.explode(F.array(*_slots(keys))).alias("slot"))
    counts = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(SKETCH_ROWS * SKETCH_WIDTH).select(F.col("id").cast("int").alias("slot"))
    filled = every.join(F.broadcast(counts), "slot", "left").select("slot", F.coalesce("n", F.lit(0)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("slot", "n")))
    return filled.agg(F.transform(ordered, lambda s: s["n"]).alias("counters"))


def _slots(keys: list[str]) -> list[Column]:
    """The places of a key's counters in the sketch, one in each of its rows."""
    return [
        (F.pmod(F.xxhash64(F.lit(r), *keys), F.lit(SKETCH_WIDTH)) + r * SKETCH_WIDTH).cast("int")
        for r in range(SKETCH_ROWS)
    ]


def with_key_slices(
    df: DataFrame, keys: list[str], tasks: int, name: str = "slices"
) -> DataFrame:
    """Adds in how many slices a row's key should be cut, by its volume; most get 1.

    A key's rows are estimated from the sketch, never too low. Keys above ``HEAVY_SHARE`` of a
    task's mean rows are heavy and are cut in proportion. All rows of a key get the same number.
    """
    counters = settled(key_sketch(df, keys))
    total = counters.select(F.aggregate(F.slice("counters", 1, SKETCH_WIDTH), F.lit(0).cast("long"), lambda a, n: a + n)).scalar()
    values = counters.scalar()
    estimate = F.least(*[F.get(values, slot) for slot in _slots(keys)])
    slices = F.ceil(F.try_divide(estimate * F.lit(float(tasks)), total) / HEAVY_SHARE)
    return df.withColumn(name, F.greatest(slices, F.lit(1)).cast("int"))


def heavy_key_totals(
    df: DataFrame,
    keys: list[str],
    value: str,
    tasks: int | None = None,
    spread_by: str = "transaction_id",
) -> DataFrame:
    """Count, sum and mean per key, and the ``slices`` that the key was summed in.

    Like :func:`salted_totals`, but only heavy keys are cut, in proportion to their volume; the
    others take one slice and their partial rows are not multiplied.
    """
    if tasks is None:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = with_key_slices(df, keys, tasks)
    sliced = cut.withColumn("slice", F.pmod(F.xxhash64(spread_by), "slices"))
    partial = sliced.groupBy(*keys, "slices", "slice").agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("known"), F.sum(value).alias("part")
    )
    return partial.groupBy(*keys, "slices").agg(
        F.sum("n").alias("tx_count"),
        F.sum("part").alias("total"),
        F.try_divide(F.sum("part"), F.sum("known")).alias("mean"),
    )
