"""Enrichment joins.

A lookup table is computed once and stored, so Spark knows its size and broadcasts it below
``spark.sql.autoBroadcastJoinThreshold``. Beyond that the join shuffles, and adaptive execution
splits what is skewed. The sliced join does not rely on that: it cuts keys by their volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions.bands import Bands
from cardlens.session import settled


def lookup_join(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``facts`` left-joined to a table with one row per ``key``, computed once."""
    joined = facts.join(settled(dim), key, "left")
    return joined.select(*facts.columns, *[c for c in dim.columns if c != key])


def broadcast_lookup(facts: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Left join against a table whose size has a bound."""
    joined = facts.join(F.broadcast(small), key, "left")
    return joined.select(*facts.columns, *[c for c in small.columns if c != key])


def key_slices(facts: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """``key, slices`` of every key with more than half the rows of a mean task.

    The missing key counts as one. Rows are counted with partial aggregates; fewer than
    ``2 * tasks`` keys can be that large, which bounds the result.
    """
    if tasks is None:
        tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = settled(facts.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    share = F.col("n") * (2.0 * tasks) / counts.agg(F.sum("n")).scalar()
    return counts.where(share > 1).select(key, F.ceil(share).cast("int").alias("slices"))


def sliced_lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: str = "transaction_id",
    tasks: int | None = None,
) -> DataFrame:
    """The same left join as a sort-merge join, large keys cut into slices.

    A key that holds a third of the facts is spread over a third of the tasks, and only the
    dimension rows of such keys are repeated, as often as the key is cut. The slice is a hash
    of the row, not a random number, so a recomputed task yields the same slices.
    """
    large = settled(key_slices(facts, key, tasks)).withColumnRenamed(key, "large_key")
    spread = [spread_by] if spread_by in facts.columns else facts.columns
    cut = F.coalesce("slices", F.lit(1))
    sliced = (
        facts.join(F.broadcast(large), F.col(key).eqNullSafe(F.col("large_key")), "left")
        .withColumn("slice", F.pmod(F.xxhash64(*spread), cut).cast("int"))
        .drop("large_key", "slices")
    )
    copies = (
        dim.join(F.broadcast(large), F.col(key).eqNullSafe(F.col("large_key")), "left")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), cut - 1)))
        .drop("large_key", "slices")
    )
    joined = sliced.join(copies.hint("merge"), [key, "slice"], "left")
    return joined.select(*facts.columns, *[c for c in dim.columns if c != key])


def merge_lookup(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """The sort-merge join with slices for the session's number of shuffle partitions."""
    return sliced_lookup(facts, dim, key)


def salted_lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    salts: int = 32,
    spread_by: str = "transaction_id",
) -> DataFrame:
    """The sort-merge join with slices for ``salts`` times as many tasks."""
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sliced_lookup(facts, dim, key, spread_by, tasks * salts)


def in_band_order(groups: DataFrame, bands: Bands, fill: bool = True) -> DataFrame:
    """``groups`` in the fixed order of ``bands``; with ``fill`` empty bands appear as NULLs.

    The label table has one row per band, so it is always safe to broadcast.
    """
    labels = bands.dimension(groups.sparkSession)
    measures = [c for c in groups.columns if c != bands.name]
    if fill:
        joined = labels.join(groups, bands.name, "left")
    else:
        joined = groups.join(F.broadcast(labels), bands.name)
    return joined.orderBy("position").select(bands.name, *measures)


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """``total / (2 * count)`` for the labels 0 and 1: at most two rows."""
    counts = df.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, (total / (F.col("n") * 2.0)).alias("class_weight"))


def with_class_weight(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Each row with the balancing weight of its class. Two rows are broadcast."""
    return broadcast_lookup(df, class_weights(df, label), label)
