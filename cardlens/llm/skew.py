"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is frequent with more rows than this fraction of a task's mean rows.
FREQUENT = 0.25


def join_counted(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread: list[str], count: str = "n"
) -> DataFrame:
    """``rows`` left-joined to ``lookup``, which states how many of the rows have a key.

    ``lookup`` has one row per ``keys`` (none of them null) and should be stored, so that Spark
    knows its size and sends it to all tasks where it is small. Where it isn't, the join
    shuffles by key. Frequent keys don't wait for that: their counts add up to no more than all
    rows, so there are fewer than ``1 / FREQUENT`` for each task, and that part of the lookup is
    sent to all tasks in any case. Rows which find their key there pass through the shuffle
    under a hash of ``spread``, evenly, and are not looked up again.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = lookup.agg(F.sum(F.col(count).cast("double"))).scalar()
    values = [c for c in lookup.columns if c not in keys]
    frequent = lookup.where(F.col(count) * (tasks / FREQUENT) > total)
    frequent = frequent.select(*keys, *[F.col(c).alias(f"{c}_") for c in values])
    hashed = F.when(F.col(f"{count}_").isNotNull(), F.xxhash64(*spread).bitwiseOR(F.lit(1)))
    marked = rows.join(F.broadcast(frequent), keys, "left").withColumn(
        "aside", F.coalesce(hashed, F.lit(0).cast("long"))
    )
    others = lookup.withColumn("aside", F.lit(0).cast("long"))
    return marked.join(others, [*keys, "aside"], "left").select(
        *[F.col(c) for c in rows.columns],
        *[F.coalesce(f"{c}_", c).alias(c) for c in values],
    )
