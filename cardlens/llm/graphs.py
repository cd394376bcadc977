"""Connected components of links that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.session import scratch_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder that all executors share, and read again."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _to_least(links: DataFrame, larger: bool) -> DataFrame:
    """One round in which each node hands its least neighbour to the others.

    ``larger``: only neighbours above the node get it; else only those below, and the node.
    The least neighbour is a partial aggregate and the join splits large partitions, so a node
    with very many neighbours is no single task's work.
    """
    if larger:
        links = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    if larger:
        least = least.select("a", F.least("a", "least").alias("least"))
    handed = links.join(least, "a")
    if larger:
        made = handed.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        made = handed.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        made = made.union(least.select("a", F.col("least").alias("b")))
    return made.distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of undirected ``links`` (a, b); the root is the least node.

    Rounds alternate until nothing changes; their number grows with the logarithm of the
    longest chain. Nodes without a link do not occur. Links of a node to itself are ignored.
    """
    state = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        mark = state.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if mark == before or not mark[0]:
            break
        before = mark
        state = stored(_to_least(_to_least(state, larger=True), larger=False), "links")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
