"""Physical layout: the same results under different partitioning, reuse and settings."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from cardlens.catalog.registry import FINE, query, rounded
from cardlens.catalog.sql import AVG_AMOUNT, on_orders, on_tx
from cardlens.catalog.stored import stored_order_lines
from cardlens.operators import exploration
from cardlens.plans import layout
from cardlens.plans.report import summarize_plan
from cardlens.session import scratch_folder
from cardlens.sources.columnar import read_parquet, write_parquet
from cardlens.sources.star import order_lines, transactions


# Tables that the order lines are joined from, and the size of their partitions here: small,
# so that small data still have several.
_ORDER_TABLES = ("lineitem", "orders", "customer", "supplier", "part", "nation")
_PARTITION_BYTES = 1024 * 1024


def _fitting_partitions(spark, folder):
    """Partitions for the bytes that the order lines are read from."""
    paths = [f"{folder}/{name}.parquet" for name in _ORDER_TABLES]
    return layout.partitions_for(layout.stored_bytes(spark, *paths), _PARTITION_BYTES)


@query(
    "lay_01_rebalanced",
    on_orders(
        "SELECT category, CAST(count(*) AS BIGINT) AS n, true AS all_filled "
        "FROM tx_orders GROUP BY category"
    ),
)
def rebalanced(spark, folder):
    """As many even partitions as the size asks for; the column shows that all hold rows."""
    partitions = _fitting_partitions(spark, folder)
    spread = layout.rebalance(order_lines(spark, folder), partitions).select(
        "category", F.spark_partition_id().alias("pid")
    )
    filled = spread.agg(F.count_distinct("pid")).scalar() == partitions
    return spread.groupBy("category").agg(F.count("*").alias("n")).withColumn("all_filled", filled)


@query(
    "lay_02_shrunk_write",
    on_orders(
        "SELECT state, CAST(count(*) AS BIGINT) AS n, true AS few_files FROM tx_orders GROUP BY state"
    ),
)
def shrunk_write(spark, folder):
    """A quarter of those partitions as files, without a shuffle for it."""
    files = -(-_fitting_partitions(spark, folder) // 4)
    path = scratch_folder(spark, "shrunk")
    write_parquet(layout.shrink(stored_order_lines(spark, folder), files), path)
    stored = read_parquet(spark, path)
    return (
        stored.groupBy("state")
        .agg(F.count("*").alias("n"))
        .withColumn("few_files", F.lit(len(stored.inputFiles()) <= files))
    )


_PAIR = """SELECT 'category' AS kind, category AS name, round(avg(amount), 2) AS measure FROM tx_orders GROUP BY 2
UNION ALL SELECT 'state', state, CAST(sum(is_fraud) AS DOUBLE) FROM tx_orders GROUP BY 2"""


def _pair_with_reuse(spark, folder, level):
    """Both aggregates of one persisted table, each written while it is persisted."""
    df = stored_order_lines(spark, folder).select("category", "state", "amount", "is_fraud")
    path = scratch_folder(spark, "pair")
    with layout.reused(df, level) as kept:
        means = exploration.mean_amount_by_category(kept).toDF("name", "measure")
        frauds = exploration.frauds_by_state(kept).toDF("name", "measure")
        frauds = frauds.withColumn("measure", F.col("measure").cast("double"))
        write_parquet(means.select(F.lit("category").alias("kind"), "*"), path)
        write_parquet(frauds.select(F.lit("state").alias("kind"), "*"), path, "append")
    return rounded(read_parquet(spark, path), 2)


@query("lay_03_reuse_memory_and_disk", on_orders(_PAIR))
def reuse_memory_and_disk(spark, folder):
    return _pair_with_reuse(spark, folder, StorageLevel.MEMORY_AND_DISK)


@query("lay_03_reuse_disk_only", on_orders(_PAIR))
def reuse_disk_only(spark, folder):
    return _pair_with_reuse(spark, folder, StorageLevel.DISK_ONLY)


@query(
    "lay_04_wide_shuffle",
    on_tx(
        "SELECT adaptive, state, category, CAST(hour(transaction_ts) AS INT) AS hr, round(sum(amount), 2) AS total, "
        "CAST(count(*) AS BIGINT) AS cnt FROM tx CROSS JOIN (VALUES (true), (false)) a(adaptive) GROUP BY ALL"
    ),
)
def wide_shuffle(spark, folder):
    """The wide aggregate over 400 shuffle partitions, with and without adaptive merging."""
    path = scratch_folder(spark, "wide")
    groups = exploration.by_state_category_hour(transactions(spark, folder))
    for adaptive in (True, False):
        result = groups.withColumn("adaptive", F.lit(adaptive))
        layout.with_adaptive_execution(
            spark, adaptive, 400, lambda: write_parquet(result, path, "append")
        )
    return rounded(read_parquet(spark, path), 2)


@query(
    "lay_05_planned_fraud_counts",
    on_orders(
        f"SELECT category, state, CAST(count(*) AS BIGINT) AS fraud_count, {AVG_AMOUNT}, "
        "true AS filter_reaches_scan, 'amount,category,is_fraud,state' AS scanned, "
        "CAST(1 AS INT) AS group_shuffles, CAST(0 AS INT) AS python_stages "
        "FROM tx_orders WHERE is_fraud = 1 GROUP BY category, state"
    ),
)
def planned_fraud_counts(spark, folder):
    """Fraud counts of the stored table together with what their plan reads and shuffles."""
    report = exploration.fraud_by_category_and_state(stored_order_lines(spark, folder))
    plan = summarize_plan(report)
    return rounded(report, FINE).withColumns(
        {
            "filter_reaches_scan": F.lit("EqualTo(is_fraud,1)" in plan.pushed_filters),
            "scanned": F.lit(",".join(sorted(plan.scan_columns))),
            # One shuffle groups, the other is the range exchange of the final sort.
            "group_shuffles": F.lit(plan.shuffles - 1),
            "python_stages": F.lit(plan.python_stages),
        }
    )


@query(
    "lay_06_salted_totals",
    on_orders(
        "SELECT category, CAST(count(*) AS BIGINT) AS tx_count, round(sum(amount), 2) AS total, "
        "round(avg(amount), 6) AS mean FROM tx_orders GROUP BY category"
    ),
)
def salted_totals(spark, folder):
    return rounded(layout.salted_totals(order_lines(spark, folder), ["category"], "amount"), total=2)


@query(
    "lay_06_heavy_key_totals",
    on_orders(
        """, counted AS (
  SELECT category, count(*) AS n, sum(amount) AS total, avg(amount) AS mean FROM tx_orders GROUP BY category)
SELECT category, CAST(greatest(ceil(n * 16.0 / sum(n) OVER () / 0.5), 1) AS INT) AS slices, CAST(n AS BIGINT) AS tx_count,
       round(total, 2) AS total, round(mean, 6) AS mean FROM counted"""
    ),
)
def heavy_key_totals(spark, folder):
    """Totals per category; only categories above half a task's rows are cut, for 16 tasks.

    There are far fewer categories than counters in a row of the sketch, so its estimates are
    the counts unless two categories share a counter in all four rows.
    """
    totals = layout.heavy_key_totals(order_lines(spark, folder), ["category"], "amount", tasks=16)
    return rounded(totals, total=2)
