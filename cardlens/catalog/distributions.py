"""Distributions, windows, ordering, samples, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlens.catalog.registry import query, rounded
from cardlens.catalog.sql import on_features, on_orders, on_tx
from cardlens.operators import exploration, features as features_ops, portfolio, sampling
from cardlens.operators import statistics as stats
from cardlens.operators.ranking import cumulative_distribution, value_counts
from cardlens.operators.selection import with_label
from cardlens.sources.star import order_lines, transactions


def _histogram_sql(table: str, value: str, bins: int) -> str:
    return f""", ranges AS (
  SELECT is_fraud, min({value}) AS low, (max({value}) - min({value})) / {bins} AS width, count(*) AS total
  FROM {table} WHERE {value} IS NOT NULL AND is_fraud IN (0, 1) GROUP BY is_fraud),
slots AS (
  SELECT is_fraud, least(CAST(floor((CAST({value} AS DOUBLE) - low) / width) AS INT), {bins - 1}) AS bin
  FROM {table} JOIN ranges USING (is_fraud) WHERE {value} IS NOT NULL)
SELECT CAST(is_fraud AS INT) AS is_fraud, CAST(bin AS INT) AS bin, round(any_value(low + bin * width), 6) AS bin_start,
       CAST(count(*) AS BIGINT) AS n, round(count(*) / any_value(total * width), 9) AS density
FROM slots JOIN ranges USING (is_fraud) GROUP BY is_fraud, bin"""


@query("agg_54_amount_histogram", on_tx(_histogram_sql("tx", "amount", 80)))
def amount_histogram(spark, folder):
    return rounded(stats.histogram(transactions(spark, folder), "amount", 80), density=9)


@query("agg_54_distance_histogram", on_features(_histogram_sql("fx", "merch_distance_km", 60)))
def distance_histogram(spark, folder):
    df = transactions(spark, folder).transform(features_ops.add_distance)
    return rounded(stats.histogram(df, "merch_distance_km", 60), density=9)


def _plain_histogram_sql(groups: str, value: str, bins: int) -> str:
    return f""", points AS ({groups}),
ranges AS (
  SELECT min({value}) AS low, (max({value}) - min({value})) / {bins}::DOUBLE AS width, count(*) AS total FROM points),
slots AS (
  SELECT CASE WHEN width > 0 THEN least(CAST(floor((CAST({value} AS DOUBLE) - low) / width) AS INT), {bins - 1})
              ELSE 0 END AS bin, low, width, total
  FROM points, ranges)
SELECT CAST(bin AS INT) AS bin, round(low + bin * width, 6) AS bin_start, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / nullif(total * width, 0), 9) AS density
FROM slots GROUP BY bin, low, width, total"""


@query(
    "agg_54_card_volume_histogram",
    on_orders(
        _plain_histogram_sql(
            "SELECT count(is_fraud) AS tx_count FROM tx_orders GROUP BY card_id", "tx_count", 60
        )
    ),
)
def card_volume_histogram(spark, folder):
    cards = portfolio.by_card(order_lines(spark, folder))
    return rounded(stats.histogram(cards, "tx_count", 60, label=None), density=9)


@query(
    "agg_54_merchant_rate_histogram",
    on_tx(
        _plain_histogram_sql(
            "SELECT sum(is_fraud)::DOUBLE / count(is_fraud) * 100 AS rate FROM tx GROUP BY merchant "
            "HAVING count(is_fraud) >= 20",
            "rate",
            40,
        )
    ),
)
def merchant_rate_histogram(spark, folder):
    merchants = portfolio.by_merchant(transactions(spark, folder))
    return rounded(stats.histogram(merchants, "fraud_rate", 40, label=None), density=9)


@query(
    "agg_55_clipped_five_numbers",
    on_tx(
        """, cut AS (SELECT quantile_cont(amount, 0.99) AS p99 FROM tx)
SELECT CAST(is_fraud AS INT) AS is_fraud, round(min(amount), 6) AS min, round(quantile_cont(amount, 0.25), 6) AS q1,
       round(quantile_cont(amount, 0.5), 6) AS median, round(quantile_cont(amount, 0.75), 6) AS q3,
       round(max(amount), 6) AS max
FROM tx, cut WHERE amount <= p99 GROUP BY is_fraud"""
    ),
)
def clipped_five_numbers(spark, folder):
    return rounded(stats.clipped_five_numbers(transactions(spark, folder)))


@query(
    "win_03_empirical_cdf",
    on_orders(
        """, ranked AS (
  SELECT is_fraud, amount, cume_dist() OVER (PARTITION BY is_fraud ORDER BY amount) AS cdf FROM tx_orders)
SELECT CAST(is_fraud AS INT) AS is_fraud, amount, CAST(count(*) AS BIGINT) AS n, round(any_value(cdf), 9) AS cdf
FROM ranked GROUP BY is_fraud, amount"""
    ),
)
def empirical_cdf(spark, folder):
    counts = value_counts(order_lines(spark, folder), "amount", ("is_fraud",))
    return rounded(cumulative_distribution(counts, "amount", ("is_fraud",)), cdf=9)


@query(
    "win_04_time_index",
    on_orders(
        """, months AS (SELECT strftime(transaction_ts, '%Y-%m') AS year_month, count(*) AS n FROM tx_orders GROUP BY 1)
SELECT year_month, CAST(n AS BIGINT) AS tx_count, CAST(row_number() OVER (ORDER BY year_month) - 1 AS INT) AS t
FROM months"""
    ),
)
def time_index(spark, folder):
    df = order_lines(spark, folder).transform(features_ops.add_amount_shape)
    return exploration.monthly_series(df).select("year_month", "tx_count", "t")


@query(
    "srt_01_sorted_cards",
    on_orders(
        "SELECT card_id, CAST(count(is_fraud) AS BIGINT) AS tx_count, round(sum(amount), 2) AS total_spend "
        "FROM tx_orders GROUP BY card_id ORDER BY total_spend DESC, card_id"
    ),
)
def sorted_cards(spark, folder):
    cards = portfolio.by_card(order_lines(spark, folder)).select("card_id", "tx_count", "total_spend")
    return rounded(cards, 2).orderBy(F.desc("total_spend"), "card_id")


@query(
    "srt_02_top_cards",
    on_orders(
        "SELECT card_id, round(sum(amount), 2) AS total_spend FROM tx_orders GROUP BY card_id "
        "ORDER BY total_spend DESC, card_id LIMIT 10"
    ),
)
def top_cards(spark, folder):
    cards = portfolio.by_card(order_lines(spark, folder)).select("card_id", "total_spend")
    return rounded(cards, 2).orderBy(F.desc("total_spend"), "card_id").limit(10)


@query(
    "set_01_union_of_classes",
    on_tx(
        "SELECT transaction_id, amount, CAST(is_fraud AS INT) AS is_fraud FROM tx WHERE is_fraud = 1 "
        "UNION ALL SELECT transaction_id, amount, CAST(is_fraud AS INT) FROM tx WHERE is_fraud = 0"
    ),
)
def union_of_classes(spark, folder):
    df = transactions(spark, folder).select("transaction_id", "amount", "is_fraud")
    return sampling.union([with_label(df, 1), with_label(df, 0)])


@query(
    "set_02_distinct_pairs",
    on_features("SELECT DISTINCT tx_day_of_week, tx_is_weekend FROM fx"),
)
def distinct_pairs(spark, folder):
    df = transactions(spark, folder).transform(features_ops.add_temporal)
    return sampling.distinct_pairs(df, "tx_day_of_week", "tx_is_weekend")


@query("smp_01_sample")
def sample(spark, folder):
    df = transactions(spark, folder).select("transaction_id", "amount", "is_fraud")
    return sampling.sample(df, 0.1)


@query(
    "smp_01_sample_facts",
    on_tx("SELECT CAST(count(*) AS BIGINT) AS n, true AS rows_of_the_table, true AS near_a_tenth FROM tx"),
)
def sample_facts(spark, folder):
    """The sample's rows are rows of the table, about a tenth (within five standard errors)."""
    df = transactions(spark, folder).select("transaction_id", "amount", "is_fraud")
    total = df.agg(F.count(F.lit(1))).scalar()
    taken = sample(spark, folder).withColumn("taken", F.lit(True))
    return df.join(taken, df.columns, "full").agg(
        total.alias("n"),
        (F.count(F.lit(1)) == total).alias("rows_of_the_table"),
        (F.abs(F.count("taken") - total * 0.1) <= F.sqrt(total * 0.09) * 5).alias("near_a_tenth"),
    )


_LINE = ("transaction_id", "card_id", "merchant", "amount")


@query("smp_02_fixed_size_sample")
def fixed_size_sample(spark, folder):
    """60 000 rows, or all of them if there are no more."""
    df = order_lines(spark, folder).select(*_LINE, "is_fraud")
    return sampling.fixed_size_sample(df, keys=_LINE)


@query(
    "smp_02_sample_size",
    on_orders("SELECT CAST(least(count(*), 2000) AS BIGINT) AS n FROM tx_orders"),
)
def sample_size(spark, folder):
    df = order_lines(spark, folder).select(*_LINE, "is_fraud")
    return sampling.fixed_size_sample(df, 2000, keys=_LINE).agg(F.count("*").alias("n"))


def _parts(train, test):
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query("smp_03_split")
def split(spark, folder):
    df = transactions(spark, folder).select("transaction_id", "amount")
    return _parts(*sampling.split(df))


@query("smp_03_split_covers_all", on_tx("SELECT transaction_id, CAST(1 AS BIGINT) AS parts FROM tx"))
def split_covers_all(spark, folder):
    return split(spark, folder).groupBy("transaction_id").agg(F.count("part").alias("parts"))


@query("smp_04_stratified_split")
def stratified_split(spark, folder):
    df = transactions(spark, folder).select("transaction_id", "is_fraud")
    return _parts(*sampling.stratified_split(df))


@query(
    "smp_04_stratified_split_covers_all",
    on_tx(
        "SELECT CAST(is_fraud AS INT) AS is_fraud, CAST(count(*) AS BIGINT) AS n, true AS near_80_pct "
        "FROM tx GROUP BY is_fraud"
    ),
)
def stratified_split_covers_all(spark, folder):
    """Every class is split near 80 to 20 (within five standard errors)."""
    in_train = F.count_if(F.col("part") == "train")
    off = F.abs(in_train - F.count("*") * 0.8)
    return (
        stratified_split(spark, folder)
        .groupBy("is_fraud")
        .agg(
            F.count("*").alias("n"),
            (off <= F.sqrt(F.count("*") * 0.16) * 5).alias("near_80_pct"),
        )
    )


@query(
    "ml_15_iqr_outliers",
    on_tx(
        """, q AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM tx),
fence AS (SELECT q3 + (q3 - q1) * 1.5 AS f FROM q)
SELECT round(any_value(f), 6) AS upper_fence, CAST(count(*) FILTER (amount > f) AS BIGINT) AS outliers,
       CAST(count(*) FILTER (amount > f AND is_fraud = 1) AS BIGINT) AS fraud_outliers
FROM tx, fence"""
    ),
)
def iqr_outliers(spark, folder):
    return rounded(stats.iqr_outliers(transactions(spark, folder)))


@query(
    "ml_16_zscore_outliers",
    on_tx(
        """, m AS (SELECT avg(amount) AS mean, stddev_samp(amount) AS sd FROM tx)
SELECT CAST(count(*) FILTER (abs((amount - mean) / sd) > 3) AS BIGINT) AS outliers,
       CAST(count(*) FILTER (abs((amount - mean) / sd) > 3 AND is_fraud = 1) AS BIGINT) AS fraud_outliers
FROM tx, m"""
    ),
)
def zscore_outliers(spark, folder):
    return stats.zscore_outliers(transactions(spark, folder))
