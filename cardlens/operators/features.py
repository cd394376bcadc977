"""Feature engineering. Every group is skipped if its source columns are absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import bands as B
from cardlens.functions import expressions as X
from cardlens.operators.joins import lookup_join
from cardlens.operators.ranking import number_rows
from cardlens.operators.selection import select_features
from cardlens.session import settled


def _has(df: DataFrame, *columns: str) -> bool:
    return set(columns) <= set(df.columns)


def add_temporal(df: DataFrame) -> DataFrame:
    if not _has(df, "transaction_ts"):
        return df
    at = F.col("transaction_ts")
    return df.withColumns(
        {
            "tx_hour": F.hour(at),
            "tx_day_of_week": F.dayofweek(at),
            "tx_month": F.month(at),
            "tx_is_weekend": X.is_weekend(at),
            "tx_time_of_day": B.TIME_OF_DAY.of(F.hour(at)),
        }
    )


def add_amount_shape(df: DataFrame) -> DataFrame:
    """Logarithm and size bin: no pass over other rows needed."""
    if not _has(df, "amount"):
        return df
    return df.withColumns(
        {
            "amount_log1p": F.log1p("amount"),
            "amount_bin": B.AMOUNT_BINS.of(F.col("amount")),
        }
    )


def amount_moments(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("amount").alias("mean"), F.stddev_samp("amount").alias("stddev"))


def add_amount_zscore(df: DataFrame) -> DataFrame:
    """Z-score against the whole table; mean and deviation are a one-row subquery."""
    if not _has(df, "amount"):
        return df
    moments = amount_moments(df).select(F.struct("mean", "stddev")).scalar()
    score = X.zscore(F.col("amount"), moments.getField("mean"), moments.getField("stddev"))
    return df.withColumn("amount_zscore", score)


def add_distance(df: DataFrame) -> DataFrame:
    corners = ("lat", "long", "merch_lat", "merch_long")
    if not _has(df, *corners):
        return df
    return df.withColumn("merch_distance_km", X.distance_km(*[F.col(c) for c in corners]))


def add_epoch_seconds(df: DataFrame) -> DataFrame:
    if not _has(df, "transaction_ts"):
        return df
    return df.withColumn("tx_unix", F.unix_timestamp("transaction_ts"))


def card_velocity(df: DataFrame, lookback: int = 3600) -> DataFrame:
    """Count and amount on the card in the ``lookback`` seconds before each second.

    ``card_id, tx_unix, card_tx_count_1h, card_amount_sum_1h``, one row per card and
    second that has a transaction; transactions of the second itself are left out.

    Rows of one second are summed before the first shuffle. Time is cut into pieces as
    long as the lookback, so the window of a second at offset x of its piece is the
    earlier offsets of the same piece and the offsets from x on of the piece before.
    Each piece is therefore copied to the next one and both parts are running sums over
    the offsets, one forward and one backward. A task holds at most two pieces of one
    card however busy the card is, and the work is linear: a sliding frame would add up
    the whole window again for every row.
    """
    second = F.col("tx_unix")
    piece = F.floor(second / lookback)
    own = F.struct(piece.alias("piece"), F.lit(True).alias("own"))
    copy = F.struct((piece + 1).alias("piece"), F.lit(False).alias("own"))
    pieces = (
        df.groupBy("card_id", "tx_unix")
        .agg(F.count("transaction_id").alias("n"), F.sum("amount").alias("spent"))
        .withColumn("offset", F.pmod(second, F.lit(lookback)))
        .select("*", F.inline(F.when(second.isNull(), F.array(own)).otherwise(F.array(own, copy))))
    )
    in_piece = Window.partitionBy("card_id", "piece")
    earlier = in_piece.orderBy("offset").rangeBetween(Window.unboundedPreceding, -1)
    later = in_piece.orderBy(F.desc("offset")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )

    def in_window(column: str) -> Column:
        same_piece = F.sum(F.when(F.col("own"), F.col(column))).over(earlier)
        piece_before = F.sum(F.when(~F.col("own"), F.col(column))).over(later)
        return F.coalesce(same_piece + piece_before, same_piece, piece_before)

    return (
        pieces.withColumn("card_tx_count_1h", F.coalesce(in_window("n"), F.lit(0)))
        .withColumn("card_amount_sum_1h", in_window("spent"))
        .where("own")
        .select("card_id", "tx_unix", "card_tx_count_1h", "card_amount_sum_1h")
    )


def add_velocity(df: DataFrame, lookback: int = 3600) -> DataFrame:
    """Prior-hour count and amount per row.

    The join key is (card, second), and the right side is unique on it, so a busy
    card is spread over many keys and adaptive skew handling can split the rest. Rows
    without a second see each other, as in a range window; all those of a card share one
    key, so a card with many of them is cut into slices by their number.
    """
    if not _has(df, "card_id", "tx_unix", "amount", "transaction_id"):
        return df
    slices = F.broadcast(_untimed_slices(df))
    untimed = F.col("tx_unix").isNull() & F.col("card_id").eqNullSafe(F.col("untimed_card"))
    cut = F.coalesce("slices", F.lit(1))
    velocity = (
        card_velocity(df, lookback)
        .join(slices, untimed, "left")
        .select(
            F.col("card_id").alias("v_card"),
            F.col("tx_unix").alias("v_second"),
            "card_tx_count_1h",
            "card_amount_sum_1h",
            F.explode(F.sequence(F.lit(0), cut - 1)).alias("v_slice"),
        )
    )
    same = (
        F.col("card_id").eqNullSafe(F.col("v_card"))
        & F.col("tx_unix").eqNullSafe(F.col("v_second"))
        & (F.col("slice") == F.col("v_slice"))
    )
    sliced = df.join(slices, untimed, "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.pmod(F.xxhash64("transaction_id"), cut).cast("int").alias("slice"),
    )
    return sliced.join(velocity, same, "left").drop("v_card", "v_second", "v_slice", "slice")


def _untimed_slices(df: DataFrame) -> DataFrame:
    """``untimed_card, slices`` of cards with more rows without a time than half a task's share.

    Fewer than two cards for each task can have so many, which bounds the table.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = settled(
        df.where("tx_unix IS NULL").groupBy("card_id").agg(F.count(F.lit(1)).alias("n"))
    )
    share = F.col("n") * (2.0 * tasks) / counts.agg(F.sum("n")).scalar()
    return counts.where(share > 1).select(
        F.col("card_id").alias("untimed_card"), F.ceil(share).cast("int").alias("slices")
    )


def add_cardholder(df: DataFrame) -> DataFrame:
    added = {}
    if _has(df, "dob", "transaction_ts"):
        added["cardholder_age"] = X.age_in_years(F.col("dob"), F.col("transaction_ts"))
    if _has(df, "gender"):
        added["gender_encoded"] = X.male_flag(F.col("gender"))
    return df.withColumns(added) if added else df


def merchant_rates(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant").agg(
        F.avg("is_fraud").alias("merchant_fraud_rate"),
        F.count(F.lit(1)).alias("merchant_tx_count"),
    )


def add_merchant_rate(
    df: DataFrame, learned_from: DataFrame | None = None
) -> DataFrame:
    """Target encoding over the whole table, the current row included.

    Rows without a merchant match no rate and get NULL. ``learned_from`` holds the
    same rows as ``df`` at a cheaper point of its lineage.
    """
    if not _has(df, "merchant", "is_fraud"):
        return df
    rates = merchant_rates((learned_from or df).where(F.col("merchant").isNotNull()))
    return lookup_join(df, rates.drop("merchant_tx_count"), "merchant")


def category_index(df: DataFrame) -> DataFrame:
    """``category, category_encoded``: 0-based rank by frequency, ties by name."""
    counts = (
        df.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    ranked = number_rows(counts, "place", F.desc("uses"), F.asc("category"))
    return ranked.select("category", F.col("place").cast("double").alias("category_encoded"))


def add_category_index(df: DataFrame, learned_from: DataFrame | None = None) -> DataFrame:
    """Frequency index of ``category``; rows without one get the number of labels."""
    if not _has(df, "category"):
        return df
    index = settled(category_index(learned_from or df))
    labels = index.agg(F.count(F.lit(1)).cast("double")).scalar()
    joined = df.join(index, "category", "left").select(*df.columns, "category_encoded")
    return joined.withColumn("category_encoded", F.coalesce("category_encoded", labels))


def feature_table(transactions: DataFrame) -> DataFrame:
    """All features of the transactions, without the columns they replace.

    The encodings learn from the raw transactions: learning from the widened table
    would run the velocity join again just to count labels.
    """
    return (
        transactions.transform(add_temporal)
        .transform(add_amount_shape)
        .transform(add_amount_zscore)
        .transform(add_distance)
        .transform(add_epoch_seconds)
        .transform(add_velocity)
        .transform(add_cardholder)
        .transform(add_merchant_rate, transactions)
        .transform(add_category_index, transactions)
        .transform(select_features)
    )
