"""Transaction tables derived from a star schema of parquet files.

``transactions`` maps an event stream onto card transactions (time of day, geography,
birth dates, missing values); ``order_lines`` maps orders and their lines (many months,
repeated ids). Small dimensions carry no broadcast hint: their file sizes are known to
Spark, which broadcasts them below its threshold and shuffles them above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _homes(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    homes = _homes(spark, folder)

    event, user, home = F.col("event_id"), F.col("user_id"), F.col("n_nationkey")
    home_lat = (home + 25).cast("double")
    home_long = (home * 2 - 125).cast("double")
    far = F.when(event % 13 == 0, F.lit(4.0)).otherwise(F.lit(0.0))
    born = F.make_date(
        (F.lit(1940) + (user * 7) % 66).cast("int"),
        (F.lit(1) + user % 12).cast("int"),
        (F.lit(1) + user % 28).cast("int"),
    )
    return (
        events.join(homes, F.col("c_custkey") == user)
        .select(
            event.cast("string").alias("transaction_id"),
            F.col("ts").alias("transaction_ts"),
            user.cast("string").alias("card_id"),
            F.concat(F.lit("fraud_m"), F.regexp_extract("props", "([0-9]+)", 1)).alias("merchant"),
            F.col("value").alias("amount"),
            ((F.col("value") > 200) | (event % 97 == 0)).cast("int").alias("is_fraud"),
            F.col("event_type").alias("category"),
            F.when(user % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("n_name").alias("state"),
            home_lat.alias("lat"),
            home_long.alias("long"),
            (home_lat + (event % 21 - 10).cast("double") / 10.0 + far).alias("merch_lat"),
            F.when(event % 101 != 0, home_long + (event % 17 - 8).cast("double") / 10.0).alias(
                "merch_long"
            ),
            (F.lit(1000) + (user * 7919) % 900000).cast("bigint").alias("city_pop"),
            F.when(user % 29 != 0, born.cast("string")).alias("dob"),
            (F.lit(1704067200) + event).cast("bigint").alias("unix_time"),
            F.when(event % 7 != 0, (F.lit(10000) + event % 89999).cast("string")).alias(
                "merch_zipcode"
            ),
        )
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Orders meet their customers before the lines join: beyond the broadcast threshold
    # that shuffles the orders by customer instead of all order lines.
    placed = orders.join(_homes(spark, folder), F.col("c_custkey") == F.col("o_custkey"))
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    part = table(spark, folder, "part").select("p_partkey", "p_type")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.085)
    return (
        lines.join(placed, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(part, F.col("p_partkey") == F.col("l_partkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
            F.col("o_orderdate").alias("transaction_ts"),
            F.col("o_custkey").cast("string").alias("card_id"),
            F.col("s_name").alias("merchant"),
            F.col("l_extendedprice").alias("amount"),
            F.coalesce(returned, F.lit(False)).cast("int").alias("is_fraud"),
            F.col("p_type").alias("category"),
            F.col("n_name").alias("state"),
        )
    )
