"""Sources, sinks, jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.catalog.registry import query, rounded
from cardlens.catalog.sql import on_orders, on_raw, on_tx
from cardlens.jobs import prepare as prepare_job
from cardlens.session import scratch_folder
from cardlens.sources import columnar, delimited
from cardlens.sources.star import order_lines, transactions

RAW_FIELDS = (
    "trans_date_trans_time, cc_num, merchant, category, amt, first, last, gender, street, city, "
    "state, zip, lat, long, city_pop, job, dob, trans_num, unix_time, merch_lat, merch_long, "
    "is_fraud, merch_zipcode"
)


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions under the headers of the published CSV."""
    tx = transactions(spark, folder)
    card = F.col("card_id")
    return tx.select(
        F.col("transaction_id").cast("bigint").alias("Unnamed: 0"),
        F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss").alias("trans_date_trans_time"),
        card.alias("cc_num"),
        "merchant",
        "category",
        F.col("amount").alias("amt"),
        F.concat(F.lit("first"), card).alias("first"),
        F.concat(F.lit("last"), card).alias("last"),
        "gender",
        F.concat(card, F.lit(" Main St")).alias("street"),
        F.concat(F.lit("city of "), "state").alias("city"),
        "state",
        F.concat(F.lit("0"), card).alias("zip"),
        "lat",
        "long",
        "city_pop",
        F.concat(F.lit("job"), card).alias("job"),
        "dob",
        F.col("transaction_id").alias("trans_num"),
        "unix_time",
        "merch_lat",
        "merch_long",
        "is_fraud",
        "merch_zipcode",
    )


def raw_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "raw")
    raw_transactions(spark, folder).write.option("header", True).csv(path)
    return path


@query(
    "src_01_text_csv",
    on_raw(
        "SELECT trans_num, trans_date_trans_time, cc_num, zip, merch_zipcode, dob, amt, "
        "CAST(is_fraud AS INT) AS is_fraud FROM raw"
    ),
)
def text_csv(spark, folder):
    read = delimited.read_text_csv(spark, raw_csv(spark, folder))
    return read.select(
        "trans_num",
        "trans_date_trans_time",
        "cc_num",
        "zip",
        "merch_zipcode",
        "dob",
        F.col("amt").cast("double"),
        F.col("is_fraud").cast("int"),
    )


def _faulty_csv(spark: SparkSession, folder: str) -> str:
    """The published CSV without a header line, with lines cut short, too long or mistyped."""
    raw = raw_transactions(spark, folder)
    fault = F.col("Unnamed: 0") % 50
    amount = F.when(fault == 2, F.lit("n/a")).otherwise(F.col("amt").cast("string"))
    label = F.when((fault == 2) | (fault == 3), F.lit("maybe")).otherwise(F.col("is_fraud").cast("string"))
    changed = raw.withColumns({"amt": amount, "is_fraud": label})
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in raw.columns]))
    broken = (
        F.when(fault == 0, F.substring_index(line, ",", 5))
        .when(fault == 1, F.concat(line, F.lit(",extra")))
        .otherwise(line)
    )
    path = scratch_folder(spark, "faulty")
    changed.select(broken.alias("value")).write.text(path)
    return path


@query(
    "src_01_quarantine",
    on_raw(
        """, judged AS (
  SELECT *, CASE row_number % 50 WHEN 0 THEN 'number of fields' WHEN 1 THEN 'number of fields'
            WHEN 2 THEN 'amt,is_fraud' WHEN 3 THEN 'is_fraud' END AS reason FROM raw)
SELECT reason, CAST(count(*) AS BIGINT) AS n, CAST(sum(row_number) AS BIGINT) AS numbers,
       CAST(sum(count(*) FILTER (reason IS NULL)) OVER () AS BIGINT) AS rows_kept,
       CAST(sum(count(*) FILTER (reason IS NOT NULL)) OVER () AS BIGINT) AS rows_rejected
FROM judged GROUP BY reason"""
    ),
)
def quarantined(spark, folder):
    """Rows that fit and rows that don't, by reason, with the counts observed while storing."""
    intake = delimited.quarantine(
        spark, _faulty_csv(spark, folder), scratch_folder(spark, "intake"), delimited.RAW_SCHEMA, header=False
    )
    kept = intake.kept.select(F.lit(None).cast("string").alias("reason"), F.col("`Unnamed: 0`").alias("number"))
    rejected = intake.rejected.select(
        "reason", F.substring_index("line", ",", 1).cast("bigint").alias("number")
    )
    return (
        kept.union(rejected)
        .groupBy("reason")
        .agg(F.count("*").alias("n"), F.sum("number").alias("numbers"))
        .withColumns({"rows_kept": F.lit(intake.rows_kept).cast("bigint"), "rows_rejected": F.lit(intake.rows_rejected).cast("bigint")})
    )


@query("src_01_kept_rows", on_raw(f"SELECT {RAW_FIELDS} FROM raw WHERE row_number % 50 > 3"))
def kept_rows(spark, folder):
    """The rows of the faulty file that fit, with their types."""
    intake = delimited.quarantine(
        spark, _faulty_csv(spark, folder), scratch_folder(spark, "intake"), delimited.RAW_SCHEMA, header=False
    )
    return intake.kept.drop("Unnamed: 0")


@query("src_02_typed_csv", on_raw(f"SELECT {RAW_FIELDS} FROM raw"))
def typed_csv(spark, folder):
    return delimited.read_typed_csv(spark, raw_csv(spark, folder))


@query(
    "src_03_csv_folder",
    on_raw(
        "SELECT category, CAST(2 * count(*) AS BIGINT) AS n, round(2 * sum(amt), 2) AS total "
        "FROM raw GROUP BY category"
    ),
)
def csv_folder(spark, folder):
    """Two exports in one folder next to files that are not CSV."""
    path = raw_csv(spark, folder)
    raw = raw_transactions(spark, folder)
    raw.write.mode("append").option("header", True).csv(path)
    raw.select("trans_num").write.mode("append").parquet(path)
    read = delimited.read_csv_folder(spark, path, delimited.RAW_SCHEMA)
    return rounded(
        read.groupBy("category").agg(F.count("*").alias("n"), F.sum("amt").alias("total")), 2
    )


@query("src_04_parquet", "SELECT * FROM events")
def parquet(spark, folder):
    return columnar.read_parquet(spark, f"{folder}/events.parquet")


@query(
    "src_05_restored_amount",
    on_tx("SELECT transaction_id, round(amount, 6) AS amount FROM tx"),
)
def restored_amount(spark, folder):
    stored = transactions(spark, folder).select(
        "transaction_id", F.log1p("amount").alias("amount_log1p")
    )
    return rounded(columnar.restore_amount(stored).drop("amount_log1p"))


@query(
    "snk_01_write_modes",
    on_tx(
        "SELECT category, CAST(2 * count(*) AS BIGINT) AS stored_rows FROM tx GROUP BY category"
    ),
)
def write_modes(spark, folder):
    """Overwrite, append once more, then an ignored write."""
    path = scratch_folder(spark, "modes")
    tx = transactions(spark, folder).select("transaction_id", "category", "amount")
    for mode in ("overwrite", "append", "ignore"):
        columnar.write_parquet(tx, path, mode)
    stored = columnar.read_parquet(spark, path)
    return stored.groupBy("category").agg(F.count("*").alias("stored_rows"))


@query(
    "snk_02_round_trip",
    on_tx(
        "SELECT CAST(count(*) AS BIGINT) AS rows_written, CAST(count(*) AS BIGINT) AS rows_stored, "
        "CAST(17 AS INT) AS columns_written, CAST(17 AS INT) AS columns_stored, "
        "true AS matches FROM tx"
    ),
)
def round_trip(spark, folder):
    path = scratch_folder(spark, "round_trip")
    tx = transactions(spark, folder)
    columnar.write_parquet(tx, path)
    return columnar.round_trip_report(tx, path)


_COLUMN_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS values_written FROM tx"
    for c in (
        "transaction_id, transaction_ts, card_id, merchant, amount, is_fraud, category, gender, state, "
        "lat, long, merch_lat, merch_long, city_pop, dob, unix_time, merch_zipcode"
    ).split(", ")
) + f" UNION ALL SELECT '{columnar.WHOLE_ROW}', CAST(count(*) AS BIGINT) FROM tx"


@query(
    "snk_02_verified_write",
    on_tx(f"SELECT *, values_written AS values_stored, true AS matches FROM ({_COLUMN_COUNTS})"),
)
def verified_write(spark, folder):
    return columnar.write_verified(transactions(spark, folder), scratch_folder(spark, "verified"))


@query(
    "snk_02_changed_cell",
    on_tx(
        "SELECT *, values_written AS values_stored, "
        f"column_name NOT IN ('amount', '{columnar.WHOLE_ROW}') AS matches FROM ({_COLUMN_COUNTS})"
    ),
)
def changed_cell(spark, folder):
    """A table in which one amount differs by a cent from what was written."""
    tx = transactions(spark, folder)
    first = tx.agg(F.min(F.col("transaction_id").cast("bigint"))).scalar()
    other = F.when(F.col("transaction_id").cast("bigint") == first, F.col("amount") + 0.01)
    path = scratch_folder(spark, "changed")
    columnar.write_parquet(tx.withColumn("amount", F.coalesce(other, "amount")), path)
    digests = tx.agg(*[c.alias(n) for n, c in columnar.content_digests(tx).items()])
    return columnar.compare_content(spark, digests.first().asDict(), tx.columns, path)


@query(
    "job_01_prepare",
    on_orders(
        """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_ts, card_id,
         merchant, amount, is_fraud, category, state) AS place
  FROM tx_orders WHERE amount >= 0 AND is_fraud IN (0, 1))
SELECT transaction_id, strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') AS transaction_ts, card_id,
       merchant, amount, CAST(is_fraud AS INT) AS is_fraud, category, state,
       CAST(count(*) OVER () AS BIGINT) AS rows_reported
FROM ranked WHERE place = 1"""
    ),
)
def prepare_csv(spark, folder):
    """The prepare job from CSV to Parquet, over rows with repeated ids."""
    target = scratch_folder(spark, "prepared")
    rows = prepare_job.run(spark, _order_csv(spark, order_lines(spark, folder)), target)
    return (
        columnar.read_parquet(spark, target)
        .withColumn("transaction_ts", F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss"))
        .withColumn("rows_reported", F.lit(rows).cast("bigint"))
    )


def _order_csv(spark: SparkSession, lines: DataFrame) -> str:
    """Order lines as CSV under other headers."""
    source = scratch_folder(spark, "orders_csv")
    lines.select(
        F.col("transaction_id").alias("Trans Num"),
        F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss").alias("trans_date_trans_time"),
        F.col("card_id").alias("CC-Num"),
        F.col("merchant").alias("merchant_name"),
        F.col("amount").alias("Amt"),
        F.col("is_fraud").alias("class"),
        "category",
        "state",
    ).write.option("header", True).csv(source)
    return source


_PREPARED = """, valid AS (SELECT * FROM tx_orders WHERE amount >= 0 AND is_fraud IN (0, 1)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_ts, card_id,
         merchant, amount, is_fraud, category, state) AS place FROM valid),
prepared AS (SELECT * FROM ranked WHERE place = 1)
"""


@query(
    "job_01_audit",
    on_orders(
        _PREPARED
        + """SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) FILTER (amount IS NULL) AS BIGINT) AS null_amount,
       CAST(count(*) FILTER (amount <= 0) AS BIGINT) AS non_positive_amount,
       CAST(count(*) FILTER (amount > 1000) AS BIGINT) AS high_amount,
       CAST(count(*) FILTER (is_fraud = 1) AS BIGINT) AS fraud_count,
       round(count(*) FILTER (amount > 1000) * 100.0 / count(*), 6) AS high_pct,
       round(count(*) FILTER (is_fraud = 1) * 100.0 / count(*), 6) AS fraud_pct FROM prepared"""
    ),
)
def prepare_audit(spark, folder):
    """The audit that the prepare job observes while it writes."""
    source = _order_csv(spark, order_lines(spark, folder))
    return rounded(prepare_job.run_audited(spark, source, scratch_folder(spark, "prepared")).audit(spark))


@query(
    "job_01_append_new",
    on_orders(
        _PREPARED
        + """SELECT category, CAST(count(*) AS BIGINT) AS n, round(sum(amount), 2) AS total,
       CAST((SELECT count(*) FROM prepared WHERE CAST(split_part(transaction_id, '-', 1) AS BIGINT) % 3 = 0) AS BIGINT) AS first_run,
       CAST((SELECT count(*) FROM prepared WHERE CAST(split_part(transaction_id, '-', 1) AS BIGINT) % 3 <> 0) AS BIGINT) AS second_run,
       CAST(0 AS BIGINT) AS third_run
FROM prepared GROUP BY category"""
    ),
)
def append_new(spark, folder):
    """A part of the orders is appended, then all of them, then all of them again."""
    lines, target = order_lines(spark, folder), scratch_folder(spark, "appended")
    everything = _order_csv(spark, lines)
    part = lines.where(F.substring_index("transaction_id", "-", 1).cast("bigint") % 3 == 0)
    rows = [
        prepare_job.run(spark, source, target, prepare_job.APPEND_NEW)
        for source in (_order_csv(spark, part), everything, everything)
    ]
    stored = columnar.read_parquet(spark, target)
    totals = stored.groupBy("category").agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    names = ("first_run", "second_run", "third_run")
    return rounded(totals, 2).withColumns({n: F.lit(r).cast("bigint") for n, r in zip(names, rows)})


@query(
    "job_02_session_time_zone",
    on_tx(
        "SELECT '+00:00' AS utc_offset, strftime(min(transaction_ts), '%Y-%m-%d %H:%M:%S') AS first_ts, "
        "strftime(max(transaction_ts), '%Y-%m-%d %H:%M:%S') AS last_ts FROM tx"
    ),
)
def session_time_zone(spark, folder):
    """Instants keep their wall clock under the session's UTC time zone."""
    at = F.col("transaction_ts").cast("timestamp")
    return transactions(spark, folder).agg(
        F.date_format(F.max(at), "xxx").alias("utc_offset"),
        F.date_format(F.min(at), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
        F.date_format(F.max(at), "yyyy-MM-dd HH:mm:ss").alias("last_ts"),
    )
