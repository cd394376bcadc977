"""Parquet source and sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WRITE_MODES = ("overwrite", "append", "error", "ignore")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``, in whatever file system it names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def restore_amount(df: DataFrame) -> DataFrame:
    """Adds ``amount`` to a table that stores only its logarithm."""
    if "amount" in df.columns or "amount_log1p" not in df.columns:
        return df
    return df.withColumn("amount", F.expm1("amount_log1p"))


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()
) -> None:
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {', '.join(WRITE_MODES)}, not {mode!r}")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def round_trip_report(written: DataFrame, path: str) -> DataFrame:
    """One row comparing the rows and columns of ``written`` with what ``path`` holds."""
    stored = read_parquet(written.sparkSession, path)
    rows_stored = stored.agg(F.count(F.lit(1))).scalar()
    return written.agg(F.count(F.lit(1)).alias("rows_written")).select(
        "rows_written",
        rows_stored.alias("rows_stored"),
        F.lit(len(written.columns)).alias("columns_written"),
        F.lit(len(stored.columns)).alias("columns_stored"),
        (
            (F.col("rows_written") == rows_stored)
            & F.lit(sorted(written.columns) == sorted(stored.columns))
        ).alias("matches"),
    )


#: A row of all columns together, among the digests of single columns.
WHOLE_ROW = "(row)"


def content_digests(df: DataFrame) -> dict[str, Column]:
    """Count, sum and exclusive or of the hashes of each column's values and of whole rows.

    Neither depends on the order of rows. Equal values that stand twice cancel out in the
    exclusive or, but not in the sum; the row's digest notices values that changed places.
    """
    named = {c: F.col(f"`{c}`") for c in df.columns}
    hashes = {c: F.when(v.isNotNull(), F.xxhash64(v)) for c, v in named.items()}
    # a null leaves a hash as it is, so the row also hashes where its nulls are
    hashes[WHOLE_ROW] = F.xxhash64(*named.values(), *[v.isNull() for v in named.values()])
    found = {}
    for i, value in enumerate(hashes.values()):
        found[f"n{i}"] = F.count(value)
        found[f"s{i}"] = F.sum(value.cast("decimal(20,0)")).cast("string")
        found[f"x{i}"] = F.bit_xor(value)
    return found


def write_verified(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Writes ``df`` and compares what is stored then with what went in.

    ``column_name, values_written, values_stored, matches`` for each column and for whole rows.
    The digests of what is written are observed during the write; only the stored table is read
    again. Modes are those that leave nothing but ``df`` at the path.
    """
    if mode not in ("overwrite", "error"):
        raise ValueError("only a write that replaces or creates the table can be verified")
    seen = Observation("digests")
    observed = df.observe(seen, *[c.alias(n) for n, c in content_digests(df).items()])
    write_parquet(observed, path, mode)
    return compare_content(df.sparkSession, seen.get, df.columns, path)


def compare_content(
    spark: SparkSession, written: dict, columns: list[str], path: str
) -> DataFrame:
    """The digests ``written`` of ``columns`` against those of the table at ``path``."""
    table = read_parquet(spark, path)
    stored = {}
    if sorted(table.columns) == sorted(columns):
        table = table.select(*[f"`{c}`" for c in columns])
        stored = table.agg(*[c.alias(n) for n, c in content_digests(table).items()]).first().asDict()
    lines = []
    for i, name in enumerate([*columns, WHOLE_ROW]):
        same = bool(stored) and all(stored[f"{k}{i}"] == written[f"{k}{i}"] for k in "nsx")
        lines.append((name, written[f"n{i}"], stored.get(f"n{i}"), same))
    return spark.createDataFrame(
        lines, "column_name string, values_written long, values_stored long, matches boolean"
    )


#: Bits of the filter that stored keys pass: 4096 bitmaps of 32,768 bits, 16 MB.
FILTER_BITS = 1 << 27


def new_rows(incoming: DataFrame, stored: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``incoming`` whose ``key`` no row of ``stored`` has; missing keys are equal.

    The incoming keys make a Bloom filter of ``bits`` bits with one hash, built as bitmaps by
    Spark's bitmap aggregates. Its size is fixed, so every task gets it, and of the stored keys
    only those that it lets through are shuffled: a small batch does not move a large table.
    A filter that a large batch has filled lets more keys through and drops none.

    The rows meet the stored keys by plain equality, so that ``incoming`` that is already dealt
    by its key, as after deduplication, is not shuffled again; a missing key is looked up once.
    """

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits)) + 1

    marks = incoming.select(place(key).alias("place"))
    bitmaps = marks.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")
    )
    at = F.bitmap_bit_position("place")
    byte = F.conv(F.hex(F.substring("bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    keys = stored.select(F.col(key).alias("stored_key"), place(key).alias("place"))
    maybe = keys.withColumn("bucket", F.bitmap_bucket_number("place")).join(
        F.broadcast(bitmaps), "bucket"
    )
    held = maybe.where(F.getbit(byte, (at % 8).cast("int")) == 1).select("stored_key").distinct()
    fresh = incoming.join(held, F.col(key) == F.col("stored_key"), "left_anti")
    lacking = stored.where(F.col(key).isNull()).agg(F.count(F.lit(1))).scalar()
    return fresh.where(F.col(key).isNotNull() | (lacking == 0))
