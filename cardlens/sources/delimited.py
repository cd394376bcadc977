"""CSV sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The 24 fields of the published transaction CSV, in file order.
RAW_SCHEMA = """
    `Unnamed: 0` BIGINT,
    trans_date_trans_time STRING,
    cc_num STRING,
    merchant STRING,
    category STRING,
    amt DOUBLE,
    first STRING,
    last STRING,
    gender STRING,
    street STRING,
    city STRING,
    state STRING,
    zip STRING,
    lat DOUBLE,
    long DOUBLE,
    city_pop BIGINT,
    job STRING,
    dob STRING,
    trans_num STRING,
    unix_time BIGINT,
    merch_lat DOUBLE,
    merch_long DOUBLE,
    is_fraud INT,
    merch_zipcode STRING
"""


def _reader(spark: SparkSession) -> DataFrameReader:
    # With pruning on, a row is malformed only if its *requested* columns are, so
    # count() and collect() would disagree on how many rows a file has.
    return (
        spark.read.option("header", True)
        .option("mode", "DROPMALFORMED")
        .option("multiLine", False)
        .option("columnPruning", False)
    )


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with every column as text; malformed rows are dropped."""
    return _reader(spark).csv(path)


def read_typed_csv(spark: SparkSession, path: str, schema: str = RAW_SCHEMA) -> DataFrame:
    """Headered CSV with a declared schema and without the exporter's row number."""
    return _typed(_reader(spark), path, schema)


def read_csv_folder(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """All ``*.csv`` files of a folder as one table; other files are ignored."""
    reader = _reader(spark).option("pathGlobFilter", "*.csv")
    return reader.csv(folder) if schema is None else _typed(reader, folder, schema)


def _typed(reader: DataFrameReader, path: str, schema: str) -> DataFrame:
    """Reads text and casts it, dropping rows with a value that is not of its type.

    The filter names every typed column, so a row is dropped whichever columns a query
    asks for. A typed reader checks only the columns it is asked for.
    """
    declared = StructType.fromDDL(schema)
    text = StructType([StructField(f.name, StringType()) for f in declared])
    rows = reader.schema(text).csv(path)
    for field in declared:
        if field.dataType != StringType():
            raw = F.col(f"`{field.name}`")
            rows = rows.where(raw.isNull() | raw.try_cast(field.dataType).isNotNull())
    return rows.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in declared]
    ).drop("Unnamed: 0")


@dataclass(frozen=True)
class Intake:
    """What became of the rows of a CSV source: both tables are stored, the counts observed."""

    kept: DataFrame
    rejected: DataFrame
    rows_kept: int
    rows_rejected: int


def check_rows(
    spark: SparkSession, path: str, schema: str | None = None, header: bool = True
) -> DataFrame:
    """All rows of a CSV source, with ``parsed``, ``reason`` and ``line``.

    A row that fits has its values and is ``parsed``. Any other has NULLs, the text of its
    ``line`` and a ``reason``: ``number of fields``, or the columns (comma-joined) with a value
    that is not of its type. Without a schema the first file's header names columns of text.
    """
    reader = spark.read.option("header", header).option("multiLine", False)
    declared = reader.csv(path).schema if schema is None else StructType.fromDDL(schema)
    text = StructType([StructField(f.name, StringType()) for f in declared])
    broken = "corrupt line"
    rows = (
        reader.option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", broken)
        .schema(StructType([*text, StructField(broken, StringType())]))
        .csv(path)
    )
    raw = {f.name: F.col(f"`{f.name}`") for f in declared}
    wrong = [
        F.when(raw[f.name].isNotNull() & raw[f.name].try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in declared
        if f.dataType != StringType()
    ]
    named = F.concat_ws(",", *wrong) if wrong else F.lit("")
    reason = (
        F.when(F.col(f"`{broken}`").isNotNull(), F.lit("number of fields"))
        .when(named != "", named)
    )
    line = F.coalesce(f"`{broken}`", F.to_csv(F.struct(*raw.values())))
    judged = rows.withColumns({"reason": reason, "line": line})
    parsed = F.col("reason").isNull()
    return judged.select(
        *[F.when(parsed, c.try_cast(declared[n].dataType)).alias(n) for n, c in raw.items()],
        parsed.alias("parsed"),
        "reason",
        F.when(~parsed, F.col("line")).alias("line"),
    )


def quarantine(
    spark: SparkSession, path: str, target: str, schema: str | None = None, header: bool = True
) -> Intake:
    """Stores the rows of a CSV source that fit, and apart from them those that don't.

    One pass writes both, as the two partitions of a table at ``target``, and counts them while
    writing. Rejected rows keep their line and the reason, so nothing is lost and a corrected
    line can be read again.
    """
    checked = check_rows(spark, path, schema, header)
    seen = Observation("intake")
    counted = checked.observe(
        seen,
        F.count_if("parsed").alias("kept"),
        F.count_if(~F.col("parsed")).alias("rejected"),
    )
    counted.write.mode("overwrite").partitionBy("parsed").parquet(target)
    stored = spark.read.schema(checked.schema).parquet(target)
    values = [c for c in checked.columns if c not in ("parsed", "reason", "line")]
    counts = seen.get
    return Intake(
        kept=stored.where("parsed").select(*[F.col(f"`{c}`") for c in values]),
        rejected=stored.where("NOT parsed").select("reason", "line"),
        rows_kept=counts["kept"],
        rows_rejected=counts["rejected"],
    )
