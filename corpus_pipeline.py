"""The corpus pipeline: documents in, token ids out.

Each stage works on all rows that the stage before has kept; its result is stored in the folder
that all executors share and read again. A lost executor costs the tasks it ran, not a stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import byte_bpe, decontamination, line_dedup, simhash, toxicity
from cardlens.llm.graphs import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by models of the labelled ones among them."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that one of a smaller id has; ``n_chars`` follows the text."""
    kept = line_dedup.keep_first_lines(docs)
    if "n_chars" not in kept.columns:
        return kept
    length = F.coalesce(F.char_length("text"), F.lit(0)).cast(kept.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", length)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of near duplicates."""
    return simhash.keep_one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_decode(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: SQL cannot state the language models, the hashes or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
