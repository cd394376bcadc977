"""Registered queries: each operator on its whole table, with digests of the full results.

Where SQL can state the result on whole tables, its text stands with the query; the other
queries are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import (
    alignment,
    byte_bpe,
    conversations,
    decontamination,
    fingerprints,
    licenses,
    line_dedup,
    pii,
    simhash,
    token_counts,
    token_ids,
    toxicity,
    warc,
)
from cardlens.session import scratch_folder

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Registers a function under its own name."""

    def register(build: Build) -> Build:
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, folder, "documents"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
    WITH split AS (
      SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ), l AS (
      SELECT doc_id, i, lines[i] AS line FROM split, unnest(range(1, len(lines) + 1)) AS r(i)
    ), k AS (
      SELECT *, trim({_LOWER.format("line")},
        ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l
    ), f AS (
      SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) >= 2
    ), m AS (
      SELECT k.*, f.first IS NOT NULL AND k.doc_id <> f.first AS gone FROM k LEFT JOIN f USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """
)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages
    ), q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
    SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest,
      CASE WHEN size >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN size >= 1000 AND page_id < last THEN last END AS refers_to
    FROM q
    """
)
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.read_records(spark, path).select(
        F.col("page").cast("long").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query()
def op4_private_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_private(table(spark, folder, "documents"))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.PATTERNS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query()
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return byte_bpe.encode_decode(docs, VOCABULARY, public_tokenizers.PATTERN, with_ids=False)


@query()
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query()
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_counts.count_by_corpus(docs, VOCABULARY, public_tokenizers.PATTERN)


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.score(docs, labels)


@query()
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, folder, "documents"))
    listed = {c: F.concat_ws(",", c) for c in ("base_labels", "labels")}
    return found.withColumns(listed)


_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _words(column: str) -> str:
    return _WORDS.format(_LOWER.format(f"coalesce({column}, '')"))


@query(
    f"""
    WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
    b AS (
      SELECT CAST(item_id AS VARCHAR) AS item, {_words("text")} AS w FROM benchmark
    ), windows AS (
      SELECT DISTINCT item, least(10, len(w)) AS n,
        array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS phrase
      FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0
    ), sizes AS (SELECT DISTINCT n FROM windows),
    places AS (
      SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
      FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)
    ), found AS (SELECT doc_id, i, places.n, item FROM places JOIN windows USING (phrase, n)),
    hits AS (
      SELECT doc_id, count(DISTINCT i + j) AS n_hit
      FROM found, unnest(range(0, n)) AS r(j) GROUP BY doc_id
    ), items AS (
      SELECT doc_id, count(DISTINCT item) AS n_items,
        array_to_string(list_sort(list(DISTINCT item)), ',') AS items
      FROM found GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """
)
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_passages(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query()
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return alignment.align_and_weigh(docs, BYTE_LEVEL, PIECES)


@query()
def op12_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "token_ids")
    token_ids.write_ids(table(spark, folder, "documents"), path, BYTE_LEVEL)
    return token_ids.read_ids(spark, path).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query()
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    found = conversations.repair(conversations.damage(turns), "conv")
    known = turns.select("conv_id").distinct()
    joined = known.join(found, known.conv_id.eqNullSafe(found.conv), "left")
    nothing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return joined.select(
        "conv_id",
        *[F.coalesce(c, nothing.get(c, F.lit(0))).alias(c) for c in found.columns if c != "conv"],
    )
