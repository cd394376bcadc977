"""Token ids in binary archives, each document compressed on its own with a shared dictionary.

An archive is a folder of three Parquet tables:

* ``blocks``: shard, block, ``dictionary`` (SHA-256 of the dictionary that the frames need),
  ``start`` (ids of the shard before the block), ``keys`` (document ids), ``counts`` (token ids
  of each document), ``offsets`` (where each document's frame begins in ``frames``, and the end
  of the last), and ``frames``: Zstandard frames of little-endian unsigned 32-bit ids, side by
  side. Blocks are some 256 KB; a longer document is a block of its own.
* ``shards``: shard, ``n_ids`` and ``start``, the ids of all shards before.
* ``dictionary``: the dictionary and its hash.

Shards are ranges of the document id and documents are sorted within, so the archive as a whole
is in ascending order: missing ids first, rows of one id in the order of a hash of their text.
A short document costs one frame to read, since the dictionary holds what a frame of its own is
too short to learn; the columns beside ``frames`` are the index that finds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from cardlens.llm.stretches import as_bytes, byte_level
from cardlens.llm.tables import map_batches, named, steps, text_of

#: Bytes of frames after which a block is closed, and the most documents of a block.
BLOCK_BYTES, BLOCK_DOCUMENTS = 1 << 18, 1024
#: Characters of texts that a task encodes at a time.
STEP_CHARS = 1 << 21
#: The dictionary's size, and what it is trained on: so many documents of at most so many
#: characters (the short ones are those that need it), the least by a hash of id and text.
DICTIONARY_BYTES, SAMPLE_DOCUMENTS, SAMPLE_CHARS = 1 << 15, 2000, 4000
LEVEL = 1


def serialized(path: str, texts: list[str], end_id: int | None) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers, ``end_id`` behind them."""
    tail = b"" if end_id is None else as_bytes([end_id])
    return [ids + tail for ids in byte_level(path, plain=False).encode(texts)]


def train_dictionary(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 0
) -> bytes:
    """A dictionary of at most ``DICTIONARY_BYTES``, trained in one task on a bounded sample.

    Samples too few or too small to train on are themselves the dictionary; without any there
    is none (no bytes). What is written can be read with whatever dictionary it was written.
    """
    rows = max(df.count(), 1)
    key = F.xxhash64(named(id_col), text_of(text_col))
    texts = df.select(key.alias("key"), text_of(text_col).alias("text"))
    # hashes below this bound hold more than enough rows, unless few texts are short
    few = F.col("key") < int(-(1 << 63) + (1 << 64) * min(8 * SAMPLE_DOCUMENTS / rows, 1)) - 1
    short = texts.where(few & F.char_length("text").between(1, SAMPLE_CHARS))
    sample = short.orderBy("key", "text").limit(SAMPLE_DOCUMENTS).coalesce(1)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for batch in batches for t in batch.column(0).to_pylist()]
        samples = serialized(vocabulary, texts, end_id) if texts else []
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except (zstandard.ZstdError, ValueError):
            made = b"".join(samples)[:DICTIONARY_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["data"])

    found = map_batches(sample.select("text"), train, "data binary").collect()
    return bytes(found[0].data) if found else b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    """Trained dictionaries begin with a magic number; others are plain content."""
    return zstandard.ZstdCompressionDict(data) if data else None


class Blocks:
    """Gathers the frames of one shard into rows of ``blocks``."""

    def __init__(self, shard: int, data: bytes, schema: pa.Schema) -> None:
        self.shard, self.schema = shard, schema
        self.hash = sha256(data).hexdigest()
        shared = _dictionary(data)
        if shared is not None:
            shared.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        self.block = self.start = 0
        self._clear()

    def _clear(self) -> None:
        self.keys: list = []
        self.counts: list[int] = []
        self.offsets = [0]
        self.frames: list[bytes] = []

    def add(self, key, ids: bytes) -> Iterator[pa.RecordBatch]:
        frame = self.compress(ids)
        if self.keys and self.offsets[-1] + len(frame) > BLOCK_BYTES:
            yield self.close()
        self.keys.append(key)
        self.counts.append(len(ids) // 4)
        self.offsets.append(self.offsets[-1] + len(frame))
        self.frames.append(frame)
        if len(self.keys) >= BLOCK_DOCUMENTS:
            yield self.close()

    def close(self) -> pa.RecordBatch:
        row = [
            self.shard,
            self.block,
            self.hash,
            self.start,
            self.keys,
            self.counts,
            self.offsets,
            b"".join(self.frames),
        ]
        arrays = [pa.array([v], f.type) for v, f in zip(row, self.schema)]
        self.block += 1
        self.start += sum(self.counts)
        self._clear()
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.names)


def write_ids(
    df: DataFrame,
    path: str,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 0,
) -> None:
    """Writes the token ids of every row of ``df`` into a new archive.

    ``vocabulary`` is a file of the ``tokenizers`` library that every executor has. A null text
    counts as empty: its document holds ``end_id`` alone, or nothing if that is None. Other
    columns don't matter. A table without rows gives an archive without blocks.
    """
    spark = df.sparkSession
    data = train_dictionary(df, vocabulary, id_col, text_col, end_id)
    rows = df.select(named(id_col).alias("key"), text_of(text_col).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType.fromDDL("shard int, block int, dictionary string, start long")
    schema.add(StructField("keys", ArrayType(rows.schema["key"].dataType)))
    for field in StructType.fromDDL("counts array<int>, offsets array<int>, frames binary"):
        schema.add(field)
    kinds = to_arrow_schema(schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(TaskContext.get().partitionId(), data, kinds)
        for batch in batches:
            keys, texts = (c.to_pylist() for c in batch.columns)
            for part in steps(texts, STEP_CHARS):
                for key, ids in zip(keys[part], serialized(vocabulary, texts[part], end_id)):
                    yield from blocks.add(key, ids)
        if blocks.keys:
            yield blocks.close()

    plain = {"compression": "none"}
    map_batches(ranges, write, schema).write.options(**plain).parquet(f"{path}/blocks")
    kept = spark.createDataFrame([(sha256(data).hexdigest(), data)], "hash string, data binary")
    kept.write.options(**plain).parquet(f"{path}/dictionary")
    blocks = spark.read.schema(schema).parquet(f"{path}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counted = F.aggregate("counts", F.lit(0).cast("long"), lambda n, c: n + c)
    shards = (  # a row for each task that wrote
        blocks.groupBy("shard")
        .agg(F.sum(counted).alias("n_ids"))
        .withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    )
    shards.write.parquet(f"{path}/shards")


def _decoded(rows: DataFrame, spark: SparkSession, path: str, key: StructField) -> DataFrame:
    """Documents at the places ``at`` (all if null) of blocks, from frames and dictionary."""
    kept = spark.read.schema("hash string, data binary").parquet(f"{path}/dictionary").first()
    known, data = kept.hash, bytes(kept.data)
    shards = spark.read.schema("shard int, n_ids long, start long").parquet(f"{path}/shards")
    rows = rows.join(shards.select("shard", F.col("start").alias("before")), "shard")
    schema = StructType([StructField("key", key.dataType)])
    for field in StructType.fromDDL("start long, n_tokens long, ids binary"):
        schema.add(field)
    kinds = to_arrow_schema(schema)
    columns = ["dictionary", "before", "start", "keys", "counts", "offsets", "frames", "at"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
        for batch in batches:
            for r in range(batch.num_rows):
                found = {c: batch.column(i)[r] for i, c in enumerate(columns)}
                if found["dictionary"].as_py() != known:
                    raise ValueError("these frames were written with another dictionary")
                counts = np.array(found["counts"].as_py(), "i8")
                begin = found["before"].as_py() + found["start"].as_py()
                starts = begin + np.concatenate([[0], np.cumsum(counts)])
                offsets, frames = found["offsets"].as_py(), found["frames"].as_buffer()
                wanted = found["at"].as_py()
                wanted = range(len(counts)) if wanted is None else sorted(wanted)
                ids = [
                    decompress(frames[offsets[p] : offsets[p + 1]], max_output_size=4 * int(counts[p]))
                    for p in wanted
                ]
                keys = found["keys"].values
                arrays = [
                    keys.take(pa.array(wanted, pa.int64())).cast(kinds.field("key").type),
                    pa.array([int(starts[p]) for p in wanted], pa.int64()),
                    pa.array([int(counts[p]) for p in wanted], pa.int64()),
                    pa.array(ids, kinds.field("ids").type),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=kinds.names)

    return map_batches(rows.select(columns), read, schema)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document of an archive: ``key, start, n_tokens, ids``.

    ``start`` counts the ids of all documents before; ``ids`` are the bytes as written.
    """
    blocks = _blocks(spark, path)
    key = StructField("key", blocks.schema["keys"].dataType.elementType)
    rows = blocks.withColumn("at", F.lit(None).cast("array<int>"))
    return _decoded(rows, spark, path, key)


def read_some(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The documents whose id is in the first column of ``wanted``, as :func:`read_ids` has them.

    The index columns find their places; of the blocks so found, only those frames are
    decompressed. A missing id finds the documents without one.
    """
    blocks = _blocks(spark, path)
    key = StructField("key", blocks.schema["keys"].dataType.elementType)
    places = blocks.select("shard", "block", F.posexplode("keys").alias("at", "key"))
    ids = wanted.select(named(wanted.columns[0]).alias("key")).distinct()
    hits = places.join(ids, places.key.eqNullSafe(ids.key), "left_semi")
    hits = hits.groupBy("shard", "block").agg(F.collect_list("at").alias("at"))  # within a block
    return _decoded(blocks.join(hits, ["shard", "block"]), spark, path, key)


def as_integers(ids: bytes) -> list[int]:
    """Token ids from their bytes."""
    return np.frombuffer(ids, "<u4").tolist()
