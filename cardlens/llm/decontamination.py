"""Benchmark passages in training texts, by a stored positional inverted index.

The index is distributed by document: a row holds a block of whole documents, its distinct words
and the sorted positions of each. It is stored once, whatever is searched in it. A window of
benchmark words is looked up in each block from the word with the shortest list there; a window
with a word that has no postings is out at once. The other lists, in order of length, are
intersected at their offsets from the first. Texts and postings never move; what tasks get
besides is a part of the benchmark of bounded size, and a larger benchmark is taken part by part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from cardlens.llm.graphs import stored
from cardlens.llm.tables import STEP, WORD_BYTES, ascii_words, filter_texts, map_batches, named, text_of
from cardlens.plans.layout import under_settings
from cardlens.session import scratch_folder

#: Bytes of benchmark text that are sent to the tasks at a time.
PART_BYTES = 8 << 20
#: Bytes of training text in a block (a longer text on its own), and candidates probed at a time.
BLOCK_BYTES, PROBES = 2 << 20, 1 << 19
#: Blocks that a task reads at a time, and texts that one which packs blocks gets at a time.
BLOCKS_READ, TEXTS_READ = 4, 256
#: Bytes of a row group of the stored index: what a task holds of it, however much it writes or reads.
GROUP_BYTES = 16 << 20
#: Bytes of a text whose words are Python objects at a time.
RUN_BYTES = 1 << 20

_PLACE = np.int64(40)  # a posting is term << 40 | position


@dataclass(frozen=True)
class Passages:
    """Distinct windows of benchmark words as rows of term numbers, padded with -1."""

    terms: dict[bytes, int]
    windows: np.ndarray
    items: list[tuple[str, ...]]

    @classmethod
    def of(cls, rows: list[tuple[str, bytes]], window: int) -> Passages:
        terms: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in rows:
            numbers = [terms.setdefault(w, len(terms)) for w in ascii_words(text)]
            for begin in range(max(1, len(numbers) - window + 1) if numbers else 0):
                found.setdefault(tuple(numbers[begin : begin + window]), set()).add(item)
        windows = np.full((len(found), window), -1, np.int64)
        for row, numbers in enumerate(found):
            windows[row, : len(numbers)] = numbers
        return cls(terms, windows, [tuple(sorted(items)) for items in found.values()])


@dataclass(frozen=True)
class Block:
    """The positional index of some documents: positions count through all their words."""

    lengths: np.ndarray
    words: list[bytes]
    heads: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, documents: Iterable[Iterable[bytes]]) -> Block:
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        streams = [np.fromiter(map(numbers.__getitem__, words), np.int32) for words in documents]
        lengths = np.array([len(stream) for stream in streams], np.int64)
        stream = np.concatenate([np.zeros(0, np.int32), *streams])
        places = np.argsort(stream, kind="stable").astype(np.int32)
        counts = np.bincount(stream, minlength=len(numbers))
        return cls(lengths, list(numbers), np.concatenate([[0], np.cumsum(counts)]), places)

    def steps(self) -> np.ndarray:
        """The places as distances from the one before in the same list, which store small."""
        made = np.diff(self.places, prepend=np.int32(0))
        first = self.heads[:-1]
        made[first] = self.places[first]
        return made

    @classmethod
    def read(cls, lengths: list[int], words: bytes, heads: bytes, steps: bytes) -> Block:
        starts = np.frombuffer(heads, np.int64)
        made = np.frombuffer(steps, np.int32)
        reached = np.cumsum(made, dtype=np.int64)
        first = starts[:-1]
        base = np.repeat(reached[first] - made[first], np.diff(starts))
        places = (reached - base).astype(np.int32)
        return cls(np.array(lengths, np.int64), words.split(), starts, places)


class Search:
    """The postings of one block that the windows of some passages have."""

    def __init__(self, block: Block, passages: Passages, slop: int) -> None:
        gap = passages.windows.shape[1] + slop + 1  # no match runs over the end of a document
        ends = np.cumsum(block.lengths)
        self.lengths = block.lengths
        self.begins = ends - block.lengths + gap * np.arange(len(ends))
        self.end = int(ends[-1] if len(ends) else 0) + gap * len(ends)
        own = {word: i for i, word in enumerate(block.words)}
        both = [(t, own[word]) for word, t in passages.terms.items() if word in own]
        lists = [block.places[block.heads[i] : block.heads[i + 1]] for _, i in both]
        self.sizes = np.zeros(len(passages.terms), np.int64)
        self.postings = np.zeros(0, np.int64)
        if lists:
            terms = np.array([t for t, _ in both], np.int64)
            self.sizes[terms] = [len(x) for x in lists]
            places = np.concatenate(lists).astype(np.int64)
            places += gap * np.searchsorted(ends, places, side="right")
            self.postings = (np.repeat(terms, self.sizes[terms]) << _PLACE) | places
        self.heads = np.concatenate([[0], np.cumsum(self.sizes)])
        self.passages = passages

    def _near(self, terms: np.ndarray, places: np.ndarray, slop: int) -> np.ndarray:
        """Whether each term has a posting within ``slop`` of its place."""
        lowest = (terms << _PLACE) | np.maximum(places - slop, 0)
        at = np.searchsorted(self.postings, lowest)
        hit = self.postings[np.minimum(at, len(self.postings) - 1)]
        return (at < len(self.postings)) & (hit >= lowest) & (hit <= ((terms << _PLACE) | (places + slop)))

    def matches(self, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows, starts, and whether the phrase is exact; else every word is within
        ``slop`` of its place, seen from the window's rarest word."""
        windows = self.passages.windows
        if not len(self.postings) or not len(windows):
            return
        sizes = np.where(windows >= 0, self.sizes[windows], np.iinfo(np.int64).max)
        live = np.flatnonzero(sizes.min(axis=1) > 0)
        order = np.argsort(sizes[live], axis=1, kind="stable")
        rarest = windows[live, order[:, 0]]
        counts = self.sizes[rarest]
        ends = np.cumsum(counts)
        for begin in range(0, int(ends[-1]) if len(ends) else 0, PROBES):
            probes = np.arange(begin, min(begin + PROBES, int(ends[-1])))
            row = np.searchsorted(ends, probes, side="right")
            within = probes - (ends[row] - counts[row])
            posting = self.postings[self.heads[rarest[row]] + within]
            starts = (posting & ((np.int64(1) << _PLACE) - 1)) - order[row, 0]
            keep = starts >= 0
            row, starts = row[keep], starts[keep]
            for k in range(1, windows.shape[1]):
                offset = order[row, k]
                terms = windows[live[row], offset]
                keep = (terms < 0) | self._near(np.maximum(terms, 0), starts + offset, slop)
                row, starts = row[keep], starts[keep]
            exact = np.ones(len(row), bool)
            for k in range(windows.shape[1]):
                terms = windows[live[row], k]
                exact &= (terms < 0) | self._near(np.maximum(terms, 0), starts + k, 0)
            yield live[row], starts, exact

    def found(self, slop: int) -> list[dict[str, object]]:
        """A row for each document."""
        n = len(self.begins)
        edges = np.zeros(self.end + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(n)]
        near: list[set[str]] = [set() for _ in range(n)]
        sizes = (self.passages.windows >= 0).sum(axis=1)
        for windows, starts, exact in self.matches(slop):
            whole = starts[exact]
            np.add.at(edges, whole, 1)
            np.add.at(edges, whole + sizes[windows[exact]], -1)
            documents = np.searchsorted(self.begins, starts, side="right") - 1
            pairs = np.unique(np.stack([documents, windows, exact]), axis=1)
            for document, window, phrase in pairs.T.tolist():
                (items if phrase else near)[document].update(self.passages.items[window])
        hit = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        cuts = np.flatnonzero(np.diff(hit) != 1) + 1
        spans: list[list[dict[str, int]]] = [[] for _ in range(n)]
        for run in np.split(hit, cuts) if len(hit) else []:
            document = int(np.searchsorted(self.begins, run[0], side="right") - 1)
            begin = int(run[0] - self.begins[document])
            spans[document].append({"start": begin, "end": begin + len(run)})
        return [
            {
                "n_words": int(self.lengths[d]),
                "spans": spans[d],
                "items": sorted(items[d]),
                "near_items": sorted(near[d] - items[d]),
            }
            for d in range(n)
        ]


def words_of(text: bytes) -> Iterator[bytes]:
    """:func:`ascii_words`, of which a long text has few as Python objects at a time."""

    def runs() -> Iterator[list[bytes]]:
        plain = text.translate(WORD_BYTES)
        begin = 0
        while begin < len(plain):
            end = plain.find(b" ", begin + RUN_BYTES)
            end = len(plain) if end < 0 else end
            yield plain[begin:end].split()
            begin = end

    return chain.from_iterable(runs())


def blocks_of(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in runs of about ``BLOCK_BYTES``; a longer one alone."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if held and size + len(text) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def write_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Stores the positional index of all texts under ``path``, a row for each block."""
    rows = docs.select(named(id_col).alias("id"), text_of(text_col).cast("binary").alias("text"))
    ids = StructField("ids", ArrayType(rows.schema["id"].dataType))
    fields = StructType.fromDDL("lengths array<int>, words binary, heads binary, steps binary")
    schema = StructType([ids, *fields.fields])
    arrow = to_arrow_schema(schema)

    def packed(names: list, texts: list[bytes]) -> pa.RecordBatch:
        block = Block.of(map(words_of, texts))
        heads = block.heads.astype(np.int64).tobytes()
        row = (names, block.lengths.tolist(), b" ".join(block.words), heads, block.steps().tobytes())
        arrays = [pa.array([value], f.type) for value, f in zip(row, arrow)]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for begin in range(0, batch.num_rows, STEP):
                part = batch.slice(begin, STEP)
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if names and size + len(text) > BLOCK_BYTES:
                        yield packed(names, texts)
                        names, texts, size = [], [], 0
                    names.append(name)
                    texts.append(text)
                    size += len(text)
        if names:
            yield packed(names, texts)

    blocks = map_batches(rows, run, schema).withColumn("block", F.monotonically_increasing_id())
    few = at_a_time(TEXTS_READ)
    # a row is megabytes: the writer weighs what it holds after each, not after a hundred
    grouped = {
        "parquet.block.size": GROUP_BYTES,
        "parquet.page.size.row.check.min": 1,
        "parquet.page.size.row.check.max": 1,
    }
    under_settings(docs.sparkSession, few, lambda: blocks.write.options(**grouped).parquet(path))


def at_a_time(rows: int) -> dict[str, str]:
    """Settings under which a task takes so many rows at a time out of Parquet and to Python."""
    return {
        "spark.sql.parquet.columnarReaderBatchSize": str(rows),
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
    }


def passage_parts(
    benchmark: DataFrame, id_col: str, text_col: str, window: int, part_bytes: int
) -> Iterator[Passages]:
    """The benchmark in parts of about ``part_bytes``, none of which outlives its use here.

    Items are dealt to parts by a hash; at least one part comes, also without any item.
    """
    rows = benchmark.select(
        named(id_col).cast("string").alias("item"), text_of(text_col).cast("binary").alias("text")
    ).where(F.col("item").isNotNull())
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = size // part_bytes + 1
    for part in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part) if parts > 1 else rows
        yield Passages.of([(r.item, bytes(r.text)) for r in mine.collect()], window)


_FOUND = (
    "n_words long, spans array<struct<start:int,end:int>>, "
    "items array<string>, near_items array<string>"
)


def search_index(
    spark: SparkSession,
    path: str,
    benchmark: DataFrame,
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    slop: int = 2,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``block, place, id`` of every indexed text and what :func:`find_passages` says of it."""
    index = spark.read.parquet(path)
    ids = StructField("id", index.schema["ids"].dataType.elementType)
    fields = StructType.fromDDL("block long, place int")
    schema = StructType([*fields.fields, ids, *StructType.fromDDL(_FOUND).fields])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in arrow][3:]

    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    number, texts, *stored_block = (c[row].as_py() for c in batch.columns)
                    found = Search(Block.read(*stored_block), shared.value, slop).found(slop)
                    columns = [
                        [number] * len(texts), list(range(len(texts))), texts,
                        *([f[name] for f in found] for name in names),
                    ]
                    arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

        return run

    made = None
    # a row is megabytes: few of them at a time
    few = at_a_time(BLOCKS_READ)
    for number, passages in enumerate(
        passage_parts(benchmark, item_col, item_text_col, window, part_bytes)
    ):
        shared = spark.sparkContext.broadcast(passages)
        rows = index.select("block", "ids", "lengths", "words", "heads", "steps")
        found = map_batches(rows, run_with(shared), schema)
        if number:
            found = found.where((F.size("spans") > 0) | (F.size("near_items") > 0))
        found = under_settings(spark, few, lambda found=found: stored(found, "found"))
        made = found if made is None else made.unionByName(found)
        shared.unpersist()
    if number == 0:
        return made
    merged = made.groupBy("block", "place").agg(
        F.first("id").alias("id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near"),
    )
    touching = F.aggregate(
        F.col("spans"),
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.named_struct(
                        F.lit("start"),
                        F.try_element_at(done, F.lit(-1))["start"],
                        F.lit("end"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return merged.select(
        "block", "place", "id", "n_words", touching.alias("spans"), "items",
        F.array_except("near", "items").alias("near_items"),
    )


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    slop: int = 2,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Per row: ``n_words``, ``spans`` of words in exact passages (end exclusive), ``items``
    that they come from and ``near_items`` with proximity matches only.

    A passage is ``window`` consecutive words of an item, or all words of a shorter one. Items
    without words or without an id, and null texts, match nothing. Rows that repeat an id are
    searched one by one.
    """
    path = scratch_folder(docs.sparkSession, "index")
    write_index(docs, path, id_col, text_col)
    found = search_index(
        docs.sparkSession, path, benchmark, item_col, item_text_col, window, slop, part_bytes
    )
    return found.select(named("id").alias(id_col), "n_words", "spans", "items", "near_items")


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, all columns as they are.

    Blocks are indexed and searched where the rows are, so that no join has to find them again.
    """
    kept = docs
    for passages in passage_parts(benchmark, item_col, item_text_col, window, part_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(passages)

        def start(shared=shared):
            def work(texts: list[bytes]) -> list[bool]:
                clean: list[bool] = []
                for some in blocks_of(texts):
                    block = Block.of(map(words_of, some))
                    clean += [not row["spans"] for row in Search(block, shared.value, 0).found(0)]
                return clean

            return work

        kept = filter_texts(kept, text_col, start)
    return kept
