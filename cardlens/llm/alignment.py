"""Alignment of two tokenizers' tokens by the bytes that they cover.

Both tokenizations of a text cover the same bytes. A pair of tokens is linked where their byte
ranges overlap, and the text is cut where tokens of both end. The texts of a batch are merged in
lockstep: two NumPy vectors hold, for every text, the present token of A and of B; each step
links all present pairs at once, cuts where both end together, moves on whichever token ends
first, and drops the texts that are through. A long text enters as several lanes between places
where both tokenizations end, so the number of steps does not follow the longest text.

How many documents hold a pair of ids linked is counted over all rows. Ids travel as one number
for each pair, and a document's pairs once each with how often they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from cardlens.llm.skew import join_counted
from cardlens.llm.stretches import ByteLevel, Memory, Pieces
from cardlens.llm.tables import map_batches, named, steps, text_of
from cardlens.session import scratch_folder

#: Characters of texts that are merged together, or tokenized together (if they are several).
STEP_CHARS, ENCODE_CHARS = 1 << 21, 1 << 20
#: Tokens of A in a lane of a long text.
LANE = 512
#: Most stretches whose tokens a worker process remembers.
MOST_KEPT = 500_000
#: A pair of ids is ``a * ID_SPACE + b``.
ID_SPACE = 1 << 31


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links ``(i, j)`` and, for each token of A and of B, whether a group ends with it.

    ``ends_*`` are byte offsets at which the tokens of a whole batch end, ``starts_*`` the first
    token of each lane. Lanes begin and end where both tokenizations do.
    """
    stops = np.append(starts_a[1:], len(ends_a))
    i, j = starts_a.copy(), starts_b.copy()
    last_a, last_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    links_a, links_b = [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        a, b = ends_a[i], ends_b[j]
        cut = a == b
        last_a[i[cut]] = True
        last_b[j[cut]] = True
        i = i + (a <= b)
        j = j + (b <= a)
        going = i < stops
        if not going.all():
            i, j, stops = i[going], j[going], stops[going]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *links_a]), np.concatenate([none, *links_b]), last_a, last_b


def _lanes(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Starts of lanes in A and B: of every text, and each some ``LANE`` tokens within."""
    place = np.searchsorted(ends_b, ends_a)
    both = np.flatnonzero(ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a)
    inner = both[np.flatnonzero(np.diff(both // LANE, prepend=0))]
    inner = inner[inner + 1 < len(ends_a)]
    starts_a = np.union1d(first_a, inner + 1)
    before = np.searchsorted(ends_b, ends_a[starts_a - 1], side="right")
    return starts_a, np.where(starts_a == 0, 0, before)


class Aligner:
    """Both tokenizers and the texts of their ids, for one worker process."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a, plain=True), Pieces(path_b)
        # an id as text with what follows it: the next of its side, the other side, a new group
        self.written = [
            f"{i}{mark}" for tokens, turn in ((self.a.tokens, "|"), (self.b.tokens, ";"))
            for i in range(len(tokens)) for mark in (",", turn)
        ]
        self.memory = Memory(self.stretches, MOST_KEPT)

    def stretches(self, some: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of A and of B for stretches; None where either don't spell it byte by byte."""
        pairs = zip(self.a.stretches(some), self.b.stretches(some))
        return [None if a is None or b is None else (a, b) for a, b in pairs]

    def rows(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B for each text; none where the tokens don't spell the text."""
        none = np.zeros(0, np.int64)
        rows_a, rows_b = [none] * len(texts), [none] * len(texts)
        filled = [k for k, text in enumerate(texts) if text]
        spaced = [" " + texts[k] for k in filled]
        for part in steps(spaced, ENCODE_CHARS):
            if self.a.cuttable and self.b.cuttable:
                rows = self.memory.rows(spaced[part])
            else:
                rows = [self.stretches([text]) for text in spaced[part]]
            for k, row in zip(filled[part], map(list, rows)):
                if None not in row:
                    rows_a[k], rows_b[k] = (np.frombuffer(b"".join(x), "<u4") for x in zip(*row))
        return rows_a, rows_b

    def groups(self, a, b, last_a, last_b, first_a, first_b) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text, the ids of each group side by side."""
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        order = np.empty(len(a) + len(b), np.int64)
        upto_a, upto_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        # tokens of B in the groups before one's own; tokens of A up to one's own group
        before = np.concatenate([[0], upto_b])
        order[np.arange(len(a)) + before[group_a]] = a * 2 + last_a
        order[np.arange(len(b)) + upto_a[group_b]] = (len(self.a.sizes) + b) * 2 + last_b
        listed = list(map(self.written.__getitem__, order.tolist()))
        bounds = first_a + first_b
        return ["".join(listed[s:e])[:-1] for s, e in zip(bounds[:-1], bounds[1:])]

    def align(self, texts: list[str], with_tokens: bool) -> dict[str, object]:
        """A column of values for each field of :func:`align`."""
        rows_a, rows_b = self.rows(texts)
        first_a, first_b = (
            np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
            for rows in (rows_a, rows_b)
        )
        a, b = (np.concatenate(rows).astype(np.int64) for rows in (rows_a, rows_b))
        n = len(texts)
        if len(a):
            ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
            begins = first_a[:-1][np.diff(first_a) > 0]
            lanes = _lanes(ends_a, ends_b, begins)
            i, j, last_a, last_b = lockstep(ends_a, ends_b, *lanes)
        else:
            i = j = np.zeros(0, np.int64)
            last_a, last_b = np.zeros(0, bool), np.zeros(0, bool)
        text_of_a = np.repeat(np.arange(n), np.diff(first_a))
        linked = text_of_a[i]
        # owner and pair in one number, sorted: a text's links of the same ids side by side
        here, wide = len(self.b.sizes), len(self.a.sizes) * len(self.b.sizes)
        keys, times = np.unique(linked * wide + a[i] * here + b[j], return_counts=True)
        owner, pairs = keys // wide, keys % wide
        pairs = pairs // here * ID_SPACE + pairs % here
        spelt = self.groups(a, b, last_a, last_b, first_a, first_b)
        made = {
            "n_a": np.diff(first_a),
            "n_b": np.diff(first_b),
            "n_groups": np.bincount(text_of_a[last_a], minlength=n),
            "n_links": np.bincount(linked, minlength=n),
            "groups_sha256": [sha256(s.encode()).hexdigest() if s else "" for s in spelt],
            "pairs": _listed(owner, pairs, n),
            "times": _listed(owner, times, n),
        }
        if with_tokens:
            cuts = np.flatnonzero(last_a), np.flatnonzero(last_b)
            owner_b = np.repeat(np.arange(n), np.diff(first_b))
            made |= {
                "a_ids": _listed(text_of_a, a, n),
                "b_ids": _listed(owner_b, b, n),
                "a_ends": _listed(text_of_a[cuts[0]], cuts[0] + 1 - first_a[text_of_a[cuts[0]]], n),
                "b_ends": _listed(owner_b[cuts[1]], cuts[1] + 1 - first_b[owner_b[cuts[1]]], n),
            }
        return made


def _listed(owner: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    """Values as one list for each of ``n`` owners; owners ascend."""
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_FIELDS = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<int>"
)
_TOKENS = ", a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"


def align(
    df: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_tokens: bool = False,
) -> DataFrame:
    """Per row: a row number, the id, counts of tokens, groups and links, and the linked pairs.

    A is a byte-level vocabulary of the ``tokenizers`` library, given a space and the text; B
    one of the ``sentencepiece`` library, which adds the space. Special tokens in a text are
    plain text. ``pairs`` lists each pair of ids, ``a * ID_SPACE + b``, that is linked in the
    text, ``times`` how often. ``groups_sha256`` is the digest of ``a1,a2|b1;a3|b2,b3``.
    With ``with_tokens``, the ids themselves and the token counts at which each group ends.

    Texts that are null or empty, or that the tokens of either side don't spell byte by byte,
    have no tokens: counts of 0, empty lists and no digest (''). Rows that repeat an id are
    aligned one by one, hence the row number. No shuffle.
    """
    fields = StructType.fromDDL(_FIELDS + (_TOKENS if with_tokens else ""))
    rows = df.select(named(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = StructType.fromDDL("row long")
    schema.add(StructField("id", rows.schema["id"].dataType))
    for field in fields:
        schema.add(field)
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in steps(texts, STEP_CHARS):
                made = work.align(texts[part], with_tokens)
                n = part.stop - part.start
                arrays = [pa.array(np.arange(row, row + n)), batch.column(0).slice(part.start, n)]
                for kind in list(kinds)[2:]:
                    value = made[kind.name]
                    value = value if isinstance(value, pa.Array) else pa.array(value)
                    arrays.append(value.cast(kind.type))
                yield pa.RecordBatch.from_arrays(arrays, names=kinds.names)
                row += n

    return map_batches(rows, run, schema)


def weigh_links(aligned: DataFrame) -> DataFrame:
    """``aligned`` (stored rows of :func:`align`) with ``n_best`` and ``count_sum``.

    A pair's count is the number of rows that hold it linked. ``count_sum`` adds up the counts
    of a row's links; ``n_best`` are the links whose count is the highest of their id of A,
    ties included. Rows without links get zeros.
    """
    held = aligned.select("row", F.explode("pairs").alias("pair"))
    counts = _kept(held.groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    id_a = F.shiftright("pair", 31)
    highest = counts.groupBy(id_a.alias("a")).agg(F.max("n").alias("top"))
    # no more rows than A has ids
    graded = counts.withColumn("a", id_a).join(F.broadcast(highest), "a")
    graded = _kept(graded.select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "graded")
    links = aligned.select("row", F.posexplode("pairs").alias("at", "pair"), "times").select(
        "row", "pair", F.get("times", F.col("at")).cast("long").alias("times")
    )
    weighed = join_counted(links, graded, ["pair"], ["row", "pair"])
    sums = weighed.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    rows = aligned.drop("pairs", "times").join(sums, "row", "left")
    return rows.fillna(0, ["n_best", "count_sum"])


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder with strong compression, and read again."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def align_and_weigh(
    df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts, digest and weights of every row's links; what several steps read is stored."""
    aligned = _kept(align(df, path_a, path_b, id_col, text_col), "aligned")
    return weigh_links(aligned).drop("row").withColumnRenamed("id", id_col)
