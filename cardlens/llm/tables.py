"""What the text operators share: whole texts in, one row per document out.

Conventions of every operator here: the id and text columns are named by the caller, other
columns of the input never matter, a null text counts as empty, a table without rows gives a
result without rows, and rows that repeat an id are handled one by one unless the operator
says otherwise.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Documents that a task holds as Python objects at a time.
STEP = 256

#: Bytes that words of :func:`ascii_words` consist of, after lower-casing A-Z; others separate.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 32
    for c in range(256)
)


def named(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A whole text; null counts as empty."""
    return F.coalesce(named(name).cast("string"), F.lit(""))


def text_key(name: str) -> Column:
    """128 bits of a text: with the id, it tells apart rows that repeat an id."""
    text = text_of(name)
    return F.struct(
        F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b")
    )


def ascii_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text, as bytes.

    Only A-Z are lower-cased. Bytes above 0x7F belong to words, so whole characters do.
    """
    return text.translate(WORD_BYTES).split()


def steps(texts: list[str], most: int) -> Iterator[slice]:
    """Slices of texts with about ``most`` characters, at least one text each."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_batches(df: DataFrame, run: Batches, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow``, with this package importable in the workers of a local master.

    A cluster gets the package by ``--py-files`` or has it installed.
    """
    context = df.sparkSession.sparkContext
    if not context.master.startswith("local-cluster") and context.master.startswith("local"):
        home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if home not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    return df.mapInArrow(run, schema)


def map_texts(
    df: DataFrame,
    id_col: str,
    text_col: str,
    start: Callable[[], Callable[[list], dict[str, list]]],
    fields: str,
    as_bytes: bool = True,
) -> DataFrame:
    """The id and ``fields`` (a DDL string) of every row, without a shuffle.

    ``start`` runs once in each task; the function that it returns gets some whole texts, as
    UTF-8 bytes or as strings, and returns a list for each field.
    """
    text = text_of(text_col)
    rows = df.select(
        named(id_col).alias("id"), (text.cast("binary") if as_bytes else text).alias("text")
    )
    added = StructType.fromDDL(fields)
    schema = StructType([StructField(id_col, rows.schema["id"].dataType), *added.fields])
    kinds = list(to_arrow_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for begin in range(0, batch.num_rows, STEP):
                part = batch.slice(begin, STEP)
                made = work(part.column(1).to_pylist())
                arrays = [pa.array(made[k.name], k.type) for k in kinds[1:]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *arrays], names=[k.name for k in kinds]
                )

    return map_batches(rows, run, schema)


def filter_texts(
    df: DataFrame,
    text_col: str,
    start: Callable[[], Callable[[list[bytes]], list[bool]]],
) -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text passes; no shuffle."""
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for begin in range(0, batch.num_rows, STEP):
                part = batch.slice(begin, STEP)
                texts = [(t or "").encode() for t in part.column(place).to_pylist()]
                yield part.filter(pa.array(work(texts), pa.bool_()))

    return map_batches(df, run, df.schema)
