"""Lines that an earlier document has, as bitmaps over each document's lines.

Only hashes of lines travel. They are dealt out by ranges of the hash, sorted by hash, document
and position; each range streams through once, and a line counts as first where its hash
begins. What comes back per document is a compressed bitmap: words of 64 lines, those without a
dropped line left out. Only DataFrame functions are used.

A line that a large share of the rows holds would be one task's work. Hashes with more rows
than a fraction of a range are counted before (partial counts of each task, not rows), no more
of them than a few for each range; their first document travels to the rows instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.graphs import stored
from cardlens.llm.tables import named, text_of

#: What is stripped from both ends of a line: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A hash is frequent with more rows than this fraction of the mean rows of a range.
FREQUENT = 0.25


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that rows of equal id and text share, and no others."""
    key = [named(id_col), text_of(text_col)]
    return [F.xxhash64(*key).alias("ka"), F.xxhash64(F.lit("second"), *key).alias("kb")]


def line_hashes(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``id, ka, kb, pos, h1, h2`` of every line whose key has ``min_chars`` code points."""
    lowered = F.translate(text_of(text_col), UPPER, LOWER)
    lines = df.select(
        named(id_col).alias("id"),
        *_row_key(id_col, text_col),
        F.posexplode(F.split(lowered, "\n")).alias("pos", "line"),
    )
    key = F.btrim("line", F.lit(BLANKS))
    return lines.where(F.char_length(key) >= min_chars).select(
        "id",
        "ka",
        "kb",
        "pos",
        F.xxhash64(key).alias("h1"),
        F.xxhash64(F.lit("second"), key).alias("h2"),
    )


def dropped_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> DataFrame:
    """``ka, kb, dropped``: for rows that lose lines, their key and a compressed bitmap.

    ``dropped`` is an array of (word, bits), sorted by word: bit b of word w stands for line
    64 w + b, counted from 0. A line stays in the document of the smallest id that has it, with
    all its repeats there. Rows without an id count as one document behind all others.
    """
    lines = line_hashes(df, id_col, text_col, min_chars)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = lines.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("frequent_first")
    )
    counted = stored(counted.where(F.col("n") > 1), "counted")
    total = counted.agg(F.sum("n")).first()[0] or 0
    # at most ranges / FREQUENT hashes are above this
    frequent = counted.where(F.col("n") > max(1.0, total * FREQUENT / ranges)).drop("n")
    marked = lines.join(F.broadcast(frequent.withColumn("frequent", F.lit(True))), ["h1", "h2"], "left")
    at = F.shiftrightunsigned("h1", 33) * F.lit(ranges)
    hash_range = F.shiftright(at, 31)
    spread = F.when(F.col("frequent"), F.pmod(F.col("ka"), F.lit(ranges))).otherwise(hash_range)
    dealt = marked.withColumn("range", spread.cast("int")).repartitionById(ranges, F.col("range"))
    stream = Window.partitionBy("range", "h1", "h2").orderBy(F.col("id").asc_nulls_last(), "pos")
    first = F.when(F.col("frequent"), F.col("frequent_first")).otherwise(F.first("id").over(stream))
    streamed = dealt.withColumn("first", first)
    later = streamed.where(
        (F.col("id") > F.col("first")) | (F.col("id").isNull() & F.col("first").isNotNull())
    )
    place = F.col("pos").cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    by_row = later.select("ka", "kb", F.shiftright("pos", 6).alias("word"), bit.alias("bit"))
    words = by_row.repartition("ka", "kb").groupBy("ka", "kb", "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy("ka", "kb").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped")
    )


def positions(bitmap: Column) -> Column:
    """The lines that a bitmap stands for, in order."""
    return F.flatten(
        F.transform(
            bitmap,
            lambda w: F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.lit(63)),
                    lambda b: F.call_function("getbit", w["bits"], b) == 1,
                ),
                lambda b: w["word"] * 64 + b,
            ),
        )
    )


def without(text: Column, bitmap: Column) -> Column:
    """``text`` without the lines of its bitmap; the runs of lines between them stay."""
    lines, gone = F.split(text, "\n"), positions(bitmap)

    # the two arrays are made once for each row, by a lambda over an array of one
    both = F.array(F.struct(lines.alias("lines"), gone.alias("gone")))

    def joined(x: Column) -> Column:
        def part(i: Column) -> Column:
            start = F.when(i == 0, F.lit(0)).otherwise(F.get(x["gone"], i - 1) + 1)
            end = F.coalesce(F.get(x["gone"], i), F.size(x["lines"]))
            return F.slice(x["lines"], start + 1, end - start)

        runs = F.transform(F.sequence(F.lit(0), F.size(x["gone"])), part)
        return F.array_join(F.flatten(runs), "\n")

    return F.when(bitmap.isNull(), text).otherwise(F.get(F.transform(both, joined), F.lit(0)))


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> DataFrame:
    """Per row: ``n_lines``, ``n_dropped``, ``dropped`` (null: none) and the ``kept`` text.

    A null or empty text is one empty line. A text that loses all lines is empty. Rows of equal
    id and text come out alike, rows of equal id and different texts each by their own lines.
    """
    bitmaps = dropped_lines(df, id_col, text_col, min_chars)
    rows = df.select(
        named(id_col).alias("id"), text_of(text_col).alias("text"), *_row_key(id_col, text_col)
    )
    gone = F.aggregate(
        F.coalesce(F.col("dropped"), F.array().cast("array<struct<word:int,bits:bigint>>")),
        F.lit(0).cast("long"),
        lambda n, w: n + F.bit_count(w["bits"]),
    )
    return rows.join(bitmaps, ["ka", "kb"], "left").select(
        F.col("id").alias(id_col),
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        gone.alias("n_dropped"),
        "dropped",
        without(F.col("text"), F.col("dropped")).alias("kept"),
    )


def keep_first_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> DataFrame:
    """``df`` with the kept text in place of the text, all other columns as they are.

    Rows stay, also those whose text is empty afterwards; a null text that loses no line
    stays null.
    """
    bitmaps = dropped_lines(df, id_col, text_col, min_chars)
    names = df.columns
    # the input's columns travel inside a struct, so that none clashes with the keys
    rows = df.select(F.struct(*map(named, names)).alias("row"), *_row_key(id_col, text_col))
    joined = rows.join(bitmaps, ["ka", "kb"], "left")
    text = F.col("row").getField(text_col)
    kept = F.when(F.col("dropped").isNull(), text).otherwise(
        without(F.coalesce(text, F.lit("")), F.col("dropped"))
    )
    return joined.select(
        *[(kept if n == text_col else F.col("row").getField(n)).alias(n) for n in names]
    )
