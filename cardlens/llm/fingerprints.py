"""Document fingerprints by consistent weighted sampling.

A text is the multiset of its lower-cased words, weighted by their counts. For each sample,
every (word, weight) draws a value from gamma and uniform numbers that depend on the word
alone; the word with the least value and its quantised weight are the sample. Two texts draw
the same sample with the probability of their generalised Jaccard similarity, the sum of the
smaller weights over the sum of the greater ones. Values are drawn once per (word, weight) and
remembered, up to a bound.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from cardlens.llm.tables import STEP, map_batches, named, text_of

SAMPLES = 128
#: (word, weight) pairs whose values a task remembers: 1 KB each.
KEPT = 1 << 17
#: (word, weight) pairs taken at a time.
BLOCK = 1 << 13
#: The sample of a text without words; no other sample has this value.
NOTHING = 0xFFFF

_WORDS = re.compile(r"\w+").findall


def terms(text: str) -> Counter[str]:
    """Weighted terms: words and their counts; without a word, the whole stripped text."""
    lowered = text.lower()
    found = _WORDS(lowered)
    if not found and lowered.strip():
        found = [lowered.strip()]
    return Counter(found)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits scrambled (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A word of weight 1, or a word and its weight.
Pair = str | tuple[str, int]


def _pairs(weights: Counter[str]) -> list[Pair]:
    return [w if n == 1 else (w, n) for w, n in weights.items()]


class Sampler:
    """Draws samples of weighted terms."""

    def __init__(self, samples: int = SAMPLES, kept: int = KEPT) -> None:
        self.samples = samples
        self.place: dict[Pair, int] = {}
        self.values = np.empty((kept, samples), np.uint64)
        steps = np.arange(1, 3 * samples + 1, dtype=np.uint64).reshape(3, samples)
        self.steps = steps * np.uint64(0x9E3779B97F4A7C15)

    def draw(self, keys: list[Pair]) -> np.ndarray:
        """For each (word, weight) and sample: its value, then what the sample would be.

        With r and c from Gamma(2, 1), b uniform and t = floor(ln(weight) / r + b), the value
        is ln(c) - r (t - b + 1). It fills the upper 32 bits, in an order that integers keep;
        the lower ones tell the word and t.
        """
        pairs = [(k, 1) if isinstance(k, str) else k for k in keys]
        seeds = np.array([xxhash.xxh64_intdigest(w.encode(), 0) for w, _ in pairs], np.uint64)
        weights = np.log(np.array([n for _, n in pairs], np.float32))[:, None]
        bits = _mixed(seeds[:, None, None] + self.steps)
        scale = np.float32(2**-24)
        high = ((bits >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * scale
        low = ((bits & np.uint64(0xFFFFFF)).astype(np.float32) + np.float32(0.5)) * scale
        r = -np.log(high[:, 0] * low[:, 0])
        c = -np.log(high[:, 1] * low[:, 1])
        b = high[:, 2]
        t = np.floor(weights / r + b)
        value = (np.log(c) - r * (t - b + 1)).astype(np.float32).view(np.uint32)
        negative = value >> np.uint32(31) == 1
        ordered = np.where(negative, ~value, value | np.uint32(1 << 31)).astype(np.uint64)
        names = _mixed(seeds[:, None] + t.astype(np.int64).astype(np.uint64)) >> np.uint64(32)
        return (ordered << np.uint64(32)) | names

    def _rows(self, keys: list[Pair]) -> list[int]:
        rows = list(map(self.place.get, keys))
        if None in rows:
            new = list(dict.fromkeys(k for k, row in zip(keys, rows) if row is None))
            if len(self.place) + len(new) > len(self.values):
                self.place.clear()
                new = list(dict.fromkeys(keys))
            first = len(self.place)
            for begin in range(0, len(new), 256):
                some = new[begin : begin + 256]
                self.values[first + begin : first + begin + len(some)] = self.draw(some)
            self.place.update(zip(new, range(first, first + len(new))))
            rows = list(map(self.place.__getitem__, keys))
        return rows

    def least(self, groups: list[list[Pair]]) -> np.ndarray:
        """For each group of (word, weight) pairs and sample, the least value."""
        least = np.full((len(groups), self.samples), ~np.uint64(0), np.uint64)
        keys: list[Pair] = []
        owners: list[tuple[int, int]] = []  # the group and where its keys end

        def flush() -> None:
            rows = np.array(self._rows(keys), np.intp)
            begin = 0
            for group, end in owners:
                part = self.values[rows[begin:end]].min(axis=0)
                np.minimum(least[group], part, out=least[group])
                begin = end
            keys.clear()
            owners.clear()

        for i, own in enumerate(groups):
            for begin in range(0, len(own), BLOCK):
                part = own[begin : begin + BLOCK]
                if keys and len(keys) + len(part) > BLOCK:
                    flush()
                keys += part
                owners.append((i, len(keys)))
        if keys:
            flush()
        return least

    def _samples(self, least: np.ndarray) -> np.ndarray:
        names = (least & np.uint64(0xFFFFFFFF)) % np.uint64(NOTHING)
        names[least[:, 0] == ~np.uint64(0)] = NOTHING
        return names.astype(np.uint16)

    def fingerprints(self, texts: list[str]) -> np.ndarray:
        """A row of 16-bit samples for each text."""
        return self._samples(self.least([_pairs(terms(text)) for text in texts]))

    def edited_fingerprints(
        self, texts: list[str], followings: list[str | None]
    ) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints of texts and of their edited texts.

        A minimum is taken once over the weighted words that an edit leaves as they are, then
        over those of either text whose count it may have changed.
        """
        groups = []
        for text, following in zip(texts, followings):
            cut, tail = _edit(text, following)
            safe = text.rfind(" ", 0, cut)  # words before it are the same in both
            if safe < 0 or not _WORDS(text[:safe].lower()):
                groups += [[], _pairs(terms(text)), _pairs(terms(text[:cut] + tail))]
                continue
            kept = Counter(_WORDS(text[:safe].lower()))
            rests = [Counter(_WORDS(rest.lower())) for rest in (text[safe:], text[safe:cut] + tail)]
            changed = rests[0].keys() | rests[1].keys()
            groups.append([w if n == 1 else (w, n) for w, n in kept.items() if w not in changed])
            for rest in rests:
                counts = ((w, kept[w] + rest[w]) for w in changed)
                groups.append([w if n == 1 else (w, n) for w, n in counts if n])
        least = self.least(groups)
        shared = least[::3]
        return tuple(self._samples(np.minimum(shared, least[i::3])) for i in (1, 2))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal samples, an estimate of generalised Jaccard similarity."""
    return float((a == b).mean())


def written(samples: np.ndarray) -> str:
    """Four lower-case hex digits for each sample."""
    return samples.astype(">u2").tobytes().hex()


def edited_text(text: str, following: str | None) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    cut, tail = _edit(text, following)
    return text[:cut] + tail


def _edit(text: str, following: str | None) -> tuple[int, str]:
    """Where the edited text departs from ``text``, and what stands there instead."""
    quarter = len(text) // 4
    return len(text) - quarter, (following or "")[:quarter]


def _neighbours(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``bucket, copied, id, text``, sorted by these within each partition, a bucket in one.

    Buckets are ranges of ids and hashes of the text with about equal rows, as Spark samples
    them for a sort of these alone. Where each begins, 16 bytes a bucket, goes to the workers
    beside the plan, which does not grow with the buckets. The first row of a bucket is copied
    to the end of the bucket before (the first bucket's to the last one), so that each row's
    successor stands in its own bucket. Rows without an id are spread by their text over
    buckets of their own, with negative numbers.
    """
    spark = df.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = text_of(text_col)
    rows = df.select(
        named(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text")
    )
    begins = (
        rows.where("id IS NOT NULL")
        .select("id", "h")
        .repartitionByRange(buckets, "id", "h")
        .groupBy(F.spark_partition_id())
        .agg(F.min(F.struct("id", "h")).alias("begin"))
        .select("begin.*")
        .collect()  # a row for each bucket
    )
    n = max(1, len(begins))
    shared = spark.sparkContext.broadcast(np.array(sorted(map(tuple, begins)) or [(0, 0)], np.int64))

    @F.pandas_udf("long")
    def place(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        """Twice the bucket of each row, and 1 more where the bucket begins with it."""
        firsts, marks = shared.value[:, 0], shared.value[:, 1]
        i, h = ids.fillna(0).to_numpy(np.int64), hashes.to_numpy(np.int64)
        low, high = np.searchsorted(firsts, i), np.searchsorted(firsts, i, "right")
        number = high - 1
        for at in np.unique(low[low < high]):  # the few ids that a bucket begins with
            of = (low == at) & (low < high)
            number[of] = at - 1 + np.searchsorted(marks[at : high[of][0]], h[of], "right")
        begin = (number >= 0) & (firsts[number] == i) & (marks[number] == h)
        return pd.Series(2 * number + begin)

    alone = (-1 - F.pmod(F.col("h"), F.lit(buckets))).cast("int")
    placed = rows.withColumn("place", place("id", "h"))
    known = F.col("id").isNotNull()
    numbered = placed.withColumns(
        {
            "number": F.when(known, F.shiftright("place", 1).cast("int")).otherwise(alone),
            "is_begin": known & (F.col("place").bitwiseAND(F.lit(1)) == 1),
        }
    )
    own = F.struct(F.col("number").alias("bucket"), F.lit(0).alias("copied"))
    before = F.when(F.col("number") == 0, n - 1).otherwise(F.col("number") - 1)
    copy = F.struct(before.alias("bucket"), F.lit(1).alias("copied"))
    return (
        numbered.select(
            F.explode(F.when(F.col("is_begin"), F.array(own, copy)).otherwise(F.array(own))).alias("to"),
            "id",
            "h",
            "text",
        )
        .select("to.bucket", "to.copied", "id", "h", "text")
        .repartitionById(n, F.pmod(F.col("bucket"), F.lit(n)).cast("int"))
        .sortWithinPartitions("bucket", "copied", "id", "h", "text")
        .select("bucket", "copied", "id", "text")
    )


def fingerprint_edits(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likenesses.

    The edited text ends in the beginning of the next row's, by ascending id, then a hash of the
    text; the row after the last is the first. A row without an id has no next row: nothing replaces its
    last quarter and ``near_next`` is 0. A text without words has a fingerprint of its own,
    like only to itself. Ids have to be integers.
    """
    rows = _neighbours(df, id_col, text_col)
    fields = (
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    schema = StructType([StructField(id_col, rows.schema["id"].dataType), *StructType.fromDDL(fields)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        held: list[tuple[int, int, int | None, str]] = []

        def emit(group: list[tuple[int, int, int | None, str]]) -> pa.RecordBatch:
            """All rows of ``group`` but the last, which is only looked at as a next row."""
            pairs = []
            for (bucket, copied, doc, text), (other, _, _, following) in zip(group, group[1:]):
                if not copied:
                    next_text = following if bucket == other and doc is not None else None
                    pairs.append((doc, text, next_text))
            edited = [edited_text(text, after) for _, text, after in pairs]
            prints, changed = sampler.edited_fingerprints(*(([p[i] for p in pairs]) for i in (1, 2)))
            made = []
            for i, (doc, text, after) in enumerate(pairs):
                if after is None:
                    near_next = 0.0
                elif i + 1 < len(pairs) and pairs[i + 1][1] is after:
                    near_next = likeness(prints[i], prints[i + 1])
                else:  # a copy of the next bucket's first row
                    near_next = likeness(prints[i], sampler.fingerprints([after])[0])
                made.append(
                    (
                        doc,
                        len(text),
                        sha256(edited[i].encode()).hexdigest(),
                        written(prints[i]),
                        written(changed[i]),
                        likeness(prints[i], changed[i]),
                        near_next,
                    )
                )
            columns = zip(*made) if made else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

        for batch in batches:
            for begin in range(0, batch.num_rows, STEP):
                columns = [c.to_pylist() for c in batch.slice(begin, STEP).columns]
                held += zip(*columns)
                yield emit(held)
                del held[:-1]
        if held:
            yield emit([*held, (1 << 40, 1, None, "")])

    return map_batches(rows, run, schema)
