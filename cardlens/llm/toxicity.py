"""Toxicity by two Kneser-Ney language models, one for toxic and one for ordinary texts.

The models predict the next byte of the lower-cased words from the three before it. Both have
counts of their own for four and three bytes and back off to shared counts of two bytes and
one, so that what neither class has seen often tells little. A text's score is the difference
of its two log-likelihoods per byte, turned into a probability on labelled rows that the
models have not seen; then those rows are counted too.

All counts are taken over all labelled rows, as Spark aggregates. What tasks need to score a
text, the differences of the logarithms, is a sorted table of all strings of each order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.graphs import stored
from cardlens.llm.tables import ascii_words, filter_texts, map_batches, map_texts, named, text_of

#: Bytes of the longest strings that are counted.
ORDER = 4
#: Orders whose counts the two classes share.
SHARED = 2
#: Folds of labelled rows by crc32(id) mod 5: 0 is held out, the last one calibrates before it counts.
FOLDS, CALIBRATION = 5, 4
#: Bins of the differences that calibration counts, and the range they cover.
BINS, REACH = 4000, 2.0
#: Bytes of text that are turned into arrays at a time.
CHUNK = 4 << 20

_CLASSES = ("toxic", "other")


def keys_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The last ``ORDER`` bytes at each byte of some texts as 32-bit keys, and the texts' lengths.

    A text is its lower-cased words, each followed by a space, after a run of spaces; one
    without words has no keys.
    """
    joined = [b" ".join(words) + b" " if (words := ascii_words(t)) else b"" for t in texts]
    lengths = np.array([len(j) for j in joined], np.int64)
    pad = b" " * (ORDER - 1)
    stream = np.frombuffer(pad + pad.join(joined), np.uint8).astype(np.uint32)
    keys = np.zeros(max(0, len(stream) - ORDER + 1), np.uint32)
    for back in range(ORDER):
        end = len(stream) - back
        keys |= stream[ORDER - 1 - back : end][: len(keys)] << np.uint32(8 * back)
    # drop the keys that end in the padding between texts
    inner = np.ones(len(keys), bool)
    ends = np.cumsum(lengths) + len(pad) * np.arange(len(lengths))
    for step in range(len(pad)):
        at = ends[:-1] + step
        inner[at[at < len(keys)]] = False
    return keys[inner], lengths


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in runs of about ``CHUNK`` bytes; a longer one alone."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if held and size + len(text) > CHUNK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(named(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def _string_counts(rows: DataFrame) -> DataFrame:
    """``key, calibrating, toxic, other``: how often each string of ``ORDER`` bytes occurs.

    Tasks hand on the counts of every few megabytes of text; Spark adds them up.
    """

    def counted(label: int, calibrating: bool, texts: list[bytes]) -> pa.RecordBatch:
        keys, n = np.unique(keys_of(texts)[0], return_counts=True)
        nothing = np.zeros(len(keys), np.int64)
        columns = [
            pa.array(keys.astype(np.int64)),
            pa.array(np.full(len(keys), calibrating)),
            pa.array(n.astype(np.int64) if label else nothing),
            pa.array(nothing if label else n.astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["key", "calibrating", *_CLASSES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list[bytes]] = {}
        sizes: dict[tuple[int, bool], int] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                columns = [c.to_pylist() for c in batch.slice(begin, 256).columns]
                for text, *group in zip(*columns):
                    own = (group[0], group[1])
                    held.setdefault(own, []).append(text)
                    sizes[own] = sizes.get(own, 0) + len(text)
                    if sizes[own] > CHUNK:
                        yield counted(*own, held.pop(own))
                        sizes[own] = 0
        for own, texts in held.items():
            yield counted(*own, texts)

    schema = "key long, calibrating boolean, toxic long, other long"
    found = map_batches(rows.select("text", "toxic", "calibrating"), run, schema)
    return found.groupBy("key", "calibrating").agg(*[F.sum(c).alias(c) for c in _CLASSES])


def _seen(column: str) -> Column:
    return F.count_if(F.col(column) > 0).alias(column)


def _discount(column: str, counts: DataFrame) -> Column:
    """n1 / (n1 + 2 n2) over the strings that occur once and twice, one half without any."""
    n1, n2 = (F.count_if(F.col(column) == k) for k in (1, 2))
    share = F.when(n1 > 0, n1 / (n1 + 2 * n2)).otherwise(F.lit(0.5))
    return F.greatest(share, F.lit(0.1)).alias(f"d_{column}")


def _levels(counts: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """By order: ``key, toxic, other, seen_*`` with the classes' probabilities of the last byte,
    and ``key`` of the bytes before it with what the classes leave to the order below.

    Below the longest strings, a count is the number of different bytes that a string follows.
    """
    by_order = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        longer = by_order[order + 1]
        shorter = F.col("key") % F.lit(1 << (8 * order))
        by_order[order] = longer.groupBy(shorter.alias("key")).agg(*map(_seen, _CLASSES))
    for order in range(1, SHARED + 1):
        both = F.col("toxic") + F.col("other")
        by_order[order] = by_order[order].select("key", both.alias("toxic"), both.alias("other"))
    made: dict[int, tuple[DataFrame, DataFrame]] = {}
    for order in range(1, ORDER + 1):
        own = by_order[order]
        discounts = own.agg(*[_discount(c, own) for c in _CLASSES]).first()
        heads = own.groupBy(F.shiftright("key", 8).alias("head")).agg(
            *[F.sum(c).alias(f"n_{c}") for c in _CLASSES],
            *[F.count_if(F.col(c) > 0).alias(f"types_{c}") for c in _CLASSES],
        )
        left = {
            c: F.when(
                F.col(f"n_{c}") > 0,
                F.lit(discounts[f"d_{c}"]) * F.col(f"types_{c}") / F.col(f"n_{c}"),
            ).otherwise(F.lit(1.0))
            for c in _CLASSES
        }
        rows = own.withColumn("head", F.shiftright("key", 8)).join(heads, "head")
        if order == 1:
            below = {c: F.lit(1 / 256) for c in _CLASSES}
        else:
            lower = made[order - 1][0].select(
                F.col("key").alias("tail"), *[F.col(c).alias(f"below_{c}") for c in _CLASSES]
            )
            rows = rows.withColumn("tail", F.col("key") % F.lit(1 << (8 * (order - 1))))
            rows = rows.join(lower, "tail")
            below = {c: F.col(f"below_{c}") for c in _CLASSES}
        chance = {
            c: F.when(
                F.col(f"n_{c}") > 0,
                F.greatest(F.col(c) - F.lit(discounts[f"d_{c}"]), F.lit(0.0)) / F.col(f"n_{c}"),
            ).otherwise(F.lit(0.0))
            + left[c] * below[c]
            for c in _CLASSES
        }
        probabilities = rows.select("key", *[chance[c].alias(c) for c in _CLASSES])
        rests = heads.select(
            F.col("head").alias("key"),
            *[left[c].alias(c) for c in _CLASSES],
        )
        made[order] = (stored(probabilities, f"order{order}"), rests)
    return made


@dataclass(frozen=True)
class Table:
    """log(toxic / other) of all strings of one order, sorted by key."""

    keys: np.ndarray
    values: np.ndarray

    def get(self, keys: np.ndarray) -> np.ndarray:
        """NaN for a string that neither class has."""
        if not len(self.keys):
            return np.full(len(keys), np.nan, np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.float32(np.nan))


def _table(rows: DataFrame, order: int) -> Table:
    """All of ``key, toxic, other``: no string of ``order`` bytes is left out."""
    value = F.log(F.col("toxic") / F.col("other")).cast("float").alias("value")
    held = rows.select("key", value).toArrow()
    keys = held["key"].to_numpy().astype(np.uint32)
    by_key = np.argsort(keys)
    return Table(keys[by_key], held["value"].to_numpy()[by_key])


@dataclass(frozen=True)
class Model:
    """Differences of log-probabilities by order, and of what is left to the order below."""

    seen: dict[int, Table]
    rest: dict[int, Table]

    def differences(self, texts: list[bytes]) -> list[float]:
        """log P(toxic) - log P(other) per byte of each text, 0 for a text without words."""
        made: list[float] = []
        for some in chunks(texts):
            keys, lengths = keys_of(some)
            total = np.concatenate([[0.0], np.cumsum(self._values(keys), dtype=np.float64)])
            ends = np.cumsum(lengths)
            sums = total[ends] - total[ends - lengths]
            made += (sums / np.maximum(lengths, 1)).tolist()
        return made

    def _values(self, keys: np.ndarray) -> np.ndarray:
        values = self.seen[ORDER].get(keys)
        unseen = np.flatnonzero(np.isnan(values))
        values[unseen] = 0
        for order in range(ORDER - 1, 0, -1):
            # new to both classes: what is left behind the bytes before, times the shorter string
            own = keys[unseen]
            part = np.uint32((1 << (8 * order)) - 1)
            values[unseen] += np.nan_to_num(self.rest[order].get((own >> np.uint32(8)) & part))
            shorter = self.seen[order].get(own & part)
            known = ~np.isnan(shorter)
            values[unseen[known]] += shorter[known]
            unseen = unseen[~known]
        return values


def counted_strings(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``key, calibrating, toxic, other`` over all labelled rows that are not held out, those of
    the fold for calibration apart.

    Labels other than 0 and 1, null ones and rows without a text's id are left out.
    """
    learnt = fold(id_col) != 0
    labelled = _labelled(labels.where(learnt), id_col, label_col)
    # a merge join at every size: what is moved then follows the input
    texts = docs.where(learnt).select(
        named(id_col).alias("id"), text_of(text_col).cast("binary").alias("text")
    )
    rows = texts.join(labelled.hint("merge"), "id")
    return stored(
        _string_counts(rows.withColumn("calibrating", F.col("fold") == CALIBRATION)), "strings"
    )


def model_of(counts: DataFrame) -> Model:
    """The model of ``key, toxic, other``, one row for each string."""
    levels = _levels(counts)
    seen = {order: _table(rows, order) for order, (rows, _) in levels.items()}
    rest = {order - 1: _table(heads, order - 1) for order, (_, heads) in levels.items() if order > 1}
    return Model(seen, rest)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Models from all labelled rows whose fold is neither held out nor for calibration.

    Labels other than 0 and 1, null ones and rows without a text's id are left out.
    """
    return _first_model(counted_strings(docs, labels, id_col, text_col, label_col))


def _first_model(counts: DataFrame) -> Model:
    return model_of(counts.where(~F.col("calibrating")).select("key", *_CLASSES))


def _last_model(counts: DataFrame) -> Model:
    return model_of(counts.groupBy("key").agg(*[F.sum(c).alias(c) for c in _CLASSES]))


def _labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id, toxic, fold`` of usable labels, one row for each id; of several, the greatest."""
    label = named(label_col).cast("int")
    return (
        labels.select(named(id_col).alias("id"), label.alias("toxic"), fold(id_col).alias("fold"))
        .where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"), F.max("fold").alias("fold"))
    )


def differences(
    docs: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``difference``, the length-normalised difference of the log-likelihoods."""

    def start():
        def work(texts: list[bytes]) -> dict[str, list]:
            return {"difference": model.value.differences(texts)}

        return work

    return map_texts(docs, id_col, text_col, start, "difference double")


def calibrate(
    scored: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "toxic",
) -> tuple[float, float]:
    """Slope and offset of the logistic curve from differences to the share of toxic rows.

    Fitted to the rows of the calibration fold, counted in bins. Without rows of both classes
    the curve is flat, at the share of toxic rows (with one row of each added).
    """
    mine = _labelled(labels, id_col, label_col).where(F.col("fold") == CALIBRATION)
    at = F.floor((F.col("difference") + REACH) * (BINS / (2 * REACH)))
    binned = (
        scored.select(named(id_col).alias("id"), F.least(F.greatest(at, F.lit(0)), F.lit(BINS - 1)).alias("bin"))
        .join(mine, "id")
        .groupBy("bin", "toxic")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    x = np.array([(r["bin"] + 0.5) * 2 * REACH / BINS - REACH for r in binned])
    y = np.array([r["toxic"] for r in binned], float)
    n = np.array([r["n"] for r in binned], float)
    toxic, all_rows = float((n * y).sum()), float(n.sum())
    share = (toxic + 1) / (all_rows + 2)
    if not 0 < toxic < all_rows:
        return 0.0, float(np.log(share / (1 - share)))
    mean = (n * x).sum() / all_rows
    spread = float(np.sqrt((n * (x - mean) ** 2).sum() / all_rows)) or 1.0
    z = np.stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(2)
    ridge = np.diag([0.01, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w @ z, -30, 30)))
        slope = z @ (n * (y - p)) - ridge @ w
        bend = (z * (n * p * (1 - p) + 1e-9)) @ z.T + ridge
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def _fitted(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str
) -> tuple[Broadcast, tuple[float, float]]:
    """The model of all labelled rows that are not held out, and its calibration.

    The curve is fitted to differences by a model that has not seen the fold for calibration;
    then the counts of that fold are added.
    """
    context = docs.sparkSession.sparkContext
    counts = counted_strings(docs, labels, id_col, text_col, label_col)
    first = context.broadcast(_first_model(counts))
    unseen = docs.where(fold(id_col) == CALIBRATION)
    curve = calibrate(differences(unseen, first, id_col, text_col), labels, id_col, label_col)
    first.unpersist()
    return context.broadcast(_last_model(counts)), curve


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """Per row: ``held_out`` (its label was not learnt from), ``difference``, ``score`` from 0
    to 1 and ``predicted`` (1 from 0.5 on). Equal texts have equal scores.

    Labels have the documents' id column. Without any label the score is 0.5 throughout and
    predicts nothing; texts without words get the score of difference 0.
    """
    model, (slope, offset) = _fitted(docs, labels, id_col, text_col, label_col)
    scored = differences(docs, model, id_col, text_col)
    value = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("difference") * slope + F.lit(offset))))
    return scored.select(
        named(id_col),
        (F.coalesce(fold(id_col), F.lit(0)) == 0).alias("held_out"),
        "difference",
        value.alias("score"),
        (value >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    model, (slope, offset) = _fitted(docs, labels, id_col, text_col, label_col)

    def start():
        def work(texts: list[bytes]) -> list[bool]:
            return [d * slope + offset < 0 for d in model.value.differences(texts)]

        return work

    return filter_texts(docs, text_col, start)
