"""Samples and splits by a hash of the row id.

``DataFrame.sample`` and ``randomSplit`` depend on the order of rows inside partitions, so a
recomputed task or another file layout changes them. A hash of the id does not.
"""

from __future__ import annotations

from functools import reduce
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 40


def hash_position(seed: int, *keys: str) -> Column:
    """Uniform position in [0, 1) that depends only on the keys and the seed."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(_STEPS)) / _STEPS


def sample(
    df: DataFrame, fraction: float, seed: int = 42, keys: tuple[str, ...] = ("transaction_id",)
) -> DataFrame:
    """Each key independently with probability ``fraction``; a filter, no shuffle.

    Rows that share a key are kept or left together, so ``keys`` should identify a row.
    """
    return df.where(hash_position(seed, *keys) < fraction)


def layout_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own Bernoulli sample, for tables without an id."""
    return df.sample(False, fraction, seed)


def fixed_size_sample(
    df: DataFrame,
    n: int = 60_000,
    seed: int = 42,
    keys: tuple[str, ...] = ("transaction_id",),
) -> DataFrame:
    """The ``min(n, rows)`` rows with the smallest hash positions of their ``keys``.

    Only rows below a position that almost surely covers ``n`` take part in the
    sort, so tasks do not each send ``n`` candidates. If the position falls short,
    all rows take part.
    """
    position = hash_position(seed, *keys)
    total = df.count()
    if total <= n:
        return df
    reach = min(1.0, (n + 6 * sqrt(n) + 20) / total)
    candidates = df.where(position < reach)
    if candidates.count() < n:
        candidates = df
    return candidates.orderBy(position, *keys).limit(n)


def split(
    df: DataFrame,
    shares: tuple[float, ...] = (0.8, 0.2),
    seed: int = 42,
    keys: tuple[str, ...] = ("transaction_id",),
) -> list[DataFrame]:
    """Disjoint parts that together hold every row."""
    position = hash_position(seed, *keys)
    whole = sum(shares)
    parts, low = [], 0.0
    for i, share in enumerate(shares):
        high = low + share / whole
        inside = position >= low
        if i < len(shares) - 1:
            inside = inside & (position < high)
        parts.append(df.where(inside))
        low = high
    return parts


def stratified_split(
    df: DataFrame,
    label: str = "is_fraud",
    classes: tuple[int, ...] = (0, 1),
    shares: tuple[float, ...] = (0.8, 0.2),
    seed: int = 42,
    key: str = "transaction_id",
) -> list[DataFrame]:
    """Every class split on its own, each part holding all classes.

    The label is part of the hash, so the classes are split independently of each
    other but in one pass; filtering class by class and uniting would scan once per class.
    """
    return split(df.where(F.col(label).isin(*classes)), shares, seed, (key, label))


def union(parts: tuple[DataFrame, ...] | list[DataFrame]) -> DataFrame:
    """Rows of all parts, columns matched by name."""
    return reduce(DataFrame.unionByName, parts)


def distinct_pairs(df: DataFrame, label: str, index: str) -> DataFrame:
    """Label and index as they occur together, by index."""
    return df.select(label, index).distinct().orderBy(index, label)
