"""Registration of queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Registers a ``(spark, folder) -> DataFrame`` function."""

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build

    return register


FINE = -1
_FINE_STEPS = 1 << 20


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Double columns rounded, so that the order of additions does not show.

    ``special`` names columns with other digits. ``FINE`` rounds to binary steps: means of
    cents over 2, 4, 8... rows often end in a 5 at the first digit that decimal rounding
    cuts, and then the last bit of the sum decides; on binary steps they are exact.
    """

    def settle(column: str) -> Column:
        to = special.get(column, digits)
        if to == FINE:
            return F.round(F.col(column) * _FINE_STEPS) / _FINE_STEPS
        return F.round(column, to)

    return df.select(
        *[settle(c).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )
