"""Exact ranks, quantiles and cumulative distributions without a single-task sort.

Equal values are counted first, so a value shared by a third of the rows is one row. Spark
sorts the distinct values across the cluster, by ranges that it samples itself; each range is
ranked in parallel and shifted by the size of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.session import settled


def value_counts(
    df: DataFrame, value: str, by: tuple[str, ...] = (), weight: str | None = None
) -> DataFrame:
    """``by..., value, n`` per distinct non-NULL value, in the value's own type.

    Computed now, in one pass, because ranking reads it several times. With ``weight``
    the rows are already counted and that column holds their number.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return settled(df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(n.alias("n")))


def sorted_parts(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` sorted across the cluster and stored, with ``part`` and ``place`` of each row.

    Parts are ranges of the order, one for each sorting task; places count from 0 in a part.
    """
    mark = F.monotonically_increasing_id()
    marked = settled(df.orderBy(*order).withColumn("mark", mark))
    return marked.select(
        *df.columns,
        F.shiftright("mark", 33).alias("part"),
        F.col("mark").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )


def running_counts(counts: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``before, upto, total`` to the rows of ``value_counts``.

    ``before`` and ``upto`` are the rows of the group below the value and up to and
    including it. ``by`` must be a handful of groups (labels); values are unlimited.
    """
    parts = sorted_parts(counts, *by, value)
    # One row per group and part that holds it: groups + parts rows are windowed here.
    keys = [F.col(c) for c in by] or [F.lit(0)]
    ahead = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(*by, "part")
        .agg(F.sum("n").alias("part_n"))
        .select(
            *[F.col(c).alias(f"{c}_of_part") for c in by],
            F.col("part").alias("part_id"),
            F.coalesce(F.sum("part_n").over(ahead), F.lit(0)).alias("offset"),
            F.sum("part_n").over(Window.partitionBy(*keys)).alias("total"),
        )
    )
    matches = F.col("part") == F.col("part_id")
    for c in by:
        matches = matches & F.col(c).eqNullSafe(F.col(f"{c}_of_part"))
    inside = (
        Window.partitionBy(*by, "part")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.col("offset") + F.sum("n").over(inside)
    return (
        parts.join(offsets, matches)
        .withColumn("upto", upto)
        .select(*by, value, "n", (F.col("upto") - F.col("n")).alias("before"), "upto", "total")
    )


def running_sums(
    levels: DataFrame, value: str, sums: list[str], by: tuple[str, ...] = ()
) -> DataFrame:
    """Adds ``before_*, upto_*, total_*`` of the columns ``sums`` to distinct values of a group.

    Sums below the value, up to and including it, and of the group, as :func:`running_counts`
    has them for rows. ``levels`` is read twice after one sort; ``by`` must be a handful of
    groups.
    """
    parts = sorted_parts(levels, *by, value)
    keys = [F.col(c) for c in by] or [F.lit(0)]
    ahead = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # a row for each group and part that holds it
        parts.groupBy(*by, "part")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            *[F.col(c).alias(f"{c}_of_part") for c in by],
            F.col("part").alias("part_id"),
            *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"offset_{c}") for c in sums],
            *[F.sum(c).over(Window.partitionBy(*keys)).alias(f"total_{c}") for c in sums],
        )
    )
    matches = F.col("part") == F.col("part_id")
    for c in by:
        matches = matches & F.col(c).eqNullSafe(F.col(f"{c}_of_part"))
    inside = (
        Window.partitionBy(*by, "part")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = {f"upto_{c}": F.col(f"offset_{c}") + F.sum(c).over(inside) for c in sums}
    return (
        parts.join(offsets, matches)
        .withColumns(upto)
        .select(
            *by,
            value,
            *sums,
            *[(F.col(f"upto_{c}") - F.col(c)).alias(f"before_{c}") for c in sums],
            *upto,
            *[f"total_{c}" for c in sums],
        )
    )


def lower_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, median``: the exact lower median of each column's known values.

    The columns are read side by side as (column, value) rows, counted, and sorted once by
    column and value. NULL and NaN are not values; a column without any has no row.
    """
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value"))
        for c in columns
    ]
    counts = value_counts(df.select(F.inline(F.array(*entries))), "value", ("column_name",))
    return quantiles(counts, "value", {"median": 0.5}, ("column_name",), discrete=True)


def _value_at(position: Column, value: str) -> Column:
    """Aggregate that picks the value at a 0-based sorted position."""
    holds = (F.col("before") <= position) & (position < F.col("upto"))
    return F.max(F.when(holds, F.col(value)))


def quantiles(
    counts: DataFrame,
    value: str,
    shares: dict[str, float],
    by: tuple[str, ...] = (),
    discrete: bool = False,
) -> DataFrame:
    """Exact quantiles of counted values: a column per entry of ``shares``, a row per group.

    Linear interpolation between neighbours by default, as double; ``discrete`` gives the
    smallest value that covers the share instead, in its own type.
    """
    picks, outputs = [], []
    for i, (name, share) in enumerate(shares.items()):
        if discrete:
            covered = F.col("upto") >= F.col("total") * share
            picks.append(F.min(F.when(covered, F.col(value))).alias(name))
            outputs.append(F.col(name))
            continue
        spot = (F.col("total") - 1) * share
        low, high, part = f"low{i}", f"high{i}", f"part{i}"
        picks.append(_value_at(F.floor(spot), value).alias(low))
        picks.append(_value_at(F.ceil(spot), value).alias(high))
        picks.append(F.max(spot - F.floor(spot)).alias(part))
        first, last = F.col(low).cast("double"), F.col(high).cast("double")
        outputs.append((first + (last - first) * F.col(part)).alias(name))
    ranked = running_counts(counts, value, by)
    return ranked.groupBy(*by).agg(*picks).select(*by, *outputs)


def cumulative_distribution(counts: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Steps of the empirical CDF: share of the group at or below each distinct value."""
    return running_counts(counts, value, by).select(
        *by, value, "n", (F.col("upto") / F.col("total")).alias("cdf")
    )


def number_rows(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Adds the 0-based place of each row in a total order, without a one-task window.

    The parts' sizes, one row each, give the offset of every part. The order must be unique,
    or equal rows are numbered arbitrarily.
    """
    parts = sorted_parts(df, *order)
    ahead = Window.partitionBy(F.lit(0)).orderBy("part_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(F.col("part").alias("part_id"))
        .agg(F.count(F.lit(1)).alias("size"))
        .select("part_id", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    )
    return (
        parts.join(offsets, F.col("part") == F.col("part_id"))
        .withColumn(name, F.col("offset") + F.col("place"))
        .select(*df.columns, name)
    )
