"""Distributions, correlations, trends and outliers."""

from __future__ import annotations

from itertools import combinations
from math import isnan

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions import expressions as X
from cardlens.operators.features import amount_moments
from cardlens.operators.ranking import quantiles, value_counts

# Numeric columns of the correlation report.
CORRELATED = ("amount", "city_pop", "is_fraud", "age", "dist_km", "tx_hour", "tx_month_num")


def correlation_input(df: DataFrame) -> DataFrame:
    """The numeric columns of the report that can be derived, without incomplete rows."""
    corners = ("lat", "long", "merch_lat", "merch_long")
    columns = [F.col(c) for c in ("amount", "city_pop", "is_fraud") if c in df.columns]
    if {"dob", "transaction_ts"} <= set(df.columns):
        columns.append(X.age_in_years(F.col("dob"), F.col("transaction_ts")).alias("age"))
    if set(corners) <= set(df.columns):
        columns.append(X.distance_km(*[F.col(c) for c in corners]).alias("dist_km"))
    if "transaction_ts" in df.columns:
        columns.append(F.hour("transaction_ts").alias("tx_hour"))
        columns.append(F.month("transaction_ts").alias("tx_month_num"))
    return df.select(*columns).dropna()


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations as ``col_a, col_b, r`` rows, every ordered pair, in one pass.

    A constant column has no correlation (NULL), not even with itself.
    """
    columns = list(columns)
    value = {c: F.col(c).cast("double") for c in columns}
    spreads = [F.stddev_samp(value[c]).alias(f"s_{c}") for c in columns]
    shared = [
        F.covar_samp(value[a], value[b]).alias(f"c_{a}__{b}") for a, b in combinations(columns, 2)
    ]
    lines = []
    for a in columns:
        for b in columns:
            first, second = sorted((a, b), key=columns.index)
            if a == b:
                r = F.when(F.col(f"s_{a}") > 0, F.lit(1.0))
            else:
                r = F.try_divide(
                    F.col(f"c_{first}__{second}"), F.col(f"s_{first}") * F.col(f"s_{second}")
                )
            lines.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), r.alias("r")))
    return df.agg(*spreads, *shared).select(F.inline(F.array(*lines)))


def vector_correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same matrix through Spark ML's vector statistics, which gives a constant
    column 1 with itself."""
    assembler = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip")
    matrix = Correlation.corr(assembler.transform(df).select("features"), "features").first()[0]
    rows = [
        (a, b, None if isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def label_correlations(df: DataFrame, columns: list[str], label: str = "is_fraud") -> DataFrame:
    """Correlation of each column with the label, strongest first."""
    return (
        correlation_matrix(df, columns)
        .where((F.col("col_a") == label) & (F.col("col_b") != label))
        .select(F.col("col_b").alias("feature"), "r")
        .orderBy(F.abs("r").desc_nulls_last(), "feature")
    )


def histogram(
    df: DataFrame, value: str, bins: int, label: str | None = "is_fraud"
) -> DataFrame:
    """Equal-width histogram with density, per label 0/1 over the label's own range, or
    over all rows if ``label`` is None.

    Two narrow passes: the ranges, then a count per label and bin, so no more rows than
    that leave a task. The ranges are at most two rows, which bounds the broadcast.
    """
    known = df.where(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    limits = [
        F.min(value).alias("low"),
        ((F.max(value) - F.min(value)) / bins).alias("width"),
        F.count(F.lit(1)).alias("total"),
    ]
    if label is None:
        whole = known.agg(*limits).select(F.struct("low", "width", "total")).scalar()
        names = ("low", "width", "total")
        ranged = known.select(value, *[whole.getField(n).alias(n) for n in names])
    else:
        points = known.where(F.col(label).isin(0, 1)).select(label, value)
        ranged = points.join(F.broadcast(points.groupBy(label).agg(*limits)), label)
    groups = [] if label is None else [label]
    slot = F.floor(F.try_divide(F.col(value) - F.col("low"), F.col("width")))
    return (
        ranged.withColumn("bin", F.least(F.coalesce(slot, F.lit(0)), F.lit(bins - 1)).cast("int"))
        .groupBy(*groups, "bin", "low", "width", "total")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *groups,
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
            "n",
            F.try_divide(F.col("n"), F.col("total") * F.col("width")).alias("density"),
        )
    )


def clipped_five_numbers(df: DataFrame, value: str = "amount", share: float = 0.99) -> DataFrame:
    """Minimum, quartiles and maximum per label of the values up to the overall
    ``share`` quantile. One scan: everything comes from the counted values."""
    counts = value_counts(df, value, ("is_fraud",))
    limit = quantiles(value_counts(counts, value, weight="n"), value, {"limit": share}).scalar()
    marks = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return quantiles(counts.where(F.col(value) <= limit), value, marks, by=("is_fraud",))


def trend(series: DataFrame, value: str, index: str = "t") -> DataFrame:
    """Least-squares line of an aggregated series."""
    return series.agg(
        F.regr_slope(value, index).alias("slope"), F.regr_intercept(value, index).alias("intercept")
    )


def iqr_outliers(df: DataFrame, reach: float = 1.5) -> DataFrame:
    """Amounts above the upper quartile fence and how many of them are fraud."""
    counts = value_counts(df, "amount", ("is_fraud",))
    quartiles = quantiles(
        value_counts(counts, "amount", weight="n"), "amount", {"q1": 0.25, "q3": 0.75}
    )
    fence = quartiles.select(F.col("q3") + (F.col("q3") - F.col("q1")) * reach).scalar()
    above = F.col("amount") > fence
    return counts.agg(
        fence.alias("upper_fence"),
        F.sum(F.when(above, F.col("n")).otherwise(0)).alias("outliers"),
        F.sum(F.when(above & (F.col("is_fraud") == 1), F.col("n")).otherwise(0)).alias(
            "fraud_outliers"
        ),
    )


def zscore_outliers(df: DataFrame, limit: float = 3.0) -> DataFrame:
    """Amounts more than ``limit`` deviations from the mean and how many are fraud."""
    moments = amount_moments(df).select(F.struct("mean", "stddev")).scalar()
    score = X.zscore(F.col("amount"), moments.getField("mean"), moments.getField("stddev"))
    beyond = F.abs(score) > limit
    return df.agg(
        F.count_if(beyond).alias("outliers"),
        F.count_if(beyond & (F.col("is_fraud") == 1)).alias("fraud_outliers"),
    )
