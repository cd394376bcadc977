"""Scalar expressions on transaction columns. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
DAYS_PER_YEAR = 365.25

# Text layouts tried after Spark's own timestamp format.
TIMESTAMP_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm", "dd-MM-yyyy HH:mm:ss")


def tolerant_timestamp(text: Column) -> Column:
    """First layout that parses, else NULL. ANSI mode is on, hence the try_ forms."""
    attempts = [F.try_to_timestamp(text)]
    attempts += [F.try_to_timestamp(text, F.lit(layout)) for layout in TIMESTAMP_LAYOUTS]
    return F.coalesce(*attempts)


def relative_seconds_timestamp(seconds: Column) -> Column:
    """Timestamp of whole seconds since the epoch; a fraction is cut off."""
    return F.timestamp_seconds(seconds.try_cast("double").try_cast("bigint"))


def tolerant_flag(text: Column) -> Column:
    """Integer label; goes through double so that ``"1.0"`` is 1."""
    return text.try_cast("double").try_cast("int")


def fingerprint(columns: list[str]) -> Column:
    """SHA-256 over the text forms of ``columns`` in name order."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("||", *parts), 256)


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance (haversine); NULL if any coordinate is NULL.

    Rounding may push the haversine a hair over 1, where asin is undefined. The
    clamp is a CASE because ``least`` skips NULLs and would turn a missing
    coordinate into half the globe.
    """
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlon), F.lit(2.0))
    return F.asin(F.sqrt(F.when(h > 1.0, F.lit(1.0)).otherwise(h))) * (2 * EARTH_RADIUS_KM)


def age_in_years(birth_text: Column, at: Column) -> Column:
    """Whole years between a ``yyyy-MM-dd`` text and a timestamp; bad text gives NULL."""
    born = F.try_to_date(birth_text, "yyyy-MM-dd")
    return F.floor(F.datediff(at.cast("date"), born) / F.lit(DAYS_PER_YEAR)).cast("bigint")


def is_weekend(at: Column) -> Column:
    return F.dayofweek(at).isin(1, 7).cast("int")


def male_flag(gender: Column) -> Column:
    return F.when(F.upper(gender) == "M", 1).otherwise(0)


def month_key(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM")


def month_key_from_parts(at: Column) -> Column:
    """Same key built from year and month, for calendars beyond four-digit years."""
    return F.concat(
        F.year(at).cast("string"), F.lit("-"), F.lpad(F.month(at).cast("string"), 2, "0")
    )


def zscore(value: Column, mean: Column, spread: Column) -> Column:
    """NULL when the spread is zero."""
    return F.try_divide(value - mean, spread)
