"""Ordered value bands: the expression that assigns one and its label dimension."""

from __future__ import annotations

from dataclasses import dataclass
from math import inf

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Half-open bands ``[edges[i], edges[i + 1])`` named ``labels[i]``.

    ``catch_all`` decides what happens to NULL and out-of-range values: they
    join the last band (True) or get no band at all (False). The two policies
    give different counts, so every report names the one it uses.
    """

    name: str
    edges: tuple[float, ...]
    labels: tuple[str, ...]
    catch_all: bool

    def of(self, value: Column) -> Column:
        """Label of ``value`` as a plain CASE expression."""
        *inner, last = zip(self.edges[1:], self.labels)
        if self.catch_all:
            case = F.when(value < inner[0][0], inner[0][1])
            inner = inner[1:]
        else:
            outside = value.isNull() | F.isnan(value.cast("double")) | (value < self.edges[0])
            case = F.when(outside, F.lit(None).cast("string"))
        for upper, label in inner:
            case = case.when(value < upper, label)
        upper, label = last
        return case.otherwise(label) if upper == inf else case.when(value < upper, label)

    def dimension(self, spark: SparkSession) -> DataFrame:
        """``(label, position)`` rows; as many as there are labels."""
        rows = list(zip(self.labels, range(len(self.labels))))
        return spark.createDataFrame(rows, f"{self.name} string, position int")


# Band edges and labels of the reports. The same bands appear with
# hyphens in the exploratory reports and with en dashes in the behavioural ones.
DISTANCE_EXPLORATORY = Bands(
    "dist_bin",
    (-inf, 10, 50, 100, inf),
    ("< 10 km", "10-50 km", "50-100 km", "100-300 km"),
    catch_all=True,
)
DISTANCE_BEHAVIOUR = Bands(
    "dist_bin",
    (-inf, 10, 50, 100, 300, inf),
    ("< 10 km", "10–50 km", "50–100 km", "100–300 km", "> 300 km"),
    catch_all=True,
)
DISTANCE_TIERS = Bands(
    "dist_bin",
    (0, 10, 50, 100, 300, inf),
    ("< 10 km", "10-50 km", "50-100 km", "100-300 km", "> 300 km"),
    catch_all=False,
)
AGE_EXPLORATORY = Bands(
    "age_group",
    (-inf, 25, 35, 45, 55, 65, inf),
    ("Under 25", "25-34", "35-44", "45-54", "55-64", "65+"),
    catch_all=True,
)
AGE_BEHAVIOUR = Bands(
    "age_group",
    (-inf, 25, 35, 45, 55, 65, inf),
    ("Under 25", "25–34", "35–44", "45–54", "55–64", "65+"),
    catch_all=True,
)
AGE_TIERS = Bands(
    "age_group",
    (0, 25, 35, 45, 55, 65, 200),
    ("Under 25", "25-34", "35-44", "45-54", "55-64", "65+"),
    catch_all=False,
)
AMOUNT_TIERS = Bands(
    "amount_tier",
    (0, 10, 50, 100, 250, 500, inf),
    ("< $10", "$10-50", "$50-100", "$100-250", "$250-500", "> $500"),
    catch_all=False,
)
AMOUNT_BINS = Bands(
    "amount_bin",
    (-inf, 10, 100, 500, inf),
    ("micro", "small", "medium", "large"),
    catch_all=True,
)
TIME_OF_DAY = Bands(
    "tx_time_of_day",
    (-inf, 6, 12, 18, inf),
    ("night", "morning", "afternoon", "evening"),
    catch_all=True,
)

# Weekday labels, Sunday first and Monday first.
WEEKDAYS_FROM_SUNDAY = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
WEEKDAYS_FROM_MONDAY = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def weekday_label(position: Column, labels: tuple[str, ...]) -> Column:
    """Label at a 1-based ``position``."""
    return F.try_element_at(F.array(*[F.lit(label) for label in labels]), position)
