"""Registered queries: each operator applied to the star-schema tables, with the SQL that
states the same result where SQL can."""

from cardlens.catalog import (  # noqa: F401  (importing registers the queries)
    breakdowns,
    distributions,
    enrichment,
    features,
    layout,
    models,
    portfolio,
    preparation,
    sources,
)
from cardlens.catalog.registry import QUERIES

__all__ = ["QUERIES"]
