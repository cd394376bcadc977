"""Every registered query against DuckDB on the smallest tables."""

import re

import pytest
from conftest import SMALL

import __spark_entry__ as entry_point
from cardlens.catalog import QUERIES
from compare import compare, duck

# Models are checked in test_models; here they only have to give rows.
WITH_SQL = sorted(n for n, q in QUERIES.items() if q.sql is not None)
WITHOUT_SQL = sorted(n for n, q in QUERIES.items() if q.sql is None)


@pytest.fixture(scope="module")
def db():
    return duck(SMALL)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_agrees_with_its_sql(spark, db, name):
    assert compare(spark, db, SMALL, name) == ""


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_query_gives_rows(spark, db, name):
    assert compare(spark, db, SMALL, name) == ""


def test_contract(spark):
    names = set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= names and set(QUERIES) <= names
    assert entry_point.entry(spark).limit(1).count() == 1


def test_reference_sql_reads_whole_tables():
    """No sampling in the statements, and limits only where the report is a top-k."""
    for name, query in QUERIES.items():
        if query.sql and re.search(r"\bLIMIT\b", query.sql):
            assert re.search("riskiest|busiest|exposed|top|merchant_rates|merchant_risk|gender_by", name), name
        assert "SAMPLE" not in (query.sql or "")
