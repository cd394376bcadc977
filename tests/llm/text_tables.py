"""Fixtures of the text tests; a conftest of this name exists one folder up."""

import pytest

SCHEMA = "doc_id long, text string, n_words string, ka int, score array<int>, text_key string"


@pytest.fixture
def docs(spark):
    """Makes a table of documents with columns whose names clash with those of results."""

    def make(rows, parts=3):
        full = [(i, t, "x", 7, [1], "y") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture
def by_id():
    """Rows of a result as a dict from id to tuple of the named columns."""

    def collect(df, *columns, key="doc_id"):
        return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}

    return collect
