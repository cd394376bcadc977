import os

import duckdb
import pytest

import __spark_entry__
from cardlens.llm.catalog import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
FOLDER = "/root/testdata/sf0.01"


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(FOLDER):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    answer = db.execute(SQL[name])
    names = [d[0] for d in answer.description]
    expected = {tuple(row) for row in answer.fetchall()}
    found = QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(names)
    rows = [tuple(r[n] for n in names) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_a_row_for_every_row(spark, name):
    tables = {"op3_": ("pages", "page_id"), "op13": ("conversations", "conv_id")}
    table, key = tables.get(name[:4], ("documents", "doc_id"))
    ids = {r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()}
    found = [r[0] for r in QUERIES[name](spark, SMALL).select(key).collect()]
    assert len(found) == len(ids) and set(found) == ids
