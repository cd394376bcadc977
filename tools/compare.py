"""Runs registered queries on Spark and their SQL on DuckDB and compares the results.

    python tools/compare.py /root/testdata/sf0.01 [--large] [name-part ...]

With ``--large`` no table counts as small: joins shuffle, as they would on tables beyond every
broadcast bound.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardlens.catalog import QUERIES  # noqa: E402
from cardlens.plans.report import summarize_plan  # noqa: E402

SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{file}')")
    return db


def _key(row: tuple) -> list[str]:
    return [repr(v) for v in row]


def compare(spark: SparkSession, db: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """Empty if both sides agree in column names, types, rows and values."""
    result = QUERIES[name].build(spark, folder)
    if any("NestedLoop" in join or "Cartesian" in join for join in summarize_plan(result).joins):
        return "the plan pairs all rows"
    columns = sorted(result.columns)
    got = [tuple(r[c] for c in columns) for r in result.collect()]
    if QUERIES[name].sql is None:
        return "" if got else "no rows"
    answer = db.execute(QUERIES[name].sql)
    theirs = {d[0]: str(d[1]) for d in answer.description}
    if sorted(theirs) != columns:
        return f"columns {columns} != {sorted(theirs)}"
    kinds = {c: SPARK_TO_DUCK.get(k, k) for c, k in result.dtypes}
    wrong = {c: (kinds[c], theirs[c]) for c in columns if kinds[c] != theirs[c]}
    order = [list(theirs).index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in answer.fetchall()]
    if wrong:
        return f"types {wrong}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    got, expected = sorted(got, key=_key), sorted(expected, key=_key)
    differing = [(a, b) for a, b in zip(got, expected) if _key(a) != _key(b)]
    if differing:
        a, b = differing[0]
        cells = [(c, x, y) for c, x, y in zip(columns, a, b) if repr(x) != repr(y)]
        return f"{len(differing)} rows differ, first: {cells}"
    if any(isinstance(v, float) and math.isnan(v) for row in got for v in row):
        return "NaN in result"
    return ""


def main() -> None:
    folder, *parts = sys.argv[1:]
    large = "--large" in parts
    parts = [p for p in parts if p != "--large"]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if large:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    db = duck(folder)
    bad = 0
    names = [n for n in QUERIES if not parts or any(p in n for p in parts)]
    for name in names:
        start = time.perf_counter()
        try:
            problem = compare(spark, db, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.perf_counter() - start
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok ':4}{took:6.2f}s {name} {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
