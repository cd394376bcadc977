import random
import re

import pytest
from pyspark.sql import functions as F

from cardlens.llm import line_dedup
from text_tables import docs  # noqa: F401

BLANK = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def plain(rows, min_chars=10):
    """Rows of equal id are one document."""
    lower = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    key = lambda line: BLANK.sub("", line.translate(lower))
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(float("inf") if i is None else i)
    made = []
    for i, text in rows:
        lines = (text or "").split("\n")
        me = float("inf") if i is None else i
        gone = [len(key(x)) >= min_chars and min(holders[key(x)]) != me for x in lines]
        made.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(made, key=str)


def found(df):
    return sorted(
        ((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df).collect()), key=str
    )


@pytest.mark.parametrize("frequent", [0.25, 1e-9, 1e9])
def test_against_brute_force(docs, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    rng = random.Random(1)
    pool = [f"line number {i} ÉÀ" for i in range(40)] + ["short", "", "  ", "Exactly10c", "\t exactly10C \r"]
    pool += ["LINE number 3 ÉÀ ", "line number 3 éà", "the very common line"] + ["the very common line"] * 30
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(-20, 60)]
    rows += [(100, None), (101, ""), (102, "\n"), (103, "the very common line\nthe very common line")]
    rows += [(-30, "mine alone, twice\nmine alone, twice"), (None, "mine alone, twice\nnot elsewhere")]
    rows += [(None, "not elsewhere"), (200, "long and repeated line\n" * 3000 + "end of it all")]
    rows += [(201, "\n".join(f"many lines {k}" for k in range(2000)) + "\nlong and repeated line")]
    rows += [(202, "\n".join(f"many lines {k}" for k in range(0, 2000, 3)))]
    assert found(docs(rows)) == plain(rows)


def test_repeated_rows_and_ids(docs):
    rows = [(1, "a repeated line\nx"), (1, "a repeated line\nx"), (1, "a repeated line\nother"), (2, "y\nA repeated line")]
    assert found(docs(rows)) == plain(rows)


def test_all_rows_without_ids_keep_their_lines(docs):
    rows = [(None, "the same long line"), (None, "the same long line")]
    assert found(docs(rows)) == plain(rows)


def test_bitmaps_hold_only_words_with_drops(docs):
    rows = [(1, "first of all lines"), (2, "\n".join(["z"] * 700 + ["first of all lines"] * 2))]
    bitmap = line_dedup.dropped_lines(docs(rows)).collect()
    assert [[tuple(w) for w in r.dropped] for r in bitmap] == [[(10, 0b11 << 60)]]


def test_stage_keeps_all_columns_and_rows(docs):
    rows = [(1, "first of all lines"), (2, "FIRST of all lines"), (3, None), (4, "b")]
    table = docs(rows)
    kept = line_dedup.keep_first_lines(table)
    assert kept.schema.simpleString() == table.schema.simpleString()
    assert {(r.doc_id, r.text, r.ka) for r in kept.collect()} == {
        (1, "first of all lines", 7), (2, "", 7), (3, None, 7), (4, "b", 7),
    }


def test_no_python_in_the_plan(docs):
    table = docs([(1, "a")])
    plan = line_dedup.dedup_lines(table)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_no_rows(docs):
    assert found(docs([])) == []
    assert line_dedup.keep_first_lines(docs([]).withColumn("more", F.lit(1))).count() == 0
