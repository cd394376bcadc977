import random

import pytest
from pyspark.sql import functions as F

from cardlens.jobs import prepare as job
from cardlens.operators import quality
from cardlens.plans import layout
from cardlens.plans.report import summarize_plan
from cardlens.sources import columnar, delimited


def written(tmp_path, *lines, name="raw.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_quarantine_keeps_every_line(spark, tmp_path):
    path = written(
        tmp_path, "id,amount,name", "1,2.5,a", "2,x,b", "3,1.0", "4,2,c,d", "y,z,e", ",,", '5,1,"q,r"'
    )
    intake = delimited.quarantine(spark, path, str(tmp_path / "out"), "id BIGINT, amount DOUBLE, name STRING")
    kept = {tuple(r) for r in intake.kept.collect()}
    assert kept == {(1, 2.5, "a"), (None, None, None), (5, 1.0, "q,r")}
    rejected = {(r.reason, r.line) for r in intake.rejected.collect()}
    assert rejected == {
        ("amount", "2,x,b"),
        ("number of fields", "3,1.0"),
        ("number of fields", "4,2,c,d"),
        ("id,amount", "y,z,e"),
    }
    assert (intake.rows_kept, intake.rows_rejected) == (3, 4)


def test_quarantine_of_text_and_of_nothing(spark, tmp_path):
    path = written(tmp_path, "a,b", "1,2", "3")
    intake = delimited.quarantine(spark, path, str(tmp_path / "text"))
    assert intake.kept.dtypes == [("a", "string"), ("b", "string")]
    assert (intake.rows_kept, intake.rows_rejected) == (1, 1)
    empty = delimited.quarantine(
        spark, written(tmp_path, "a,b", name="empty.csv"), str(tmp_path / "none"), "a INT, b INT"
    )
    assert (empty.rows_kept, empty.rows_rejected) == (0, 0) and empty.kept.count() == 0


def raw(spark, tmp_path, name, ids):
    rows = [(f"t{i}", "2024-01-01 10:00:00", f"c{i % 3}", "m", str(10.0 * i), str(i % 2)) for i in ids]
    path = str(tmp_path / name)
    columns = "trans_num string, timestamp string, cc_num string, merchant string, amt string, class string"
    spark.createDataFrame(rows, columns).write.option("header", True).csv(path)
    return path


def test_audit_is_that_of_the_rows_written(spark, tmp_path):
    target = str(tmp_path / "out")
    found = job.run_audited(spark, raw(spark, tmp_path, "raw", range(250)), target)
    expected = quality.audit(columnar.read_parquet(spark, target)).first()
    assert found.audit(spark).first() == expected and found.rows == 250
    assert expected["high_amount"] == 149 and expected["non_positive_amount"] == 1


def test_audit_without_amount_and_label(spark, tmp_path):
    path = written(tmp_path, "trans_num,cc_num", "a,1", "b,2")
    found = job.run_audited(spark, path, str(tmp_path / "out"))
    assert found.counts["null_amount"] == 2 and found.counts["fraud_count"] == 0
    assert columnar.read_parquet(spark, str(tmp_path / "out")).columns == ["transaction_id", "card_id"]


def test_repeated_append_adds_nothing(spark, tmp_path):
    target = str(tmp_path / "out")
    some, more = raw(spark, tmp_path, "some", range(60)), raw(spark, tmp_path, "more", range(40, 100))
    runs = [job.run(spark, source, target, job.APPEND_NEW) for source in (some, more, more, some)]
    assert runs == [60, 40, 0, 0]
    stored = columnar.read_parquet(spark, target)
    assert stored.count() == 100 == stored.select("transaction_id").distinct().count()


@pytest.mark.parametrize("bits", [32768, 1 << 20])
def test_a_full_filter_drops_no_row(spark, bits):
    incoming = spark.range(0, 60000, 2).select(F.col("id").cast("string").alias("k")).union(
        spark.createDataFrame([(None,)], "k string")
    )
    stored = spark.range(0, 60000, 3).select(F.col("id").cast("string").alias("k"))
    new = columnar.new_rows(incoming, stored, "k", bits)
    assert {r.k for r in new.collect()} == {None} | {str(i) for i in range(0, 60000, 2) if i % 3}
    with_null = stored.union(spark.createDataFrame([(None,)], "k string"))
    assert columnar.new_rows(incoming, with_null, "k", bits).where("k IS NULL").count() == 0


def test_verified_write_catches_changes(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "b", 0.5), (3, None, 0.5), (3, None, 0.5)], "id long, name string, x double"
    )
    report = columnar.write_verified(df, str(tmp_path / "out"))
    assert {r.column_name: (r.values_written, r.matches) for r in report.collect()} == {
        "id": (4, True), "name": (2, True), "x": (3, True), columnar.WHOLE_ROW: (4, True),
    }
    digests = df.agg(*[c.alias(n) for n, c in columnar.content_digests(df).items()]).first().asDict()

    def bad(changed, name):
        path = str(tmp_path / name)
        changed.write.parquet(path)
        found = columnar.compare_content(spark, digests, df.columns, path).collect()
        return {r.column_name for r in found if not r.matches}

    assert bad(df.repartition(3).select("x", "name", "id"), "moved") == set()
    assert bad(df.withColumn("x", F.coalesce("x", F.lit(0.0))), "filled") == {"x", columnar.WHOLE_ROW}
    swapped = spark.createDataFrame(
        [(2, "a", None), (1, "b", 0.5), (3, None, 0.5), (3, None, 0.5)], df.schema
    )
    assert bad(swapped, "swapped") == {columnar.WHOLE_ROW}
    assert bad(df.dropDuplicates(), "lost") >= {"id", "x", columnar.WHOLE_ROW}
    assert bad(df.drop("x"), "narrow") == {*df.columns, columnar.WHOLE_ROW}


def test_only_heavy_keys_are_cut(spark):
    random.seed(1)
    rows = [(str(i), "hot" if i % 3 == 0 else f"k{random.randint(0, 400)}", float(i % 7)) for i in range(6000)]
    rows += [("n", None, 1.0)] * 900
    df = spark.createDataFrame(rows, "transaction_id string, k string, v double")
    found = {r.k: r for r in layout.heavy_key_totals(df, ["k"], "v", tasks=16).collect()}
    plain = {r.k: r for r in df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    assert {k: (r.tx_count, r.total) for k, r in found.items()} == {k: (r.n, r.s) for k, r in plain.items()}
    assert {k for k, r in found.items() if r.slices > 1} == {"hot", None}
    assert found["hot"].slices == -(-2000 * 16 * 2 // 6900)


def test_deduplicated_rows_are_not_shuffled_again(spark, no_broadcast):
    rows = spark.range(1000).select((F.col("id") % 50).cast("string").alias("k"), "id")
    incoming = rows.groupBy("k").agg(F.min("id").alias("id"))
    stored = rows.select("k").where("id < 20")
    new = columnar.new_rows(incoming, stored, "k")
    assert {r.k for r in new.collect()} == {str(i) for i in range(20, 50)}
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "coalesce(k" not in plan


def test_new_rows_shuffle_only_filtered_keys(spark, no_broadcast):
    incoming, stored = spark.range(10).select(F.col("id").alias("k")), spark.range(1000).select(F.col("id").alias("k"))
    new = columnar.new_rows(incoming, stored, "k")
    assert new.count() == 0
    assert summarize_plan(new).python_stages == 0
