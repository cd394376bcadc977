import pytest
from pyspark.sql import functions as F

from cardlens.jobs import features as features_job
from cardlens.jobs import prepare as job
from cardlens.operators import prepare
from cardlens.sources import columnar, delimited

# A minimal raw file: one repeated id, one negative amount, both labels.
SAMPLE = """trans_num,trans_date_trans_time,cc_num,merchant,amt,class
p-17,2023-06-30 23:59:58,4000123,Bakery,3.2,1
p-18,2023-07-01 00:00:00,4000777,Harbour Tickets,81.04,0
p-18,2023-07-01 00:00:00,4000777,Harbour Tickets,81.04,0
p-19,2023-07-01 08:15:30,4000123,Bakery,-12.6,0
"""


@pytest.fixture
def sample(tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(SAMPLE)
    return str(path)


def texts(df, column):
    return [r[0] for r in df.select(F.col(column).cast("string")).collect()]


def test_job_on_minimal_file(spark, sample, tmp_path):
    target = str(tmp_path / "out")
    assert job.run(spark, sample, target) == 2
    stored = spark.read.parquet(target)
    assert stored.columns == list(prepare.CANONICAL_ORDER)
    rows = stored.orderBy("transaction_id").select(
        "transaction_id",
        F.col("transaction_ts").cast("string"),
        "card_id",
        "merchant",
        "amount",
        "is_fraud",
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("p-17", "2023-06-30 23:59:58", "4000123", "Bakery", 3.2, 1),
        ("p-18", "2023-07-01 00:00:00", "4000777", "Harbour Tickets", 81.04, 0),
    ]


@pytest.mark.parametrize(
    "mode, stored", [("overwrite", 2), ("append", 4), ("ignore", 2)]
)
def test_job_write_modes(spark, sample, tmp_path, mode, stored):
    target = str(tmp_path / "out")
    job.run(spark, sample, target)
    assert job.run(spark, sample, target, mode) == (0 if mode == "ignore" else 2)
    assert spark.read.parquet(target).count() == stored


def test_job_command_line(spark, sample, tmp_path, capsys):
    job.main(["--input", sample, "--output", str(tmp_path / "out"), "--mode", "append"])
    assert "Prepared rows: 2" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        job.main(["--input", sample, "--output", "x", "--mode", "replace"])


def test_job_refuses_existing_target(spark, sample, tmp_path):
    target = str(tmp_path / "out")
    job.run(spark, sample, target)
    with pytest.raises(Exception, match="already exists"):
        job.run(spark, sample, target, "error")
    with pytest.raises(ValueError):
        columnar.write_parquet(spark.range(1), target, "replace")


def test_feature_job_round_trip(spark, sample, tmp_path):
    prepared, target = str(tmp_path / "prepared"), str(tmp_path / "features")
    job.run(spark, sample, prepared)
    assert features_job.run(spark, prepared, target) == 2
    written = spark.read.parquet(target)
    report = columnar.round_trip_report(written, target).first()
    assert report["matches"] and report["rows_stored"] == 2
    # The source has no places, birth dates or categories: those features are left out.
    assert "merch_distance_km" not in written.columns
    assert "merchant_fraud_rate" in written.columns


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Unnamed: 0", "  A--b ", "__Ü x__"])
    assert prepare.normalize_headers(df).columns == ["unnamed_0", "a_b", "x"]


def test_header_clash_is_reported(spark):
    df = spark.createDataFrame([(1, 2)], ["A b", "a_b"])
    with pytest.raises(ValueError, match="a_b"):
        prepare.normalize_headers(df)


def test_first_alias_wins_and_targets_stay(spark):
    df = spark.createDataFrame([tuple("abcde")], ["date", "timestamp", "class", "is_fraud", "amt"])
    assert prepare.rename_aliases(df).columns == [
        "date",
        "transaction_ts",
        "class",
        "is_fraud",
        "amount",
    ]


def test_timestamp_layouts(spark):
    given = [
        "2024-01-01 10:00:00",
        "01/15/2024 10:30",
        "15-01-2024 10:30:00",
        "garbage",
        None,
    ]
    df = spark.createDataFrame([(t,) for t in given], "transaction_ts string")
    assert texts(prepare.type_columns(df), "transaction_ts") == [
        "2024-01-01 10:00:00",
        "2024-01-15 10:30:00",
        "2024-01-15 10:30:00",
        None,
        None,
    ]


def test_relative_seconds_are_cut(spark):
    df = spark.createDataFrame([("12.9",), ("x",), (None,)], "time string")
    typed = prepare.type_columns(df)
    assert texts(typed, "transaction_ts") == ["1970-01-01 00:00:12", None, None]


def test_labels_and_amounts(spark):
    df = spark.createDataFrame(
        [("0", "0"), ("1", "-0.01"), ("1.0", "NaN"), ("2", "abc"), ("x", None), (None, "5")],
        "is_fraud string, amount string",
    )
    typed = prepare.type_columns(df)
    assert [r.is_fraud for r in typed.collect()] == [0, 1, 1, 2, None, None]
    assert texts(prepare.keep_valid_amounts(typed), "amount") == ["0.0", "NaN", "5.0"]
    assert [r.is_fraud for r in prepare.keep_known_labels(typed).collect()] == [0, 1, 1]


def test_content_id_depends_on_values_not_column_order(spark):
    one = spark.createDataFrame([("x", None, 1)], "b string, a string, c int")
    two = one.select("c", "b", "a")
    ids = [prepare.ensure_transaction_id(d).first()["transaction_id"] for d in (one, two)]
    import hashlib

    assert ids[0] == ids[1] == hashlib.sha256(b"||x||1").hexdigest()


def test_deduplicate_keeps_smallest_row(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "m"), ("b", None, "k")],
        "transaction_id string, amount int, merchant string",
    )
    kept = {tuple(r) for r in prepare.deduplicate(df.repartition(4)).collect()}
    assert kept == {("a", 1, "y"), (None, 4, "m"), ("b", None, "k")}
    assert prepare.deduplicate(df.select("merchant").union(df.select("merchant"))).count() == 6


def test_malformed_rows_are_dropped_and_counted_alike(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b,c\n1,2,3\n1,2\n1,2,3,4\nx,2,3\n")
    text = delimited.read_text_csv(spark, str(path))
    assert text.count() == len(text.collect()) == 2
    typed = delimited.read_typed_csv(spark, str(path), "a INT, b INT, c INT")
    assert typed.count() == len(typed.collect()) == 1


def test_csv_folder_reads_only_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("x,y\n3,4\n")
    (tmp_path / "c.txt").write_text("x,y\n5,6\n")
    rows = delimited.read_csv_folder(spark, str(tmp_path)).collect()
    assert sorted(r.x for r in rows) == ["1", "3"]


def test_restore_amount(spark):
    df = spark.createDataFrame([(0.0,), (18.75,)], "amount double")
    stored = df.select(F.log1p("amount").alias("amount_log1p"))
    assert [r.amount for r in columnar.restore_amount(stored).collect()] == pytest.approx([0, 18.75])
    assert columnar.restore_amount(df).columns == ["amount"]
