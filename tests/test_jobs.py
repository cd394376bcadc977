import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from cardlens.jobs import features as features_job
from cardlens.jobs import models as models_job
from cardlens.jobs import reports as reports_job
from cardlens.operators.models import ForestSettings, FraudSettings
from cardlens.sources.star import transactions


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("jobs") / "features")
    rows = features_job.build(transactions(spark, SMALL), path)
    assert rows == spark.read.parquet(path).count() == transactions(spark, SMALL).count()
    return path


def test_every_report_is_written(spark, features, tmp_path):
    names = reports_job.run(spark, features, str(tmp_path))
    assert names == list(reports_job.REPORTS)
    for name in names:
        # The smallest table has no merchant with 50 transactions.
        assert spark.read.parquet(f"{tmp_path}/{name}").count() > 0 or "merchant" in name, name


def test_reports_on_features_equal_reports_on_transactions(spark, features, tmp_path):
    reports_job.run(spark, features, str(tmp_path), ["amount_tier_risk"])
    stored = spark.read.parquet(f"{tmp_path}/amount_tier_risk")
    direct = reports_job.REPORTS["amount_tier_risk"](transactions(spark, SMALL))
    # The features keep the logarithm, so amounts come back up to rounding.
    columns = ["amount_tier", "total", "fraud"]
    assert sorted(map(tuple, stored.select(columns).collect())) == sorted(
        map(tuple, direct.select(columns).collect())
    )


@pytest.mark.parametrize("column", sorted({c for needs in reports_job.NEEDS.values() for c in needs}))
def test_reports_left_out_for_each_absent_column(spark, features, column):
    lacking = reports_job.available(spark.read.parquet(features).drop(column))
    whole = reports_job.available(spark.read.parquet(features).withColumn("amount", F.lit(1.0)))
    assert whole == list(reports_job.REPORTS)
    assert set(lacking) <= {n for n in reports_job.REPORTS if column not in reports_job.NEEDS[n]}


def test_reports_without_many_columns(spark, features, tmp_path):
    source, target = str(tmp_path / "narrow"), str(tmp_path / "reports")
    lacking = ("merchant", "card_id", "transaction_ts", "gender", "state", "category", "cardholder_age")
    spark.read.parquet(features).drop(*lacking).write.parquet(source)
    names = reports_job.run(spark, source, target)
    assert {"class_balance", "amount_by_label", "distance", "null_report"} <= set(names)
    for name in names:
        assert not set(reports_job.NEEDS[name]) & set(lacking)
        assert spark.read.parquet(f"{target}/{name}").columns


def test_empty_tables_give_empty_reports(spark, tmp_path):
    path = str(tmp_path / "none")
    assert features_job.build(transactions(spark, SMALL).limit(0), path) == 0
    names = reports_job.run(spark, path, str(tmp_path / "reports"))
    assert names == list(reports_job.REPORTS)
    read = {n: spark.read.parquet(f"{tmp_path}/reports/{n}") for n in names}
    assert read["categories"].count() == 0
    assert read["kpis"].first()["total_tx"] == 0
    # Fixed bands are listed even when nothing falls into them.
    assert read["age"].count() == 6


def test_model_job(spark, features, tmp_path):
    small = FraudSettings(trees=5, tree_depth=3, rounds=2, round_depth=2)
    names = models_job.run(spark, features, str(tmp_path), small, ForestSettings(trees=4, depth=3))
    for name in names:
        assert spark.read.parquet(f"{tmp_path}/{name}").count() > 0, name


def test_jobs_leave_no_scratch_behind(spark, features, tmp_path):
    from cardlens import session

    before = set(session._scratch)
    reports_job.run(spark, features, str(tmp_path), ["amount_by_label", "iqr_outliers"])
    assert session._scratch == before
    made = set(os.listdir(session.shared_folder(spark)))
    with session.scratch_released(spark):
        session.settled(spark.range(3)).count()
        assert set(os.listdir(session.shared_folder(spark))) - made
    assert set(os.listdir(session.shared_folder(spark))) == made
