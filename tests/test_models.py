import pytest
from conftest import SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardlens.catalog.stored import built_features
from cardlens.operators import models

SETTINGS = models.FraudSettings(trees=10, tree_depth=4, rounds=3, round_depth=3)
FOREST = models.ForestSettings(trees=8, depth=4)


@pytest.fixture(scope="module")
def features(spark):
    return built_features(spark, SMALL)


@pytest.fixture(scope="module")
def study(features):
    return models.fit_fraud_models(features, SETTINGS)


def test_imputer_uses_the_lower_median(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (4, float("nan")), (None, None)], "a int, b double")
    filled = models.impute_medians(df, ["a", "b"])
    assert [r.a for r in filled.collect()] == [1, 2, 4, 2]
    assert [r.b for r in filled.collect()] == [1.0, 2.0, 1.0, 1.0]
    assert dict(filled.dtypes) == {"a": "int", "b": "double"}


def test_standardized_vectors(spark):
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(50)], "a double, b double")
    from pyspark.ml.functions import vector_to_array

    v = models.standardize_vectors(df, ["a", "b"]).select(vector_to_array("features").alias("f"))
    r = v.agg(F.avg(F.col("f")[0]), F.stddev(F.col("f")[0]), F.avg(F.col("f")[1]), F.stddev(F.col("f")[1])).first()
    assert list(r) == pytest.approx([0, 1, 0, 1], abs=1e-9)


def test_fraud_models_find_the_signal(study):
    scores = models.fraud_scores(study).collect()
    assert [r.model for r in scores] == ["Logistic Regression", "Random Forest", "GBT"]
    for r in scores:
        assert 0.5 < r.auc_roc <= 1 and 0 <= r.auc_pr <= 1 and 0 <= r.f1 <= 1
    best = models.best_by(models.fraud_scores(study), "model", "auc_roc").first()
    assert best.auc_roc == max(r.auc_roc for r in scores)


def test_confusion_counts_every_test_row(study):
    predictions = study.predictions("GBT")
    confusion = models.confusion_matrix(predictions, "is_fraud")
    assert confusion.agg(F.sum("n")).first()[0] == study.test.count()
    square = models.square_confusion_matrix(confusion, [0, 1])
    assert square.columns == ["actual", "0", "1"]


def test_classification_report(spark):
    cells = [(0, 0, 50), (0, 1, 10), (1, 0, 5), (1, 1, 35), (2, 0, 2)]
    confusion = spark.createDataFrame(cells, "actual int, predicted int, n bigint")
    report = {r.label: r for r in models.classification_report(confusion, {0: "zero", 1: "one"}).collect()}
    assert list(report) == ["zero", "one", "2", "accuracy", "macro avg", "weighted avg"]
    assert report["zero"].precision == pytest.approx(50 / 57)
    assert report["one"].recall == pytest.approx(35 / 40)
    assert (report["2"].precision, report["2"].recall, report["2"].f1) == (0.0, 0.0, 0.0)
    assert report["accuracy"].f1 == pytest.approx(85 / 102)
    assert report["macro avg"].recall == pytest.approx((50 / 60 + 35 / 40 + 0) / 3)
    assert report["weighted avg"].precision == pytest.approx((50 / 57 * 60 + 35 / 45 * 40) / 102)
    scores = models.category_scores(confusion).first()
    assert scores.accuracy == pytest.approx(85 / 102)


def test_importances_sum_to_one(study):
    ranked = models.feature_importances(study.models["Random Forest"], models.FRAUD_FEATURES, "fraud").collect()
    assert sum(r.importance for r in ranked) == pytest.approx(1)
    assert [r.place for r in ranked] == list(range(1, len(models.FRAUD_FEATURES) + 1))
    assert ranked[0].importance == max(r.importance for r in ranked)


def test_segments_cover_every_card(spark, features):
    vectors = models.segment_vectors(models.card_profiles(features))
    sweep = models.segment_sweep(vectors, range(2, 4))
    assert [r.k for r in sweep.collect()] == [2, 3]
    best = models.best_by(sweep, "k", "silhouette").first()["k"]
    segments = models.assign_segments(vectors, best)
    profiles = models.segment_profiles(segments).collect()
    assert len(profiles) == best
    assert sum(r.card_count for r in profiles) == vectors.count()


def test_card_profiles_take_the_first_transaction(spark):
    from conftest import at

    rows = [("c", "2", at(100), 1.0, 41, 1), ("c", "1", at(50), 3.0, 40, 0), ("lone", "3", at(1), 1.0, 30, 1)]
    df = spark.createDataFrame(
        rows,
        "card_id string, transaction_id string, transaction_ts timestamp_ntz, amount_log1p double, "
        "age bigint, gender_bin int",
    ).withColumns({c: F.lit(1) for c in ("tx_hour", "tx_is_weekend", "merch_dist_km", "city_pop", "is_fraud")})
    r, = models.card_profiles(df).collect()
    assert (r.card_id, r.age, r.gender_bin, r.avg_amount, r.tx_count) == ("c", 40, 0, 2.0, 2)


def test_only_the_model_asked_for_is_fitted(features, monkeypatch):
    fitted = []
    stored = models.stored_model
    monkeypatch.setattr(models, "stored_model", lambda m, s: fitted.append(type(m).__name__) or stored(m, s))
    study = models.fit_fraud_models(features, SETTINGS)
    assert list(study.models) == ["Logistic Regression", "Random Forest", "GBT"]
    study.predictions("Logistic Regression")
    study.predictions("Logistic Regression")
    assert fitted == ["LogisticRegressionModel"]
    with pytest.raises(KeyError):
        study.models["other"]


def test_fits_get_equal_tasks(spark):
    files = spark.range(40_000).select(F.col("id").alias("transaction_id")).coalesce(3)
    tasks = models.dealt(files)
    assert tasks.rdd.getNumPartitions() == 8
    sizes = [n for n in tasks.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 1.2 * 5_000


def test_category_and_amount_models(features):
    model, predictions = models.fit_category_model(features, FOREST)
    names = models.category_names(features)
    report = models.classification_report(models.confusion_matrix(predictions, "category_idx"), names)
    assert {r.label for r in report.collect()} >= {"accuracy", "macro avg", "weighted avg"}

    _, predicted = models.fit_amount_model(features, FOREST)
    own = models.regression_scores(predicted).first()
    from pyspark.ml.evaluation import RegressionEvaluator

    for metric in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="amount_log1p", metricName=metric).evaluate(predicted)
        assert own[metric] == pytest.approx(theirs)


def test_bounds_of_imputed_values_join_no_rows(spark, no_broadcast, monkeypatch):
    from cardlens.catalog.models import imputed_bounds

    lines = imputed_bounds(spark, SMALL)
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("transaction_id") == 0
    assert all(r.near_median and r.missing == 0 for r in lines.collect())
    right = models.impute_medians
    monkeypatch.setattr(
        models, "impute_medians", lambda df, c: right(df.withColumn("age", F.coalesce("age", F.max("age").over(Window.partitionBy()))), c)
    )
    assert {r.column_name for r in imputed_bounds(spark, SMALL).collect() if not r.near_median} == {"age"}
