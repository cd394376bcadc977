import random

import numpy as np
import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import Imputer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardlens.operators import evaluation, models, trees
from cardlens.operators.ranking import lower_medians
from cardlens.sources.star import transactions
from cardlens.operators.features import feature_table
from conftest import SMALL


def scored(spark, rows):
    return spark.createDataFrame(rows, "model string, is_fraud int, score double, prediction int")


def brute_areas(pairs):
    """ROC by all pairs of a positive and a negative; PR by every threshold."""
    ones = [s for y, s in pairs if y == 1]
    zeros = [s for y, s in pairs if y == 0]
    roc = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))
    points = []
    for t in sorted({s for _, s in pairs}, reverse=True):
        tp, fp = sum(s >= t for s in ones), sum(s >= t for s in zeros)
        points.append((tp / len(ones), tp / (tp + fp)))
    points = [(0.0, points[0][1]), *points]
    pr = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    return roc, pr


def test_areas_with_ties_and_groups(spark):
    random.seed(3)
    rows = [
        (m, random.choice([0, 0, 1]), float(random.randint(0, levels)), random.randint(0, 1))
        for m, levels in (("coarse", 4), ("fine", 1000))
        for _ in range(500)
    ]
    odd = [("fine", None, 3.0, 1), ("fine", 1, None, 1), ("fine", 0, float("nan"), 0), ("fine", 2, 1.0, 1)]
    found = {r["model"]: r for r in evaluation.classifier_scores(scored(spark, rows + odd)).collect()}
    for name in ("coarse", "fine"):
        roc, pr = brute_areas([(y, s) for m, y, s, _ in rows if m == name])
        assert found[name]["auc_roc"] == pytest.approx(roc, abs=1e-12)
        assert found[name]["auc_pr"] == pytest.approx(pr, abs=1e-12)
        part = scored(spark, [r for r in rows if r[0] == name]).withColumn("prediction", F.col("prediction").cast("double"))
        f1 = MulticlassClassificationEvaluator(labelCol="is_fraud", metricName="f1").evaluate(part)
        assert found[name]["f1"] == pytest.approx(f1, abs=1e-12)


def test_areas_agree_with_the_evaluator_without_bins(spark):
    random.seed(4)
    rows = [("m", random.randint(0, 1), round(random.random(), 2), 1) for _ in range(400)]
    df = scored(spark, rows)
    found = evaluation.classifier_scores(df).first()
    for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR")):
        exact = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="is_fraud", metricName=metric, numBins=0
        ).evaluate(df)
        assert found[name] == pytest.approx(exact, abs=1e-12)


def test_undefined_areas(spark):
    assert evaluation.classifier_scores(scored(spark, [])).count() == 0
    row = evaluation.classifier_scores(scored(spark, [("m", 1, 0.5, 1), ("m", 1, 0.7, 1)])).first()
    assert row["auc_roc"] is None and row["auc_pr"] == 1.0


def test_segment_quality_agrees_with_spark(spark):
    random.seed(5)
    rows = [[random.gauss(3 * (i % 3), 1), random.gauss(0, 1)] for i in range(300)]
    df = models.assemble(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    fitted = [models.KMeans(k=k, seed=1, maxIter=20).fit(df) for k in (2, 3, 5)]
    parts, expected = None, {}
    centres = []
    for k, model in zip((2, 3, 5), fitted):
        assigned = model.transform(df)
        expected[k] = (ClusteringEvaluator().evaluate(assigned), model.summary.trainingCost)
        centres += [(k, i, c.tolist()) for i, c in enumerate(model.clusterCenters())]
        long = assigned.select(
            F.lit(k).alias("k"), F.col("prediction").alias("segment"), vector_to_array("features").alias("x")
        )
        parts = long if parts is None else parts.unionByName(long)
    table = spark.createDataFrame(centres, "k int, segment int, centre array<double>")
    found = {r["k"]: r for r in evaluation.segment_quality(parts, 2, table).collect()}
    around = {r["k"]: r["wcss"] for r in evaluation.segment_quality(parts, 2).collect()}
    for k, (silhouette, cost) in expected.items():
        assert found[k]["silhouette"] == pytest.approx(silhouette, abs=1e-9)
        assert found[k]["wcss"] == pytest.approx(cost, rel=1e-9)
        assert around[k] <= cost + 1e-9


def test_a_row_alone_in_its_segment(spark):
    rows = [(2, 0, [0.0]), (2, 0, [1.0]), (2, 1, [9.0])]
    found = evaluation.segment_quality(spark.createDataFrame(rows, "k int, segment int, x array<double>"), 1).first()
    assert found["silhouette"] == pytest.approx((1 - 1 / 81 + 1 - 1 / 64) / 3)
    assert found["wcss"] == pytest.approx(0.5)


def test_exact_medians(spark):
    random.seed(6)
    rows = [
        (random.choice([None, float("nan"), random.random()]), random.choice([None, random.randint(0, 9)]), None)
        for _ in range(501)
    ]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    found = {r["column_name"]: r["median"] for r in lower_medians(df, ["a", "b", "c"]).collect()}
    known = sorted(a for a, _, _ in rows if a is not None and a == a)
    whole = sorted(b for _, b, _ in rows if b is not None)
    assert found == {"a": known[(len(known) - 1) // 2], "b": float(whole[(len(whole) - 1) // 2])}
    filled = models.impute_medians(df, ["a", "b", "c"])
    assert filled.dtypes == df.dtypes
    assert filled.where("a IS NULL OR isnan(a) OR b IS NULL").count() == 0
    assert filled.where("c IS NOT NULL").count() == 0
    small = Imputer(inputCols=["a"], outputCols=["a"], strategy="median", relativeError=0.0).fit(df)
    assert small.surrogateDF.first()["a"] == found["a"]


@pytest.fixture(scope="module")
def study(spark):
    settings = models.FraudSettings(trees=8, tree_depth=4, rounds=5, round_depth=3)
    return models.fit_fraud_models(feature_table(transactions(spark, SMALL)), settings)


def test_logistic_weights_are_optimal(spark, study):
    model = study.models["Logistic Regression"]
    rows = study.train.select("is_fraud", "class_weight", vector_to_array("features").alias("x"))
    found = models.logistic_check(study).collect()
    weights = [r["weight"] for r in found]
    # the fitted weights, taken from the table, give the model's probabilities
    x = np.array([r["x"] for r in rows.limit(200).collect()])
    mine = 1 / (1 + np.exp(-(x @ np.array(weights[:-1]) + weights[-1])))
    scored = model.transform(study.train.limit(200)).select(vector_to_array("probability")[1].alias("p")).collect()
    assert np.allclose(sorted(mine), sorted(r["p"] for r in scored), atol=1e-9)
    assert all(r["objective"] < r["zero"] for r in found)
    assert all(r["optimal"] == (r["objective"] < min(r["lower"], r["higher"], r["zero"])) for r in found)
    assert all(abs(r["gradient"]) < 0.05 * r["deviation"] for r in found if r["deviation"])


@pytest.mark.parametrize("name", ["Random Forest", "GBT"])
def test_importances_from_nodes_are_the_models(spark, study, name):
    model = study.models[name]
    nodes = trees.tree_nodes(model, models.FRAUD_FEATURES, spark)
    found = trees.importances(nodes, models.FRAUD_FEATURES, name, per_tree=name != "GBT")
    mine = {r["feature"]: r["importance"] for r in found.collect()}
    expected = dict(zip(models.FRAUD_FEATURES, model.featureImportances.toArray()))
    assert mine == pytest.approx(expected, abs=1e-9)
    assert sorted(r["place"] for r in found.collect()) == list(range(1, 13))


def test_leaves_add_up_to_the_training_rows(spark, study):
    n = study.train.count()
    nodes = trees.tree_nodes(study.models["GBT"], models.FRAUD_FEATURES, spark)
    leaves = nodes.where("left IS NULL").groupBy("tree").agg(F.sum("row_count").alias("n")).collect()
    assert len(leaves) == 5 and {r["n"] for r in leaves} == {n}
    inner = nodes.where("left IS NOT NULL")
    children = inner.select("tree", F.explode(F.array("left", "right")).alias("node"))
    assert children.join(nodes, ["tree", "node"]).count() == 2 * inner.count()
    forest = trees.tree_nodes(study.models["Random Forest"], models.FRAUD_FEATURES, spark)
    roots = forest.where("node = 0").select("row_count", "tree")
    sums = forest.where("left IS NULL").groupBy("tree").agg(F.sum("row_count").alias("n"))
    assert sums.join(roots, "tree").where("n <> row_count").count() == 0
