"""Spark ML work: fraud classifiers, card segments, category classifier, amount regressor.

Only fitted models and metric rows reach the driver; predictions are always reduced first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import ceil
from threading import Lock
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.functions import measures as M
from cardlens.operators import evaluation
from cardlens.operators.joins import with_class_weight
from cardlens.operators.ranking import lower_medians
from cardlens.operators.sampling import split, stratified_split
from cardlens.operators.selection import rename_for_models
from cardlens.plans.layout import rebalance, reused
from cardlens.session import scratch_folder, settled

Result = TypeVar("Result")

# Model inputs, in vector order.
FRAUD_FEATURES = [
    "amount_log1p",
    "tx_hour",
    "tx_dow",
    "tx_month",
    "tx_is_weekend",
    "city_pop",
    "age",
    "merch_dist_km",
    "card_tx_count_1h",
    "card_amount_sum_1h",
    "gender_bin",
    "category_idx",
]
SEGMENT_FEATURES = [
    "tx_count",
    "avg_amount",
    "std_amount",
    "total_spend",
    "avg_tx_hour",
    "weekend_ratio",
    "avg_dist_km",
    "avg_city_pop",
    "gender_bin",
    "age",
]
CATEGORY_FEATURES = [
    "amount_log1p",
    "tx_hour",
    "tx_dow",
    "tx_is_weekend",
    "gender_bin",
    "age",
    "merch_dist_km",
    "city_pop",
]
AMOUNT_FEATURES = [
    "tx_hour",
    "tx_dow",
    "tx_month",
    "tx_is_weekend",
    "gender_bin",
    "age",
    "city_pop",
    "merch_dist_km",
    "category_idx",
    "card_tx_count_1h",
]
SEGMENT_MEASURES = [
    "tx_count",
    "avg_amount",
    "total_spend",
    "weekend_ratio",
    "avg_dist_km",
    "fraud_rate_pct",
    "age",
]
LABEL_NAMES = {0: "Legitimate", 1: "Fraud"}


# --- preparation -----------------------------------------------------------------------


def impute_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL and NaN replaced by the column's exact lower median; types stay.

    Only columns with a missing value are sorted for. A column without any known value keeps
    its NULLs.
    """
    kinds = dict(df.dtypes)
    known = {c: F.nanvl(c, F.lit(None)) if kinds[c] in ("double", "float") else F.col(c) for c in columns}
    missing = df.agg(*[F.bool_or(known[c].isNull()).alias(c) for c in columns]).first().asDict()
    lacking = [c for c in columns if missing[c]]
    if not lacking:
        return df
    medians = {r["column_name"]: r["median"] for r in lower_medians(df, lacking).collect()}
    return df.withColumns(
        {c: F.coalesce(known[c], F.lit(medians.get(c)).cast(kinds[c])) for c in lacking}
    )


def assemble(df: DataFrame, columns: list[str], invalid: str = "error") -> DataFrame:
    return VectorAssembler(
        inputCols=columns, outputCol="features", handleInvalid=invalid
    ).transform(df)


def standardize_vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    """``features`` with mean 0 and deviation 1 per column."""
    stages = [
        VectorAssembler(inputCols=columns, outputCol="raw_features"),
        StandardScaler(
            inputCol="raw_features", outputCol="features", withMean=True, withStd=True
        ),
    ]
    return Pipeline(stages=stages).fit(df).transform(df)


def fraud_vectors(features: DataFrame) -> DataFrame:
    """Feature table to id, label, class weight and vector."""
    return (
        rename_for_models(features)
        .select("transaction_id", "is_fraud", *FRAUD_FEATURES)
        .transform(impute_medians, FRAUD_FEATURES)
        .transform(with_class_weight)
        .transform(assemble, FRAUD_FEATURES)
        .select("transaction_id", "is_fraud", "class_weight", "features")
    )


# --- fraud classifiers -----------------------------------------------------------------


@dataclass(frozen=True)
class FraudSettings:
    iterations: int = 20
    regularization: float = 0.01
    trees: int = 100
    tree_depth: int = 8
    rounds: int = 50
    round_depth: int = 5
    seed: int = 42


def fraud_estimators(settings: FraudSettings) -> dict[str, object]:
    shared = dict(featuresCol="features", labelCol="is_fraud", weightCol="class_weight")
    return {
        "Logistic Regression": LogisticRegression(
            maxIter=settings.iterations, regParam=settings.regularization, **shared
        ),
        "Random Forest": RandomForestClassifier(
            numTrees=settings.trees, maxDepth=settings.tree_depth, seed=settings.seed, **shared
        ),
        "GBT": GBTClassifier(
            maxIter=settings.rounds, maxDepth=settings.round_depth, seed=settings.seed, **shared
        ),
    }


class FittedOnDemand(Mapping):
    """Models by name, each fitted when it is first asked for.

    A fit keeps its own form of the rows (a forest of 100 trees takes half a kilobyte for each),
    so one runs at a time, the rows themselves wait on disk, and nothing is fitted that is not
    asked for.
    """

    def __init__(self, estimators: dict[str, object], train: DataFrame) -> None:
        self._estimators, self._train = estimators, train
        self._fitted: dict[str, Model] = {}
        self._lock = Lock()

    def __getitem__(self, name: str) -> Model:
        estimator = self._estimators[name]
        with self._lock:
            if name not in self._fitted:
                with reused(dealt(self._train), StorageLevel.DISK_ONLY) as rows:
                    self._fitted[name] = stored_model(estimator.fit(rows), rows.sparkSession)
            return self._fitted[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._estimators)

    def __len__(self) -> int:
        return len(self._estimators)


@dataclass(frozen=True)
class FraudStudy:
    """Classifiers with the rows they have not seen."""

    models: Mapping[str, Model]
    test: DataFrame
    train: DataFrame | None = None

    def predictions(self, name: str) -> DataFrame:
        return self.models[name].transform(self.test)


def fit_fraud_models(
    features: DataFrame, settings: FraudSettings = FraudSettings()
) -> FraudStudy:
    """The three classifiers for a stratified 80 % of the rows, fitted when asked for.

    The vectors are stored once: fits and scores read them, not the features again.
    """
    train, test = stratified_split(settled(fraud_vectors(features)), seed=settings.seed)
    return FraudStudy(FittedOnDemand(fraud_estimators(settings), train), test, train)


#: Rows that are worth a task of a fit, and the most that a task should hold.
FIT_ROWS, MOST_FIT_ROWS = 5_000, 1_000_000


def dealt(rows: DataFrame, key: str = "transaction_id") -> DataFrame:
    """``rows`` in tasks of equal size: one for each core, or as many more as they need.

    A fit passes over its rows hundreds of times. With a task for each stored file, most cores
    wait for a last one in each pass; but every task of a forest also has statistics of all
    nodes, so more tasks than needed cost more than they spread.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n = rows.count()
    needed = cores * max(1, ceil(n / (cores * MOST_FIT_ROWS)))
    return rebalance(rows, max(1, min(needed, ceil(n / FIT_ROWS))), key)


def at_once(fits: list[Callable[[], Result]], parallelism: int = 3) -> list[Result]:
    """Independent fits submitted side by side, so that one fills the gaps of another's
    short iterations. Results keep the order of ``fits``."""
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(parallelism) as pool:
        return [task.result() for task in [pool.submit(in_session(fit)) for fit in fits]]


def stored_model(model: Model, spark: SparkSession) -> Model:
    """The model as read back from the shared folder, without its training summary.

    A summary refers to the session that made it, which cannot always be shipped to
    the executors with the model.
    """
    path = scratch_folder(spark, "model")
    model.save(path)
    return type(model).load(path)


def fraud_scores(study: FraudStudy) -> DataFrame:
    """``model, auc_roc, auc_pr, f1`` on the test rows: exact areas, one pass for each model."""
    scored = None
    for name in study.models:
        rows = study.predictions(name).select(
            F.lit(name).alias("model"),
            "is_fraud",
            vector_to_array("rawPrediction")[1].alias("score"),
            "prediction",
        )
        scored = rows if scored is None else scored.unionByName(rows)
    order = F.array_position(F.array(*map(F.lit, study.models)), F.col("model"))
    return settled(evaluation.classifier_scores(scored)).orderBy(order)


def logistic_check(study: FraudStudy, settings: FraudSettings = FraudSettings(), step: float = 0.05) -> DataFrame:
    """The logistic model's weights, and the objective around them on the training rows.

    ``feature, weight, deviation, gradient, objective, lower, higher`` for each input and the
    intercept: the objective as fitted, and with that weight alone moved down or up by ``step``
    deviations of its input; ``zero`` is the objective without any weights. Where ``lower`` or
    ``higher`` is below ``objective``, the iterations were not enough (``optimal`` is false).
    """
    model = study.models["Logistic Regression"]
    spark = study.test.sparkSession
    rows = study.train.select("is_fraud", "class_weight", vector_to_array("features").alias("x"))
    names, size = [*FRAUD_FEATURES, "intercept"], len(FRAUD_FEATURES)
    weights, intercept = model.coefficients.toArray().tolist(), float(model.intercept)
    spread = evaluation.column_deviations(rows, size, "class_weight").first()["deviations"]
    moves = [step / d if d else step for d in spread] + [step]
    tried = [("fitted", intercept, weights), ("zero", 0.0, [0.0] * size)]
    for i, name in enumerate(names):
        for side, sign in (("lower", -1), ("higher", 1)):
            moved = [*weights, intercept]
            moved[i] += sign * moves[i]
            tried.append((f"{side} {name}", moved[-1], moved[:-1]))
    found = settled(evaluation.logistic_objective(rows, tried, size, settings.regularization))
    value = {r["name"]: r["objective"] for r in found.select("name", "objective").collect()}
    slopes = found.where("name = 'fitted'").first()["gradient"]
    lines = [
        (n, w, d, g, value["fitted"], value[f"lower {n}"], value[f"higher {n}"], value["zero"])
        for n, w, d, g in zip(names, [*weights, intercept], [*spread, 1.0], slopes)
    ]
    table = spark.createDataFrame(
        lines,
        "feature string, weight double, deviation double, gradient double, objective double,"
        " lower double, higher double, zero double",
    )
    return table.withColumn("optimal", F.col("objective") < F.least("lower", "higher", "zero"))


def best_by(scores: DataFrame, item: str, score: str) -> DataFrame:
    """The item with the highest score; the smaller item wins a tie."""
    return scores.orderBy(F.desc(score), item).limit(1).select(item, score)


# --- reports on predictions ------------------------------------------------------------


def confusion_matrix(predictions: DataFrame, label: str) -> DataFrame:
    """``actual, predicted, n``. A count per pair; rows stay on the executors."""
    return predictions.groupBy(
        F.col(label).cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted")
    ).agg(M.rows("n"))


def square_confusion_matrix(confusion: DataFrame, classes: list[int]) -> DataFrame:
    return (
        confusion.groupBy("actual")
        .pivot("predicted", classes)
        .agg(F.sum("n"))
        .na.fill(0)
        .orderBy("actual")
    )


def classification_report(
    confusion: DataFrame, names: DataFrame | dict[int, str] | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    ``names`` maps class numbers to display names: a dictionary, or a table
    ``class, label``. An undefined ratio is 0.
    """
    cells = settled(confusion)  # the fit behind it must not run once for each branch
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    actual = cells.groupBy(F.col("actual").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(hit).alias("hits")
    )
    predicted = cells.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("claimed"))
    per_class = (
        actual.join(predicted, "class", "full")
        .na.fill(0, ["support", "hits", "claimed"])
        .withColumns(
            {
                "precision": _ratio("hits", "claimed"),
                "recall": _ratio("hits", "support"),
            }
        )
        .withColumn(
            "f1",
            _or_zero(
                F.try_divide(
                    2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
                )
            ),
        )
    )
    spark = confusion.sparkSession
    if isinstance(names, dict):
        names = spark.createDataFrame(list(names.items()), "class int, label string")
    named = per_class if names is None else per_class.join(names, "class", "left")
    label = F.col("class").cast("string")
    if names is not None:
        label = F.coalesce("label", label)

    scores = ("precision", "recall", "f1")
    classes = named.select(
        F.lit(0).alias("section"), "class", label.alias("label"), *scores, "support"
    )
    total = F.sum("support")
    nothing = F.lit(None)
    accuracy = per_class.agg(
        nothing.cast("double").alias("precision"),
        nothing.cast("double").alias("recall"),
        F.try_divide(F.sum("hits"), total).alias("f1"),
        total.alias("support"),
    )
    macro = per_class.agg(*[F.avg(s).alias(s) for s in scores], total.alias("support"))
    weighted = per_class.agg(
        *[F.try_divide(F.sum(F.col(s) * F.col("support")), total).alias(s) for s in scores],
        total.alias("support"),
    )
    report = classes
    for section, (title, means) in enumerate(
        (("accuracy", accuracy), ("macro avg", macro), ("weighted avg", weighted)), start=1
    ):
        report = report.unionByName(
            means.select(
                F.lit(section).alias("section"),
                nothing.cast("int").alias("class"),
                F.lit(title).alias("label"),
                *scores,
                "support",
            )
        )
    return report.orderBy("section", "class").drop("section", "class")


def _ratio(part: str, whole: str) -> Column:
    return _or_zero(F.try_divide(F.col(part), F.col(whole)))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def feature_importances(model: Model, features: list[str], name: str) -> DataFrame:
    """``model, feature, importance, place``; one row per model input."""
    weights = model.featureImportances.toArray()
    ranked = sorted(zip(features, weights), key=lambda pair: (-pair[1], pair[0]))
    lines = [(name, f, float(w), place) for place, (f, w) in enumerate(ranked, start=1)]
    return SparkSession.active().createDataFrame(
        lines, "model string, feature string, importance double, place int"
    )


# --- card segments ---------------------------------------------------------------------


def card_profiles(features: DataFrame) -> DataFrame:
    """One row per card with 11 measures; cards with an unknown measure are dropped,
    among them cards with a single transaction (no deviation).

    Gender and age are those of the card's first transaction.
    """
    df = rename_for_models(features)
    measures = df.groupBy("card_id").agg(
        M.rows(),
        M.mean_of("amount_log1p", "avg_amount", 2),
        F.round(F.stddev_samp("amount_log1p"), 2).alias("std_amount"),
        M.sum_of("amount_log1p", "total_spend", 2),
        M.mean_of("tx_hour", "avg_tx_hour", 2),
        M.mean_of("tx_is_weekend", "weekend_ratio", 3),
        M.mean_of("merch_dist_km", "avg_dist_km", 2),
        M.mean_of("city_pop", "avg_city_pop", 0),
        M.fraud_rate_pct(digits=3),
    )
    # On its own, as its buffer holds text: all measures would be sorted along with it.
    first = F.struct("transaction_ts", "transaction_id")
    opening = df.groupBy("card_id").agg(
        F.min_by(F.struct("gender_bin", "age"), first).alias("person")
    )
    own = F.col("card_id").eqNullSafe(F.col("opening_card"))
    people = opening.select(F.col("card_id").alias("opening_card"), "person.gender_bin", "person.age")
    return measures.join(people, own).drop("opening_card").dropna()


def segment_vectors(profiles: DataFrame) -> DataFrame:
    """Profiles with their standardised vector. The profiles are computed once: imputer,
    scaler and every K-Means iteration read them."""
    return settled(profiles).transform(impute_medians, SEGMENT_FEATURES).transform(
        standardize_vectors, SEGMENT_FEATURES
    )


def segment_sweep(
    vectors: DataFrame, ks: range = range(2, 8), seed: int = 42, max_iter: int = 30
) -> DataFrame:
    """``k, silhouette, wcss`` for every number of segments tried.

    The fits run side by side; all their assignments are judged together, in one aggregate and
    one pass over the rows.
    """
    spark, size = vectors.sparkSession, len(SEGMENT_FEATURES)
    with reused(vectors.select("features"), StorageLevel.MEMORY_AND_DISK) as rows:
        rows.count()
        fitted = at_once(
            [
                lambda k=k: KMeans(
                    featuresCol="features", predictionCol=f"s{k}", k=k, seed=seed, maxIter=max_iter
                ).fit(rows)
                for k in ks
            ]
        )
        assigned = rows
        for model in fitted:
            assigned = model.transform(assigned)
        pairs = [F.struct(F.lit(k).alias("k"), F.col(f"s{k}").alias("segment")) for k in ks]
        assigned = assigned.select(vector_to_array("features").alias("x"), F.inline(F.array(*pairs)))
        centres = spark.createDataFrame(
            [
                (k, segment, centre.tolist())
                for k, model in zip(ks, fitted)
                for segment, centre in enumerate(model.clusterCenters())
            ],
            "k int, segment int, centre array<double>",
        )
        return settled(evaluation.segment_quality(assigned, size, centres)).orderBy("k")


def assign_segments(
    vectors: DataFrame, k: int, seed: int = 42, max_iter: int = 50
) -> DataFrame:
    with reused(vectors, StorageLevel.MEMORY_AND_DISK) as rows:
        model = KMeans(featuresCol="features", k=k, seed=seed, maxIter=max_iter).fit(rows)
    return model.transform(vectors)


def segment_profiles(segments: DataFrame) -> DataFrame:
    """Size and mean measures of each segment."""
    return (
        segments.groupBy("prediction")
        .agg(M.rows("card_count"), *[M.mean_of(c, c, 2) for c in SEGMENT_MEASURES])
        .orderBy("prediction")
    )


# --- category classifier and amount regressor ------------------------------------------


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 80
    depth: int = 6
    seed: int = 42


def _vectors(features: DataFrame, inputs: list[str], label: str) -> DataFrame:
    needed = dict.fromkeys(["transaction_id", label, *inputs])
    return (
        rename_for_models(features)
        .select(*needed)
        .transform(impute_medians, inputs)
        .transform(assemble, inputs)
        .select("transaction_id", label, "features")
    )


def fit_category_model(
    features: DataFrame, settings: ForestSettings = ForestSettings()
) -> tuple[Model, DataFrame]:
    """Random forest for the category index, and its predictions on the held-out 20 %."""
    vectors = settled(_vectors(features, CATEGORY_FEATURES, "category_idx"))
    train, test = split(vectors, seed=settings.seed)
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="category_idx",
        numTrees=settings.trees,
        maxDepth=settings.depth,
        seed=settings.seed,
    )
    with reused(dealt(train), StorageLevel.DISK_ONLY) as rows:
        model = forest.fit(rows)
    return model, model.transform(test)


def category_scores(confusion: DataFrame) -> DataFrame:
    """Accuracy and weighted F1 of a confusion matrix."""
    report = classification_report(confusion)
    return report.agg(
        F.max(F.when(F.col("label") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("label") == "weighted avg", F.col("f1"))).alias("f1"),
    )


def category_names(features: DataFrame) -> DataFrame:
    """``class, label`` of the category index."""
    return (
        rename_for_models(features)
        .where(F.col("category").isNotNull())
        .select(F.col("category_idx").cast("int").alias("class"), F.col("category").alias("label"))
        .distinct()
    )


def fit_amount_model(
    features: DataFrame, settings: ForestSettings = ForestSettings()
) -> tuple[Model, DataFrame]:
    """Random forest for the log amount, and its predictions on the held-out 20 %."""
    vectors = settled(_vectors(features, AMOUNT_FEATURES, "amount_log1p"))
    train, test = split(vectors, seed=settings.seed)
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="amount_log1p",
        numTrees=settings.trees,
        maxDepth=settings.depth,
        seed=settings.seed,
    )
    with reused(dealt(train), StorageLevel.DISK_ONLY) as rows:
        model = forest.fit(rows)
    return model, model.transform(test)


def regression_scores(predictions: DataFrame, label: str = "amount_log1p") -> DataFrame:
    """RMSE, MAE and R² in one pass."""
    miss = F.col(label) - F.col("prediction")
    return predictions.agg(
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
        (1 - F.try_divide(F.avg(miss * miss), F.var_pop(label))).alias("r2"),
    )
