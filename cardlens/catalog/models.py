"""Spark ML queries at the operators' default sizes.

One fit per session and state of the source files serves all queries on a model. SQL cannot
repeat a fit; beside each such query stands one that SQL can check: the same operator on
predictions made by a rule, or what must hold for any fit.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.catalog.registry import query, rounded
from cardlens.catalog.sql import CARD_PROFILES, on_features, on_tx
from cardlens.catalog.stored import built_features, once, stored_transactions
from cardlens.operators import evaluation, models, portfolio, trees
from cardlens.operators.joins import with_class_weight
from cardlens.operators.ranking import lower_medians, running_counts, value_counts
from cardlens.session import settled


def _fraud(spark: SparkSession, folder: str) -> models.FraudStudy:
    return once(spark, folder, "fraud", lambda: models.fit_fraud_models(built_features(spark, folder)))


def _category(spark: SparkSession, folder: str):
    return once(
        spark, folder, "category", lambda: models.fit_category_model(built_features(spark, folder))
    )


def _amount(spark: SparkSession, folder: str):
    return once(spark, folder, "amount", lambda: models.fit_amount_model(built_features(spark, folder)))


def _cards(spark: SparkSession, folder: str) -> DataFrame:
    """Card vectors; their profiles are stored by the operator."""
    return once(
        spark,
        folder,
        "cards",
        lambda: models.segment_vectors(models.card_profiles(built_features(spark, folder))),
    )


def _sweep(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "sweep", lambda: models.segment_sweep(_cards(spark, folder)))


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    def make():
        best = models.best_by(_sweep(spark, folder), "k", "silhouette").first()["k"]
        return models.assign_segments(_cards(spark, folder), best)

    return once(spark, folder, "segments", make)


@query("ml_01_imputed")
def imputed(spark, folder):
    features = models.rename_for_models(built_features(spark, folder))
    return models.impute_medians(
        features.select("transaction_id", *models.FRAUD_FEATURES), models.FRAUD_FEATURES
    )


_MEDIAN_INPUTS = ("amount_log1p", "city_pop", "cardholder_age", "merch_distance_km")


@query(
    "ml_01_medians",
    on_features(
        ", long AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM fx WHERE {c} IS NOT NULL"
            for c in _MEDIAN_INPUTS
        )
        + """), placed AS (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value) AS place,
         count(*) OVER (PARTITION BY column_name) AS n FROM long)
SELECT column_name, round(value, 6) AS median FROM placed WHERE place = (n + 1) // 2"""
    ),
)
def medians(spark, folder):
    """Exact lower medians, two of columns that hold missing values."""
    features = models.rename_for_models(built_features(spark, folder))
    back = {"age": "cardholder_age", "merch_dist_km": "merch_distance_km"}
    known = features.withColumnsRenamed({n: c for n, c in back.items() if n in features.columns})
    return rounded(lower_medians(known, list(_MEDIAN_INPUTS)))


def _entries(vectors: DataFrame, key: str, size: int) -> DataFrame:
    """The vector as columns ``x0, x1, ...``."""
    entries = vector_to_array("features")
    return vectors.select(key, *[F.round(entries[i], 6).alias(f"x{i}") for i in range(size)])


_CATEGORY_INPUTS = (
    "amount_log1p",
    "tx_hour",
    "tx_day_of_week",
    "tx_is_weekend",
    "gender_encoded",
    "cardholder_age",
    "merch_distance_km",
    "city_pop",
)


@query(
    "ml_02_assembled",
    on_features(
        "SELECT transaction_id, "
        + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS x{i}" for i, c in enumerate(_CATEGORY_INPUTS))
        + " FROM fx WHERE cardholder_age IS NOT NULL AND merch_distance_km IS NOT NULL"
    ),
)
def assembled(spark, folder):
    """Vectors of the complete rows; rows with a missing input are skipped."""
    features = models.rename_for_models(built_features(spark, folder))
    inputs = features.select("transaction_id", *models.CATEGORY_FEATURES)
    vectors = models.assemble(inputs, models.CATEGORY_FEATURES, "skip")
    return _entries(vectors, "transaction_id", len(models.CATEGORY_FEATURES))


@query(
    "ml_03_standardized",
    on_features(
        CARD_PROFILES
        + "SELECT card_id, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS x{i}"
            for i, c in enumerate(models.SEGMENT_FEATURES)
        )
        + " FROM complete"
    ),
)
def standardized(spark, folder):
    return _entries(_cards(spark, folder), "card_id", len(models.SEGMENT_FEATURES))


def _scored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return (
        _fraud(spark, folder)
        .predictions(name)
        .select(
            "transaction_id",
            "is_fraud",
            vector_to_array("probability")[1].alias("fraud_probability"),
            F.col("prediction").cast("int").alias("prediction"),
        )
    )


@query("ml_04_logistic_regression")
def logistic_regression(spark, folder):
    return _scored(spark, folder, "Logistic Regression")


@query("ml_05_random_forest")
def random_forest(spark, folder):
    return _scored(spark, folder, "Random Forest")


@query("ml_06_boosted_trees")
def boosted_trees(spark, folder):
    return _scored(spark, folder, "GBT")


@query("ml_07_fraud_scores")
def fraud_scores(spark, folder):
    return once(spark, folder, "scores", lambda: models.fraud_scores(_fraud(spark, folder)))


@query("srt_03_best_model")
def best_model(spark, folder):
    return models.best_by(fraud_scores(spark, folder), "model", "auc_roc")


@query("ml_08_confusion_matrix")
def confusion_matrix(spark, folder):
    predictions = _fraud(spark, folder).predictions("GBT")
    return models.square_confusion_matrix(models.confusion_matrix(predictions, "is_fraud"), [0, 1])


@query("ml_09_fraud_report")
def fraud_report(spark, folder):
    predictions = _fraud(spark, folder).predictions("GBT")
    confusion = models.confusion_matrix(predictions, "is_fraud")
    return models.classification_report(confusion, models.LABEL_NAMES)


@query("ml_10_feature_importances")
def feature_importances(spark, folder):
    """From the tables of nodes: weighted gains, each tree counting the same."""
    category, _ = _category(spark, folder)
    amount, _ = _amount(spark, folder)
    lines = trees.importances(_forest_nodes(spark, folder), models.FRAUD_FEATURES, "fraud")
    for model, inputs, name in (
        (category, models.CATEGORY_FEATURES, "category"),
        (amount, models.AMOUNT_FEATURES, "amount"),
    ):
        nodes = trees.tree_nodes(model, inputs, spark)
        lines = lines.unionByName(trees.importances(nodes, inputs, name))
    return lines


def _forest_nodes(spark, folder) -> DataFrame:
    forest = _fraud(spark, folder).models["Random Forest"]
    return trees.tree_nodes(forest, models.FRAUD_FEATURES, spark)


@query("ml_05_random_forest_nodes")
def random_forest_nodes(spark, folder):
    return _forest_nodes(spark, folder)


@query("ml_06_boosted_tree_nodes")
def boosted_tree_nodes(spark, folder):
    return trees.tree_nodes(_fraud(spark, folder).models["GBT"], models.FRAUD_FEATURES, spark)


@query("ml_06_boosted_tree_importances")
def boosted_tree_importances(spark, folder):
    nodes = boosted_tree_nodes(spark, folder)
    return trees.importances(nodes, models.FRAUD_FEATURES, "boosted", per_tree=False)


@query("ml_04_weights")
def logistic_weights(spark, folder):
    """The fitted weights, and whether the objective rises on both sides of each."""
    return once(spark, folder, "weights", lambda: models.logistic_check(_fraud(spark, folder)))


@query("ml_11_segment_sweep")
def segment_sweep(spark, folder):
    return _sweep(spark, folder)


@query("srt_03_best_segment_count")
def best_segment_count(spark, folder):
    return models.best_by(_sweep(spark, folder), "k", "silhouette")


@query("ml_12_segments")
def segments(spark, folder):
    return _segments(spark, folder).select("card_id", "prediction")


@query("agg_27_segment_profiles")
def segment_profiles(spark, folder):
    return models.segment_profiles(_segments(spark, folder))


@query("agg_56_segment_exposure")
def segment_exposure(spark, folder):
    profiles = models.segment_profiles(_segments(spark, folder))
    return rounded(portfolio.segment_exposure(profiles))


@query("ml_13_category_report")
def category_report(spark, folder):
    _, predictions = _category(spark, folder)
    confusion = models.confusion_matrix(predictions, "category_idx")
    names = models.category_names(built_features(spark, folder))
    return models.classification_report(confusion, names)


@query("ml_13_category_scores")
def category_scores(spark, folder):
    _, predictions = _category(spark, folder)
    return models.category_scores(models.confusion_matrix(predictions, "category_idx"))


@query("ml_14_amount_scores")
def amount_scores(spark, folder):
    _, predictions = _amount(spark, folder)
    return models.regression_scores(predictions)


# --- what SQL can check ------------------------------------------------------------------


def _report_sql(cells: str) -> str:
    """Scores of the classes in ``cells`` (actual, predicted, n)."""
    return f"""{cells},
classes AS (SELECT actual AS class FROM cells UNION SELECT predicted FROM cells),
parts AS (
  SELECT class, coalesce((SELECT sum(n) FROM cells WHERE actual = class), 0) AS support,
         coalesce((SELECT sum(n) FROM cells WHERE predicted = class), 0) AS claimed,
         coalesce((SELECT sum(n) FROM cells WHERE predicted = class AND actual = class), 0) AS hits
  FROM classes),
ratios AS (
  SELECT class, support, hits, coalesce(hits::DOUBLE / nullif(claimed, 0), 0) AS p,
         coalesce(hits::DOUBLE / nullif(support, 0), 0) AS r FROM parts),
scores AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM ratios)
"""


_RULE = "CAST(amount > 150 OR CAST(transaction_id AS BIGINT) % 5 = 0 AS INT)"
_RULE_CELLS = f""", cells AS (
  SELECT CAST(is_fraud AS INT) AS actual, {_RULE} AS predicted, count(*) AS n FROM tx GROUP BY ALL)"""


def _ruled(spark, folder) -> DataFrame:
    """Transactions with a prediction made by a rule."""
    large = (F.col("amount") > 150) | (F.col("transaction_id").cast("bigint") % 5 == 0)
    return stored_transactions(spark, folder).withColumn("prediction", large.cast("int"))


@query(
    "ml_08_rule_confusion_matrix",
    on_tx(
        _RULE_CELLS
        + 'SELECT actual, CAST(coalesce(sum(n) FILTER (predicted = 0), 0) AS BIGINT) AS "0", '
        'CAST(coalesce(sum(n) FILTER (predicted = 1), 0) AS BIGINT) AS "1" FROM cells GROUP BY actual'
    ),
)
def rule_confusion_matrix(spark, folder):
    confusion = models.confusion_matrix(_ruled(spark, folder), "is_fraud")
    return models.square_confusion_matrix(confusion, [0, 1])


@query(
    "ml_09_rule_fraud_report",
    on_tx(
        _report_sql(_RULE_CELLS)
        + """SELECT CASE class WHEN 0 THEN 'Legitimate' ELSE 'Fraud' END AS label, round(p, 6) AS precision,
  round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM scores
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits)::DOUBLE / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores"""
    ),
)
def rule_fraud_report(spark, folder):
    confusion = models.confusion_matrix(_ruled(spark, folder), "is_fraud")
    return rounded(models.classification_report(confusion, models.LABEL_NAMES))


_RATED = """, rated AS (
  SELECT 'amount' AS model, is_fraud AS y, floor(amount / 20) AS s, amount > 150 AS p FROM tx
  UNION ALL SELECT 'amount scaled', is_fraud, 2 * floor(amount / 20) + 1, amount > 150 FROM tx
  UNION ALL SELECT 'hour', is_fraud, CAST(hour(transaction_ts) AS DOUBLE), hour(transaction_ts) >= 12 FROM tx),
counted AS (SELECT model, s, sum(y) AS pos, sum(1 - y) AS neg FROM rated GROUP BY ALL),
curve AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER (PARTITION BY model) AS all_pos, sum(neg) OVER (PARTITION BY model) AS all_neg
  FROM counted WINDOW w AS (PARTITION BY model ORDER BY s DESC)),
points AS (SELECT *, tp / (tp + fp) AS precision, lag(tp / (tp + fp)) OVER (PARTITION BY model ORDER BY s DESC) AS last FROM curve),
areas AS (
  SELECT model, sum(neg * (tp - pos / 2)) / max(all_pos * all_neg) AS auc_roc,
         sum(pos / all_pos * (precision + coalesce(last, precision)) / 2) AS auc_pr
  FROM points GROUP BY model),
sides AS (
  SELECT model, c, count(*) FILTER (y = c) AS support, count(*) FILTER (CAST(p AS INT) = c) AS claimed,
         count(*) FILTER (y = c AND CAST(p AS INT) = c) AS hits
  FROM rated, (VALUES (0), (1)) t(c) GROUP BY ALL),
f AS (SELECT model, sum(support * 2 * hits / (support + claimed)) / sum(support) AS f1 FROM sides GROUP BY model)
"""


def _rated(spark, folder) -> DataFrame:
    """Transactions scored by three rules; two of them rank alike, all have ties."""
    tx = stored_transactions(spark, folder)
    level, hour = F.floor(F.col("amount") / 20), F.hour("transaction_ts")
    rules = (
        ("amount", level, F.col("amount") > 150),
        ("amount scaled", 2 * level + 1, F.col("amount") > 150),
        ("hour", hour, hour >= 12),
    )
    entries = [
        F.struct(
            F.lit(name).alias("model"), score.cast("double").alias("score"), flag.cast("int").alias("prediction")
        )
        for name, score, flag in rules
    ]
    return tx.select("is_fraud", F.inline(F.array(*entries)))


@query(
    "ml_07_rule_scores",
    on_tx(
        _RATED
        + """SELECT model, round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr, round(f1, 6) AS f1
FROM areas JOIN f USING (model)"""
    ),
)
def rule_scores(spark, folder):
    return rounded(evaluation.classifier_scores(_rated(spark, folder)))


@query(
    "srt_03_best_rule",
    on_tx(
        _RATED
        + """SELECT model, round(auc_roc, 6) AS auc_roc FROM areas
QUALIFY row_number() OVER (ORDER BY round(auc_roc, 9) DESC, model) = 1"""
    ),
)
def best_rule(spark, folder):
    """Two rules tie for the highest area; the smaller name wins."""
    scores = rounded(evaluation.classifier_scores(_rated(spark, folder)), 9)
    return rounded(models.best_by(scores, "model", "auc_roc"))


_SCALED = CARD_PROFILES + ", scaled AS (SELECT CAST(card_id AS BIGINT) AS id, [" + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()" for c in models.SEGMENT_FEATURES
) + """] AS x FROM complete),
pairs AS (SELECT a.id AS i, b.id AS j, list_sum([(a.x[d] - b.x[d]) ** 2 for d in range(1, 11)]) AS dist
  FROM scaled a, scaled b),
means AS (
  SELECT k, i, i % k AS own, j % k AS other, sum(dist) AS total, count(*) AS n
  FROM pairs, range(2, 8) r(k) GROUP BY ALL),
sides AS (
  SELECT k, i, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS near,
         min(CASE WHEN own <> other THEN total / n END) AS far,
         max(CASE WHEN own = other THEN total / (2 * n) END) AS inertia
  FROM means GROUP BY ALL),
sweep AS (
  SELECT CAST(k AS INT) AS k, avg(coalesce((far - near) / nullif(greatest(far, near), 0), 0)) AS silhouette,
         sum(inertia) AS wcss FROM sides GROUP BY k)
"""


def _rule_sweep(spark, folder) -> DataFrame:
    """Cards dealt to 2 to 7 segments by their number."""
    ks = range(2, 8)
    card = F.col("card_id").cast("bigint")
    pairs = [F.struct(F.lit(k).alias("k"), (card % k).cast("int").alias("segment")) for k in ks]
    cards = _cards(spark, folder).select(vector_to_array("features").alias("x"), F.inline(F.array(*pairs)))
    return evaluation.segment_quality(cards, len(models.SEGMENT_FEATURES))


@query(
    "ml_11_rule_sweep",
    on_features(_SCALED + "SELECT k, round(silhouette, 6) AS silhouette, round(wcss, 4) AS wcss FROM sweep"),
)
def rule_sweep(spark, folder):
    """Quality of given segments; the reference statement compares all pairs of cards."""
    return rounded(_rule_sweep(spark, folder), wcss=4)


@query(
    "srt_03_best_rule_segment_count",
    on_features(
        _SCALED
        + """SELECT k, round(silhouette, 6) AS silhouette FROM sweep
QUALIFY row_number() OVER (ORDER BY sweep.silhouette DESC, k) = 1"""
    ),
)
def best_rule_segment_count(spark, folder):
    return rounded(models.best_by(_rule_sweep(spark, folder), "k", "silhouette"))


_WEIGHTS = {"amount_log1p": 0.8, "tx_hour": -0.02, "tx_is_weekend": 0.3, "gender_bin": 0.1}


@query(
    "ml_04_rule_objective",
    on_features(
        """, tried AS (
  SELECT 'given' AS name, -4.0::DOUBLE AS b, [0.8, -0.02, 0.3, 0.1]::DOUBLE[] AS c
  UNION ALL SELECT 'zero', 0.0, [0.0, 0.0, 0.0, 0.0]::DOUBLE[]),
scaled AS (
  SELECT is_fraud AS y, [amount_log1p, tx_hour, tx_is_weekend, gender_encoded]::DOUBLE[] AS x,
         CASE is_fraud WHEN 1 THEN n / (2.0 * ones) ELSE n / (2.0 * (n - ones)) END AS w
  FROM fx, (SELECT count(*)::DOUBLE AS n, sum(is_fraud)::DOUBLE AS ones FROM fx)),
margins AS (
  SELECT *, b + list_dot_product(c, x) AS m FROM scaled, tried),
spread AS (
  SELECT d, (sum(w * x[d] * x[d]) - sum(w * x[d]) * sum(w * x[d]) / sum(w)) / (sum(w) - sum(w * w) / sum(w)) AS variance
  FROM scaled, range(1, 5) r(d) GROUP BY d),
losses AS (
  SELECT name, c, sum(w * CASE y WHEN 1 THEN ln(1 + exp(-m)) ELSE ln(1 + exp(m)) END) / sum(w) AS loss
  FROM margins GROUP BY ALL),
pulls AS (
  SELECT name, d, sum(w * (1 / (1 + exp(-m)) - y) * x[d]) / sum(w) AS pull
  FROM margins, range(1, 5) r(d) GROUP BY ALL)
SELECT name, round(any_value(loss), 6) AS loss,
       round(any_value(loss) + 0.005 * sum(c[d] * c[d] * variance), 6) AS objective,
       round(max(pull + 0.01 * c[d] * variance) FILTER (d = 1), 5) AS gradient_of_amount,
       round(max(pull + 0.01 * c[d] * variance) FILTER (d = 2), 5) AS gradient_of_hour
FROM losses JOIN pulls USING (name) JOIN spread USING (d) GROUP BY name"""
    ),
)
def rule_objective(spark, folder):
    """Loss, objective and gradient of given weights on all rows."""
    inputs = list(_WEIGHTS)
    rows = (
        models.rename_for_models(built_features(spark, folder))
        .transform(with_class_weight)
        .select(
            "is_fraud", "class_weight", F.array(*[F.col(c).cast("double") for c in inputs]).alias("x")
        )
    )
    candidates = [("given", -4.0, list(_WEIGHTS.values())), ("zero", 0.0, [0.0] * len(inputs))]
    found = evaluation.logistic_objective(rows, candidates, len(inputs), 0.01)
    return rounded(
        found.select(
            "name",
            "loss",
            "objective",
            F.col("gradient")[0].alias("gradient_of_amount"),
            F.col("gradient")[1].alias("gradient_of_hour"),
        ),
        gradient_of_amount=5,
        gradient_of_hour=5,
    )


_CATEGORY_CELLS = """, uses AS (
  SELECT category, row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS idx, count(*) OVER () AS labels
  FROM tx GROUP BY category),
cells AS (
  SELECT CAST(idx AS INT) AS actual, CAST(least(idx + CAST(transaction_id AS BIGINT) % 2, labels - 1) AS INT) AS predicted,
         count(*) AS n FROM tx JOIN uses USING (category) GROUP BY ALL)"""


def _ruled_categories(spark, folder) -> DataFrame:
    """Every other row is predicted to be of the next category."""
    df = models.rename_for_models(built_features(spark, folder))
    last = df.agg(F.max("category_idx")).scalar()
    shifted = F.col("category_idx") + F.col("transaction_id").cast("bigint") % 2
    return df.select("category", "category_idx", F.least(shifted, last).alias("prediction"))


@query(
    "ml_13_rule_category_report",
    on_tx(
        _report_sql(_CATEGORY_CELLS)
        + """SELECT category AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM scores JOIN uses ON idx = class"""
    ),
)
def rule_category_report(spark, folder):
    confusion = models.confusion_matrix(_ruled_categories(spark, folder), "category_idx")
    report = models.classification_report(confusion, models.category_names(built_features(spark, folder)))
    return rounded(report.where(~F.col("label").isin("accuracy", "macro avg", "weighted avg")))


@query(
    "ml_13_rule_category_scores",
    on_tx(
        _report_sql(_CATEGORY_CELLS)
        + """SELECT round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy,
  round(sum(f * support) / sum(support), 6) AS f1 FROM scores"""
    ),
)
def rule_category_scores(spark, folder):
    confusion = models.confusion_matrix(_ruled_categories(spark, folder), "category_idx")
    return rounded(models.category_scores(confusion))


@query(
    "ml_14_rule_amount_scores",
    on_features(
        """, misses AS (SELECT amount_log1p AS y, amount_log1p - tx_hour / 4.0::DOUBLE AS miss FROM fx)
SELECT round(sqrt(avg(miss * miss)), 6) AS rmse, round(avg(abs(miss)), 6) AS mae,
       round(1 - avg(miss * miss) / var_pop(y), 6) AS r2 FROM misses"""
    ),
)
def rule_amount_scores(spark, folder):
    df = models.rename_for_models(built_features(spark, folder))
    return rounded(models.regression_scores(df.withColumn("prediction", F.col("tx_hour") / 4.0)))


def _ruled_segments(spark, folder) -> DataFrame:
    segment = (F.col("card_id").cast("bigint") % 3).cast("int")
    return models.card_profiles(built_features(spark, folder)).withColumn("prediction", segment)


_RULE_SEGMENTS = CARD_PROFILES + """, segments AS (
  SELECT CAST(CAST(card_id AS BIGINT) % 3 AS INT) AS prediction, CAST(count(*) AS BIGINT) AS card_count, """ + ", ".join(
    f"round(avg({c}), 2) AS {c}" for c in models.SEGMENT_MEASURES
) + """
  FROM complete GROUP BY 1)
"""


@query("agg_27_rule_segment_profiles", on_features(_RULE_SEGMENTS + "SELECT * FROM segments"))
def rule_segment_profiles(spark, folder):
    return models.segment_profiles(_ruled_segments(spark, folder))


@query(
    "agg_56_rule_segment_exposure",
    on_features(
        _RULE_SEGMENTS
        + "SELECT *, round(total_spend * fraud_rate_pct / 100, 6) AS fraud_exposure FROM segments"
    ),
)
def rule_segment_exposure(spark, folder):
    profiles = models.segment_profiles(_ruled_segments(spark, folder))
    return rounded(portfolio.segment_exposure(profiles))


# --- what holds for any fit --------------------------------------------------------------


@query(
    "ml_01_imputed_bounds",
    on_features(
        "SELECT unnest(["
        + ", ".join(f"'{c}'" for c in models.FRAUD_FEATURES)
        + "]) AS column_name, CAST(0 AS BIGINT) AS missing, true AS near_median, "
        "(SELECT CAST(count(*) AS BIGINT) FROM fx) AS n"
    ),
)
def imputed_bounds(spark, folder):
    """No input is missing afterwards, and what was put in covers half of the known values,
    to the thousandth of the rows that the imputer is off at most.

    Each row carries its inputs from before, so that nothing is joined to find what was put in,
    and all columns are ranked in one sort of (column, value).
    """
    inputs = models.FRAUD_FEATURES
    before = models.rename_for_models(built_features(spark, folder)).select(
        "transaction_id", *inputs, *[F.col(c).alias(f"before_{c}") for c in inputs]
    )
    after = models.impute_medians(before, inputs)
    facts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNull()).alias("missing"),
            F.max(F.when(F.col(f"before_{c}").isNull(), F.col(c))).cast("double").alias("put_in"),
            F.count(F.lit(1)).alias("n"),
        )
        for c in inputs
    ]
    lines = settled(after.agg(F.array(*facts).alias("facts")).select(F.inline("facts")))
    known = [
        F.struct(F.lit(c).alias("known_column"), F.col(c).cast("double").alias("value")) for c in inputs
    ]
    counts = value_counts(before.select(F.inline(F.array(*known))), "value", ("known_column",))
    ranked = running_counts(counts, "value", ("known_column",))
    slack = F.col("total") * 0.001 + 1
    holds = (F.col("before") - slack <= F.col("total") / 2) & (F.col("upto") + slack >= F.col("total") / 2)
    found = (F.col("known_column") == F.col("column_name")) & (F.col("value") == F.col("put_in"))
    near = ranked.join(F.broadcast(lines), found).groupBy("column_name").agg(F.bool_and(holds).alias("near"))
    return lines.join(F.broadcast(near), "column_name", "left").select(
        "column_name", "missing", F.coalesce("near", F.lit(True)).alias("near_median"), "n"
    )


_ALL_ROWS = "SELECT CAST(count(*) AS BIGINT) AS n, true AS tests_a_fifth, true AS chances_in_range, true AS decides_by_chance FROM tx"


def _score_facts(spark, folder, name: str) -> DataFrame:
    """The held-out share, the range of the scores, and the decision at one half."""
    scored = _scored(spark, folder, name)
    total = stored_transactions(spark, folder).agg(F.count(F.lit(1))).scalar()
    chance = F.col("fraud_probability")
    return scored.agg(
        total.alias("n"),
        (F.abs(F.count_distinct("transaction_id") - total * 0.2) <= F.sqrt(total * 0.16) * 5).alias("tests_a_fifth"),
        F.bool_and(chance.between(0, 1)).alias("chances_in_range"),
        F.bool_and((chance > 0.5).cast("int") == F.col("prediction")).alias("decides_by_chance"),
    )


@query("ml_04_logistic_regression_facts", on_tx(_ALL_ROWS))
def logistic_regression_facts(spark, folder):
    return _score_facts(spark, folder, "Logistic Regression")


@query("ml_05_random_forest_facts", on_tx(_ALL_ROWS))
def random_forest_facts(spark, folder):
    return _score_facts(spark, folder, "Random Forest")


@query("ml_06_boosted_trees_facts", on_tx(_ALL_ROWS))
def boosted_trees_facts(spark, folder):
    return _score_facts(spark, folder, "GBT")


_FITTED = "SELECT unnest(['GBT', 'Logistic Regression', 'Random Forest']) AS model, true AS in_range, true AS beats_chance"


@query("ml_07_fraud_score_facts", _FITTED)
def fraud_score_facts(spark, folder):
    scores = [F.col(c) for c in ("auc_roc", "auc_pr", "f1")]
    inside = [s.between(0, 1) for s in scores]
    return fraud_scores(spark, folder).select(
        "model", (inside[0] & inside[1] & inside[2]).alias("in_range"), (scores[0] > 0.5).alias("beats_chance")
    )


@query(
    "srt_03_best_model_facts",
    "SELECT CAST(1 AS BIGINT) AS models, true AS none_is_better",
)
def best_model_facts(spark, folder):
    top = fraud_scores(spark, folder).agg(F.max("auc_roc")).scalar()
    return best_model(spark, folder).agg(
        F.count("model").alias("models"), F.bool_and(F.col("auc_roc") == top).alias("none_is_better")
    )


@query(
    "ml_10_feature_importance_facts",
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{name}', CAST({len(inputs)} AS BIGINT), true, true)"
        for name, inputs in (
            ("fraud", models.FRAUD_FEATURES),
            ("category", models.CATEGORY_FEATURES),
            ("amount", models.AMOUNT_FEATURES),
        )
    )
    + ") t(model, inputs, adds_up_to_one, none_negative)",
)
def feature_importance_facts(spark, folder):
    return feature_importances(spark, folder).groupBy("model").agg(
        F.count_distinct("feature").alias("inputs"),
        (F.abs(F.sum("importance") - 1) < 1e-6).alias("adds_up_to_one"),
        F.bool_and(F.col("importance") >= 0).alias("none_negative"),
    )


@query(
    "ml_11_segment_sweep_facts",
    "SELECT CAST(6 AS BIGINT) AS tried, true AS silhouettes_in_range, true AS more_segments_fit_closer",
)
def segment_sweep_facts(spark, folder):
    """The last fact compares the ends of the sweep: neighbours may tie or swap."""
    return _sweep(spark, folder).agg(
        F.count("k").alias("tried"),
        F.bool_and(F.col("silhouette").between(-1, 1)).alias("silhouettes_in_range"),
        (F.max_by("wcss", "k") < F.min_by("wcss", "k")).alias("more_segments_fit_closer"),
    )


@query(
    "srt_03_best_segment_count_facts",
    "SELECT CAST(1 AS BIGINT) AS counts, true AS none_is_better",
)
def best_segment_count_facts(spark, folder):
    top = _sweep(spark, folder).agg(F.max("silhouette")).scalar()
    return best_segment_count(spark, folder).agg(
        F.count("k").alias("counts"), F.bool_and(F.col("silhouette") == top).alias("none_is_better")
    )


@query(
    "ml_12_segment_facts",
    on_features(CARD_PROFILES + "SELECT CAST(count(*) AS BIGINT) AS cards, true AS numbered_from_0 FROM complete"),
)
def segment_facts(spark, folder):
    """Every complete card is in one segment."""
    return segments(spark, folder).agg(
        F.count_distinct("card_id").alias("cards"),
        ((F.min("prediction") == 0) & (F.max("prediction") + 1 == F.count_distinct("prediction"))).alias(
            "numbered_from_0"
        ),
    )
