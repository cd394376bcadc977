"""What predictions are worth, from counts and sums that meet in a few small rows.

Ranking scores come from the number of rows of each label at each distinct score, segment
quality from the count, vector sum and sum of squares of each segment, and the objective of a
logistic regression from one sum for each set of weights. No step sorts in one task, gathers
rows on the driver or cuts a curve into bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.operators.ranking import running_sums
from cardlens.session import settled


# --- ranking ---------------------------------------------------------------------------


def score_counts(
    scored: DataFrame, label: str, score: str, prediction: str, by: tuple[str, ...] = ()
) -> DataFrame:
    """``by, score, predicted, positives, negatives`` of each distinct score, stored.

    Rows whose label is not 0 or 1, or that have no score or prediction, are left out.
    """
    rows = scored.select(
        *by,
        F.nanvl(F.col(score).cast("double"), F.lit(None)).alias("score"),
        F.col(prediction).cast("int").alias("predicted"),
        F.col(label).cast("int").alias("label"),
    ).where(F.col("label").isin(0, 1) & F.col("predicted").isNotNull() & F.col("score").isNotNull())
    return settled(
        rows.groupBy(*by, "score", "predicted").agg(
            F.count_if(F.col("label") == 1).alias("positives"),
            F.count_if(F.col("label") == 0).alias("negatives"),
        )
    )


def ranking_scores(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``by, auc_roc, auc_pr`` of :func:`score_counts`, exact and with ties.

    A threshold lies at every distinct score; both curves join their points by straight lines,
    and the precision of the first point also holds at recall 0. Undefined areas are NULL.
    """
    sums = ["positives", "negatives"]
    levels = counts.groupBy(*by, "score").agg(*[F.sum(c).alias(c) for c in sums])
    ranked = running_sums(levels, "score", sums, by)
    here, true, false = F.col("positives"), F.col("total_positives"), F.col("total_negatives")
    above, claimed_above = _claimed(true - F.col("upto_positives"), false - F.col("upto_negatives"))
    upto, claimed = _claimed(true - F.col("before_positives"), false - F.col("before_negatives"))
    precision = upto / claimed
    precision_above = F.when(claimed_above > 0, F.try_divide(above, claimed_above)).otherwise(precision)
    return ranked.groupBy(*by).agg(
        F.sum(F.try_divide(F.col("negatives") * (above + here / 2), true * false)).alias("auc_roc"),
        F.sum(F.try_divide(here, true) * (precision + precision_above) / 2).alias("auc_pr"),
    )


def _claimed(hits: Column, misses: Column) -> tuple[Column, Column]:
    """Rows with the label at or above a threshold, and all rows there, as doubles."""
    return hits.cast("double"), (hits + misses).cast("double")


def weighted_f1(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``by, f1``: the classes' F1 of :func:`score_counts`, weighted by their rows."""
    cells = counts.groupBy(*by).agg(
        *[
            F.sum(F.when(F.col("predicted") == p, F.col(side)).otherwise(0)).cast("double").alias(f"{side}_{p}")
            for side in ("positives", "negatives")
            for p in (0, 1)
        ],
        *[F.sum(side).cast("double").alias(side) for side in ("positives", "negatives")],
    )
    ones = _f1(F.col("positives_1"), F.col("positives"), F.col("positives_1") + F.col("negatives_1"))
    zeros = _f1(F.col("negatives_0"), F.col("negatives"), F.col("positives_0") + F.col("negatives_0"))
    rows = F.col("positives") + F.col("negatives")
    f1 = F.try_divide(F.col("positives") * ones + F.col("negatives") * zeros, rows)
    return cells.select(*by, f1.alias("f1"))


def _f1(hits: Column, support: Column, claimed: Column) -> Column:
    return F.coalesce(F.try_divide(2 * hits, support + claimed), F.lit(0.0))


def classifier_scores(
    scored: DataFrame,
    label: str = "is_fraud",
    score: str = "score",
    prediction: str = "prediction",
    by: tuple[str, ...] = ("model",),
) -> DataFrame:
    """``by, auc_roc, auc_pr, f1`` from one pass over the scored rows of all classifiers."""
    counts = score_counts(scored, label, score, prediction, by)
    return ranking_scores(counts, by).join(weighted_f1(counts, by), list(by))


# --- segments --------------------------------------------------------------------------


def segment_statistics(assigned: DataFrame, size: int) -> DataFrame:
    """``k, segment, n, squares, total``: all that distances to a segment's rows depend on.

    ``assigned`` holds ``k, segment, x`` (an array of ``size`` entries), a row for each row and
    number of segments. One aggregate; the result has a row for each segment.
    """
    return assigned.groupBy("k", "segment").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_dot("x", "x", size)).alias("squares"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(size)]).alias("total"),
    )


def _dot(a: str, b: str, size: int) -> Column:
    """Inner product of two array columns, written out so that it stays in generated code."""
    parts = [F.col(a)[i] * F.col(b)[i] for i in range(size)]
    return sum(parts[1:], parts[0])


def segment_quality(
    assigned: DataFrame, size: int, centres: DataFrame | None = None
) -> DataFrame:
    """``k, silhouette, wcss`` of every number of segments in ``assigned``.

    The silhouette is that of squared Euclidean distances. The mean squared distance of x to a
    segment is |x|^2 + squares / n - 2 x total / n, so a pass over the rows needs the statistics
    of the segments only: one small row for each. A row that is alone in its segment counts 0.
    ``wcss`` are the squared distances to ``centres`` (``k, segment, centre``), or to the means.
    """
    stats = settled(segment_statistics(assigned, size))
    lists = stats.groupBy("k").agg(  # a row for each number of segments
        F.collect_list(F.struct("segment", "n", "squares", "total")).alias("segments")
    )
    x = F.col("x")

    def distance(s: Column) -> Column:
        products = [x[i] * s["total"][i] for i in range(size)]
        mean = _dot("x", "x", size) + s["squares"] / s["n"] - 2 * sum(products[1:], products[0]) / s["n"]
        return F.greatest(mean, F.lit(0.0))

    own = F.filter("segments", lambda s: (s["segment"] == F.col("own")) & (s["n"] > 1))
    others = F.filter("segments", lambda s: s["segment"] != F.col("own"))
    near = F.array_max(F.transform(own, lambda s: distance(s) * s["n"] / (s["n"] - 1)))
    rows = (
        assigned.withColumnRenamed("segment", "own")
        .join(F.broadcast(lists), "k")
        .select("k", near.alias("near"), F.array_min(F.transform(others, distance)).alias("far"))
    )
    width = F.coalesce(
        F.try_divide(F.col("far") - F.col("near"), F.greatest("far", "near")), F.lit(0.0)
    )
    shape = rows.groupBy("k").agg(F.avg(width).alias("silhouette"))
    if centres is None:
        spread = F.col("squares") - _dot("total", "total", size) / F.col("n")
        around = stats
    else:
        spread = F.col("squares") - 2 * _dot("centre", "total", size) + F.col("n") * _dot("centre", "centre", size)
        around = stats.join(F.broadcast(centres), ["k", "segment"])
    return shape.join(around.groupBy("k").agg(F.sum(spread).alias("wcss")), "k")


# --- logistic regression ---------------------------------------------------------------


def column_deviations(rows: DataFrame, size: int, weight: str) -> DataFrame:
    """One row ``deviations``: weighted sample deviations of the entries of ``x``."""
    w = F.col(weight)
    total = F.sum(w)
    spread = [
        F.sum(w * F.col("x")[i] * F.col("x")[i]) - F.sum(w * F.col("x")[i]) * F.sum(w * F.col("x")[i]) / total
        for i in range(size)
    ]
    free = total - F.sum(w * w) / total
    return rows.agg(F.array(*[F.sqrt(F.greatest(s, F.lit(0.0)) / free) for s in spread]).alias("deviations"))


def logistic_objective(
    rows: DataFrame,
    candidates: list[tuple[str, float, list[float]]],
    size: int,
    regularization: float = 0.0,
    label: str = "is_fraud",
    weight: str = "class_weight",
) -> DataFrame:
    """``name, loss, objective, gradient`` of sets of weights (``name, intercept, weights``).

    ``loss`` is the weighted mean log loss over ``rows`` (``x``, label, weight); the objective
    adds half the regularization times the squared weights, each in units of its entry's
    deviation. ``gradient`` is the objective's, by weight and then by intercept. Candidates are
    a handful, given in the plan; the rows are read once for all of them.
    """
    margin = F.col("intercept") + _dot("weights", "x", size)
    w, y = F.col(weight), F.col(label)
    # log(1 + exp(m)) without overflow
    softplus = F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
    miss = 1 / (1 + F.exp(-margin)) - y
    sets = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(float(intercept)).alias("intercept"),
            F.array(*[F.lit(float(c)) for c in weights]).alias("weights"),
        )
        for name, intercept, weights in candidates
    ]
    tried = rows.select("x", label, weight, F.inline(F.array(*sets)))
    total = F.sum(w)
    sums = tried.groupBy("name", "intercept", "weights").agg(
        (F.sum(w * (softplus - y * margin)) / total).alias("loss"),
        F.array(*[F.sum(w * miss * F.col("x")[i]) / total for i in range(size)]).alias("slopes"),
        (F.sum(w * miss) / total).alias("slope"),
    )
    scale = column_deviations(rows, size, weight).select("deviations").scalar()
    scaled = sums.withColumn("deviations", scale)
    squares = [F.pow(F.col("weights")[i] * F.col("deviations")[i], F.lit(2)) for i in range(size)]
    pulls = [
        F.col("slopes")[i] + regularization * F.col("weights")[i] * F.pow(F.col("deviations")[i], F.lit(2))
        for i in range(size)
    ]
    return scaled.select(
        "name",
        "loss",
        (F.col("loss") + regularization / 2 * sum(squares[1:], squares[0])).alias("objective"),
        F.array(*pulls, F.col("slope")).alias("gradient"),
    )
