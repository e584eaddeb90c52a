"""Evaluation of (prediction, label) tables."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.operators.ordering import running_totals
from loglens.session import checkpointed, literal_rows


def _weight(weight):
    return F.lit(1).cast("bigint") if weight is None else F.col(weight)


def scalar_metrics(pairs: DataFrame, weight: str | None = None) -> DataFrame:
    """Every scalar metric in one aggregation, one row out.

    ``precision``, ``recall`` and ``f_measure`` without a class are the
    micro-averaged ones, all equal to the accuracy.
    """
    n = _weight(weight)
    right = F.col("prediction") == F.col("label")
    squared = F.pow(F.col("prediction") - F.col("label"), F.lit(2.0))
    sums = pairs.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(right, n)), F.lit(0)).alias("n_correct"),
        F.sum(squared * n).alias("_squares"),
    )
    accuracy = F.col("n_correct") / F.nullif("n", F.lit(0))
    return sums.select(
        "n",
        "n_correct",
        (F.col("n") - F.col("n_correct")).alias("n_wrong"),
        (F.col("_squares") / F.nullif("n", F.lit(0))).alias("mse"),
        accuracy.alias("accuracy"),
        ((F.col("n") - F.col("n_correct")) / F.nullif("n", F.lit(0))).alias("test_error"),
        accuracy.alias("precision"),
        accuracy.alias("recall"),
        accuracy.alias("f_measure"),
    )


def mean_squared_error(pairs: DataFrame) -> DataFrame:
    return scalar_metrics(pairs).select("mse")


def correct_predictions(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("prediction") == F.col("label"))


def wrong_predictions(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("prediction") != F.col("label"))


def class_metrics(pairs: DataFrame, weight: str | None = None) -> DataFrame:
    """Precision, recall and F of each class.

    Both roles of a row are counted in one aggregation whose size is the number
    of classes.
    """
    n = _weight(weight)
    hit = F.col("prediction") == F.col("label")
    roles = F.array(
        F.struct(
            F.col("label").alias("class"),
            n.alias("support"),
            F.when(hit, n).otherwise(n * 0).alias("hits"),
            (n * 0).alias("predicted"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            (n * 0).alias("support"),
            (n * 0).alias("hits"),
            n.alias("predicted"),
        ),
    )
    per_class = (
        pairs.select(F.inline(roles))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    # 0.0 for a class never predicted or never seen.
    precision = F.coalesce(F.col("hits") / F.nullif("predicted", F.lit(0)), F.lit(0.0))
    recall = F.coalesce(F.col("hits") / F.nullif("support", F.lit(0)), F.lit(0.0))
    both = F.col("support") + F.col("predicted")
    return per_class.select(
        "class",
        "support",
        "predicted",
        "hits",
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(2 * F.col("hits") / F.nullif(both, F.lit(0)), F.lit(0.0)).alias("f_measure"),
    )


def weighted_metrics(pairs: DataFrame, weight: str | None = None) -> DataFrame:
    """Per-class metrics averaged by support, one row."""
    total = F.sum("support")
    return class_metrics(pairs, weight).agg(
        (F.sum("hits") / total).alias("accuracy"),
        *[
            (F.sum(F.col(m) * F.col("support")) / total).alias(f"weighted_{m}")
            for m in ("precision", "recall", "f_measure")
        ],
    )


def evaluate_classifier(predictions: DataFrame, metric: str = "accuracy") -> float:
    """Spark ML evaluator; ``precision`` and ``recall`` mean the weighted ones."""
    # Short metric names accepted besides the evaluator's own.
    names = {"precision": "weightedPrecision", "recall": "weightedRecall"}
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName=names.get(metric, metric)
    ).evaluate(predictions)


def score_counts(
    pairs: DataFrame, score: str = "prediction", positive=None, weight: str | None = None
) -> DataFrame:
    """Positives and negatives of each distinct score.

    A row is positive when its label exceeds 0.5, or equals ``positive``.
    """
    n = _weight(weight)
    is_positive = F.col("label") > 0.5 if positive is None else F.col("label") == positive
    return pairs.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(is_positive, n).otherwise(n * 0)).alias("pos"),
        F.sum(F.when(is_positive, n * 0).otherwise(n)).alias("neg"),
    )


def _cumulated(pairs, score, positive, weight, single_task_rows):
    counts = checkpointed(score_counts(pairs, score, positive, weight))
    sums = counts.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("neg"),
    ).first()
    curve = running_totals(
        counts,
        [F.desc("score")],
        {"point": F.lit(1), "tp": F.col("pos"), "fp": F.col("neg")},
        rows=sums["rows"],
        single_task_rows=single_task_rows,
    )
    return curve, sums


def _rate(count, total):
    return count.cast("double") / F.nullif(F.lit(total).cast("double"), F.lit(0.0))


def roc_curve(
    pairs: DataFrame,
    score: str = "prediction",
    positive=None,
    weight: str | None = None,
    single_task_rows=None,
) -> DataFrame:
    """``(point, score, fpr, tpr)`` at every distinct score, highest first.

    Points (0,0) and (1,1) stand at the ends with a NULL score. ``point`` is
    the rank: rows with equal rates stay distinguishable.
    """
    curve, sums = _cumulated(pairs, score, positive, weight, single_task_rows)
    spark = pairs.sparkSession
    points = curve.select(
        F.col("point").cast("bigint").alias("point"),
        F.col("score").cast("double").alias("score"),
        _rate(F.col("fp"), sums["neg"]).alias("fpr"),
        _rate(F.col("tp"), sums["pos"]).alias("tpr"),
    )
    ends = literal_rows(
        spark, [(0, None, 0.0, 0.0), (sums["rows"] + 1, None, 1.0, 1.0)], points.schema
    )
    return points.unionByName(ends)


def area_under_roc(
    pairs: DataFrame,
    score: str = "prediction",
    positive=None,
    weight: str | None = None,
    single_task_rows=None,
) -> DataFrame:
    """Trapezoid area, one row; NULL when one of the two classes is absent."""
    curve, sums = _cumulated(pairs, score, positive, weight, single_task_rows)
    # As doubles: the product of two row counts may exceed BIGINT.
    tp, p, n = (F.col(c).cast("double") for c in ("tp", "pos", "neg"))
    strip = n * (tp - p / 2.0)
    both = F.lit(float(sums["pos"]) * float(sums["neg"]))
    return curve.agg((F.sum(strip) / F.nullif(both, F.lit(0.0))).alias("auc"))
