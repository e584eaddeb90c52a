"""Clustering, regression and classification on pre-aggregated training rows.

Every fit groups the training rows by their feature values first and passes the
row count as the weight. The loss of a model over n equal rows is n times the
loss of one, so the fitted model is the same, while the iterations run over the
distinct rows only. A feature set on which a third of all rows agree costs one
weighted row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from loglens.functions.once import evaluate_once
from loglens.functions.split import TRAIN_PERCENT, is_train
from loglens.operators.prepare import has_rows
from loglens.session import cached, checkpointed, literal_rows

# Parameters of the models.
CLUSTERS = 5
SGD_ITERATIONS = 10
SGD_STEP = 1e-15
SGD_TOLERANCE = 0.001
LOGISTIC = {"family": "multinomial", "maxIter": 100, "tol": 1e-4}
NAIVE_BAYES_SMOOTHING = 1.0
TREE_IMPURITY = "gini"
TREE_DEPTH = 10
TREE_BINS = 1000
ELASTIC_NET = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}


def weighted_rows(df: DataFrame, columns, weight: str | None = None) -> DataFrame:
    """Distinct rows of ``columns`` with their count (or sum of ``weight``)."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*columns).agg(n.cast("double").alias("weight"))


def vectors(df: DataFrame, features, out: str = "features", normalized: bool = False):
    raw = "_raw" if normalized else out
    df = VectorAssembler(inputCols=list(features), outputCol=raw).transform(df)
    if normalized:
        df = Normalizer(inputCol=raw, outputCol=out, p=2.0).transform(df).drop(raw)
    return df


# --- clustering ---------------------------------------------------------------


@dataclass(frozen=True)
class Clustering:
    """A fitted k-means model with clusters numbered by their centres."""

    model: object
    features: tuple
    renumber: tuple

    def assign(self, df: DataFrame, out: str = "clusters") -> DataFrame:
        found = self.model.transform(vectors(df, self.features, "_features"))
        number = F.element_at(F.array(*[F.lit(i) for i in self.renumber]), F.col("_cluster") + 1)
        return found.withColumn(out, number).drop("_features", "_cluster")

    def centers(self, spark) -> DataFrame:
        """One row per cluster."""
        found = self.model.clusterCenters()
        rows = sorted((self.renumber[i], [float(x) for x in c]) for i, c in enumerate(found))
        return literal_rows(
            spark, rows, StructType().add("clusters", "integer").add("center", ArrayType(DoubleType()))
        )


def fit_kmeans(
    df: DataFrame, features, k: int = CLUSTERS, weight: str | None = None, seed=1, **params
) -> Clustering:
    """k-means over scalar feature columns.

    Clusters are numbered in the order of their centres, which makes the labels
    independent of the random start.
    """
    # Stored first, so that the iterations see as many tasks as the distinct rows need.
    points = checkpointed(weighted_rows(df, features, weight))
    points = vectors(points, features, "_features")
    kmeans = KMeans(
        k=k,
        featuresCol="_features",
        predictionCol="_cluster",
        weightCol="weight",
        seed=seed,
        **params,
    )
    with cached(points):
        model = kmeans.fit(points)
    order = sorted(range(len(model.clusterCenters())), key=lambda i: tuple(model.clusterCenters()[i]))
    renumber = tuple(order.index(i) for i in range(len(order)))
    return Clustering(model, tuple(features), renumber)


def _distance(vector, center):
    gaps = F.zip_with(vector, center, lambda a, b: (a - b) * (a - b))
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)


def assign_nearest(df: DataFrame, vector, centers, out: str = "clusters") -> DataFrame:
    """Nearest of k given centres ``[(number, [..]), ..]``; ties to the smaller number.

    ``vector`` is an array column, or a list of a few scalar columns, for which
    the distances compile to plain arithmetic.
    """
    if not isinstance(vector, str):
        distances = F.array(
            *[
                F.struct(
                    sum(
                        ((F.col(v) - x) * (F.col(v) - x) for v, x in zip(vector, center)),
                        F.lit(0.0),
                    ).alias("d"),
                    F.lit(int(number)).alias("number"),
                )
                for number, center in centers
            ]
        )
        return evaluate_once(df, out, F.array_min(distances)["number"])
    known = F.array(
        *[
            F.struct(
                F.lit(int(number)).alias("number"),
                F.array(*[F.lit(float(x)) for x in center]).alias("center"),
            )
            for number, center in centers
        ]
    )
    point = F.col(vector).cast("array<double>")
    distances = F.transform(
        known,
        lambda c: F.struct(_distance(point, c["center"]).alias("d"), c["number"].alias("number")),
    )
    return evaluate_once(df, out, F.array_min(distances)["number"])


def group_means(df: DataFrame, vector: str, group: str) -> DataFrame:
    """Mean vector per group: ``(group, dim, mean)``; vectors are of one length.

    Vectors are summed whole, one buffer a group and task. Rows without a vector do not
    count, and a missing component does not count in its dimension.
    """
    value = F.transform(vector, lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))
    there = F.transform(vector, lambda x: F.when(x.isNull(), 0.0).otherwise(1.0))
    total = Summarizer.metrics("sum")
    sums = (
        df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0))
        .select(group, array_to_vector(value).alias("_v"), array_to_vector(there).alias("_n"))
        .groupBy(group)
        .agg(
            vector_to_array(total.summary(F.col("_v"))["sum"]).alias("_v"),
            vector_to_array(total.summary(F.col("_n"))["sum"]).alias("_n"),
        )
    )
    # One row for each group and dimension, of the sums.
    means = F.zip_with("_v", "_n", lambda v, n: v / F.nullif(n, F.lit(0.0)))
    return sums.select(group, F.posexplode(means).alias("dim", "mean"))


def centers_of(means: DataFrame, group: str) -> list:
    """Collect k x dimensions mean values as a sorted list of centres."""
    found: dict = {}
    for row in means.collect():
        found.setdefault(row[group], {})[row["dim"]] = row["mean"]
    return [(g, [v for _, v in sorted(dims.items())]) for g, dims in sorted(found.items())]


def lloyd(df: DataFrame, vector: str, centers, steps: int, out: str = "clusters") -> DataFrame:
    """``steps`` rounds of assignment and re-centring from given centres.

    Each round is one pass with a k x dimensions aggregate.
    """
    for _ in range(steps):
        moved = dict(centers_of(group_means(assign_nearest(df, vector, centers, out), vector, out), out))
        # A centre that lost all its points stays where it was.
        centers = [(number, moved.get(number, center)) for number, center in centers]
    return assign_nearest(df, vector, centers, out)


# --- linear regression by gradient descent --------------------------------------


def least_squares_moments(df: DataFrame, features, label="label", weight=None) -> DataFrame:
    """n, X'X and X'y of a linear least-squares problem: one pass, one row."""
    w = F.lit(1.0) if weight is None else F.col(weight)
    sums = [F.sum(w).alias("n")]
    for i, a in enumerate(features):
        sums.append(F.sum(w * F.col(a) * F.col(label)).alias(f"xy{i}"))
        for j, b in enumerate(features[: i + 1]):
            sums.append(F.sum(w * F.col(a) * F.col(b)).alias(f"xx{i}_{j}"))
    return df.agg(*sums)


def linear_sgd(
    df: DataFrame,
    features,
    label: str = "label",
    weight: str | None = None,
    iterations: int = SGD_ITERATIONS,
    step: float = SGD_STEP,
    tolerance: float = SGD_TOLERANCE,
    intercept: bool = False,
) -> list:
    """Full-batch gradient descent with step ``step / sqrt(t)``.

    The gradient depends on the data through X'X and X'y alone, so the data is
    read once however many iterations follow. Descent ends early when the
    weights move less than ``tolerance`` (0 switches that off).
    """
    features = list(features)
    if intercept:
        df = df.withColumn("_one", F.lit(1.0))
        features.append("_one")
    row = least_squares_moments(df, features, label, weight).first()
    size = len(features)
    if not row["n"]:
        return [0.0] * size
    xx = np.zeros((size, size))
    xy = np.array([row[f"xy{i}"] for i in range(size)]) / row["n"]
    for i in range(size):
        for j in range(i + 1):
            xx[i, j] = xx[j, i] = row[f"xx{i}_{j}"] / row["n"]
    weights = np.zeros(size)
    for t in range(1, iterations + 1):
        moved = weights - step / np.sqrt(t) * (xx @ weights - xy)
        gap = np.linalg.norm(moved - weights)
        weights, before = moved, t > 1
        if tolerance and before and gap < tolerance * max(np.linalg.norm(weights), 1.0):
            break
    return [float(x) for x in weights]


def predict_linear(df: DataFrame, features, weights, out: str = "prediction") -> DataFrame:
    """Dot product with the weights; one weight more than features is the intercept."""
    total = F.lit(weights[len(features)]) if len(weights) > len(features) else F.lit(0.0)
    for feature, weight in zip(features, weights):
        total = total + F.col(feature) * F.lit(weight)
    return df.withColumn(out, total)


# --- fitted models over weighted rows ---------------------------------------------

_COLUMNS = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}


def _estimator(kind: str, **params):
    if kind == "linear":
        return LinearRegression(**{**_COLUMNS, "solver": "normal", **params})
    if kind == "elastic_net":
        return LinearRegression(**{**_COLUMNS, **ELASTIC_NET, **params})
    if kind == "logistic":
        return LogisticRegression(**{**_COLUMNS, **LOGISTIC, **params})
    if kind == "naive_bayes":
        return NaiveBayes(
            **{
                **_COLUMNS,
                "modelType": "multinomial",
                "smoothing": NAIVE_BAYES_SMOOTHING,
                **params,
            }
        )
    if kind == "tree":
        return DecisionTreeClassifier(
            **{
                **_COLUMNS,
                "impurity": TREE_IMPURITY,
                "maxDepth": TREE_DEPTH,
                "maxBins": TREE_BINS,
                **params,
            }
        )
    raise ValueError(f"unknown model: {kind}")


@dataclass(frozen=True)
class Fitted:
    """A model together with the scalar columns it reads."""

    model: object
    features: tuple
    normalized: bool = False

    def score(self, df: DataFrame, keep=("label",)) -> DataFrame:
        """``keep`` and ``prediction`` for each row of ``df``."""
        ready = vectors(df, self.features, "features", self.normalized)
        return self.model.transform(ready).select(*keep, "prediction")


class NoTrainingData(ValueError):
    """There are no rows to learn from; the caller decides what to skip."""


def fit_weighted(
    rows: DataFrame, kind: str, features, weight: str | None = None, normalized=False, **params
) -> Fitted:
    """Fit on ``features`` and ``label`` columns of ``rows``."""
    columns = [*features, "label"]
    stored = checkpointed(weighted_rows(rows, columns, weight))
    if not has_rows(stored):
        raise NoTrainingData(f"no training rows for {kind}")
    train = stored.withColumn("label", F.col("label").cast("double"))
    with cached(vectors(train, features, "features", normalized)) as train:
        model = _estimator(kind, **params).fit(train)
    return Fitted(model, tuple(features), normalized)


def fit_and_score(
    rows: DataFrame,
    kind: str,
    features,
    row_id: str,
    normalized: bool = False,
    percent: int = TRAIN_PERCENT,
    **params,
):
    """Split by key, fit on the train rows, score the test rows.

    Returns the fitted model and ``(row_id, label, prediction)`` of the test rows.
    """
    marked = is_train(F.col(row_id), percent)
    fitted = fit_weighted(rows.filter(marked), kind, features, normalized=normalized, **params)
    test = rows.filter(~marked).withColumn("label", F.col("label").cast("double"))
    return fitted, fitted.score(test, keep=(row_id, "label"))


def labelled(rows: DataFrame, features, clusters: str = "clusters", keep=()) -> DataFrame:
    """Label and feature columns for a classifier that predicts the cluster."""
    return rows.select(*keep, F.col(clusters).cast("double").alias("label"), *features)


# --- naive Bayes parameters in closed form --------------------------------------


def naive_bayes_parameters(
    rows: DataFrame, features, weight: str | None = None, smoothing=NAIVE_BAYES_SMOOTHING
) -> DataFrame:
    """Log prior and log likelihoods ``(label, feature, log_prior, log_likelihood)``.

    Size is classes x features; the data is aggregated once.
    """
    n = F.lit(1) if weight is None else F.col(weight)
    sums = checkpointed(
        rows.groupBy("label").agg(
            F.sum(n).cast("double").alias("_n"),
            *[F.sum(F.col(f) * n).alias(f) for f in features],
        )
    )
    row_total = F.col("_n")
    for_all = sums.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("classes")).first()
    class_total = sum((F.col(f) for f in features), F.lit(0.0))
    prior = F.log((row_total + smoothing) / F.lit((for_all["n"] or 0.0) + smoothing * for_all["classes"]))
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.log(
                    (F.col(f) + smoothing) / (class_total + smoothing * len(features))
                ).alias("log_likelihood"),
            )
            for f in features
        ]
    )
    return sums.select("label", prior.alias("log_prior"), F.inline(entries))


