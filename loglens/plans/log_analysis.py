"""From log records to rules: index, cluster, classify, score, write rules.

The records are read once. That pass counts the combinations of the category
texts a feature set uses; indexing, clustering, training, scoring and the rules
all work on these weighted combinations. How large they are depends on the
number of distinct combinations, not on the number of records.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.functions.split import TRAIN_PERCENT, is_train
from loglens.operators.features import PRESETS, index_columns
from loglens.operators.metrics import area_under_roc, roc_curve, scalar_metrics
from loglens.operators.models import (
    CLUSTERS,
    Clustering,
    Fitted,
    NoTrainingData,
    fit_kmeans,
    fit_weighted,
    labelled,
)
from loglens.operators.prepare import feature_rows, has_rows
from loglens.operators.rules import attach_metric, generate_rules
from loglens.session import checkpointed

# Fixed value: a tree is grown from more rows than this.
TREE_ROWS = 2
# Record columns behind the inputs of each feature set.
SOURCE_COLUMNS = {
    "verb": ("verb",),
    "four": ("verb", "response", "request", "city_name"),
    "lat_long": ("latitude", "longitude"),
}


@dataclass(frozen=True)
class Analysis:
    """Outcome of one run. ``skipped`` gives the reason when there are no rules."""

    clustered: DataFrame | None = None
    clustering: Clustering | None = None
    classifier: Fitted | None = None
    scored: DataFrame | None = None
    metrics: DataFrame | None = None
    skipped: str | None = None

    def rules(self, antecedents, metric: str = "precision", **options) -> DataFrame:
        table = attach_metric(self.clustered, self.metrics, metric)
        return generate_rules(table, antecedents, metric=metric, weight="weight", **options)

    def area_under_roc(self) -> DataFrame:
        return area_under_roc(self.scored, weight="weight")

    def roc_curve(self) -> DataFrame:
        return roc_curve(self.scored, weight="weight")


def combinations(
    rows: DataFrame, columns, row_id: str, by=(), percent: int = TRAIN_PERCENT
) -> DataFrame:
    """Count the rows per combination and side of the train/test split."""
    return (
        rows.withColumn("is_train", is_train(F.col(row_id), percent))
        .groupBy(*by, *columns, "is_train")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def index_combinations(combos: DataFrame, preset: str) -> DataFrame:
    """Add the index columns; frequencies are sums of the weights."""
    unique = [c for c in combos.columns if c != "weight"]
    return index_columns(combos, PRESETS[preset].indexed, unique, weight="weight")


def analyse_combinations(
    combos: DataFrame,
    preset: str = "verb",
    k: int = CLUSTERS,
    model: str = "logistic",
    seed: int = 1,
    **params,
) -> Analysis:
    """Cluster the weighted combinations, learn the clusters, score the test side."""
    combos = checkpointed(combos)
    if not has_rows(combos):
        return Analysis(skipped="no rows")
    indexed = index_combinations(combos, preset)
    clustering = fit_kmeans(indexed, PRESETS[preset].inputs, k, weight="weight", seed=seed)
    clustered = checkpointed(clustering.assign(indexed))
    return classified(Analysis(clustered, clustering), preset, model, **params)


def classified(analysis: Analysis, preset: str, model: str, **params) -> Analysis:
    """``analysis`` with a classifier of its clusters, scored on the test side.

    A tree is grown from more than ``TREE_ROWS`` rows only.
    """
    clustered, features = analysis.clustered, PRESETS[preset].inputs
    found = Analysis(clustered, analysis.clustering)
    if model == "tree" and not _more_rows_than(clustered, TREE_ROWS):
        return replace(found, skipped=f"a tree needs more than {TREE_ROWS} rows")
    rows = labelled(clustered, features, keep=("is_train", "weight"))
    try:
        classifier = fit_weighted(
            rows.filter("is_train"), model, features, weight="weight", **params
        )
    except NoTrainingData as reason:
        return replace(found, skipped=str(reason))
    scored = classifier.score(rows.filter("NOT is_train"), keep=("label", "weight"))
    metrics = scalar_metrics(scored, weight="weight")
    return replace(found, classifier=classifier, scored=scored, metrics=metrics)


def _more_rows_than(combos: DataFrame, n: int) -> bool:
    return (combos.agg(F.sum("weight").alias("n")).first()["n"] or 0) > n


def analyse_logs(
    logs: DataFrame, row_id: str, preset: str = "verb", by=(), **options
) -> Analysis:
    """The whole run over log records (see :data:`loglens.schema.LOG_SCHEMA`)."""
    rows = feature_rows(logs, keep=(row_id, *by))
    combos = combinations(rows, SOURCE_COLUMNS[preset], row_id, by)
    return analyse_combinations(combos, preset, **options)
