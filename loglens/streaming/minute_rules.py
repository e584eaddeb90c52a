"""Rules from a running stream, one output per minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglens.operators.models import CLUSTERS
from loglens.operators.prepare import feature_rows
from loglens.plans.log_analysis import (
    SOURCE_COLUMNS,
    Analysis,
    analyse_combinations,
    classified,
    combinations,
)
from loglens.session import cached
from loglens.sinks.files import cluster_csv_sink, rule_text_sink, with_minute
from loglens.streaming.ingest import BATCH_INTERVAL, query_id, replace_batch, trigger_options
from loglens.streaming.running_counts import COMPACT_EVERY, RunningCounts


def _scores(analyses: dict[str, Analysis], minute) -> DataFrame | None:
    """``(minute, model, n, n_correct, mse, precision, ..., auc)``, one row a model."""
    made = None
    for model, analysis in analyses.items():
        if analysis.skipped:
            continue
        row = analysis.metrics.select(
            F.lit(minute).alias("minute"), F.lit(model).alias("model"), "*"
        ).withColumn("auc", analysis.area_under_roc().select("auc").scalar())
        made = row if made is None else made.unionByName(row)
    return made


def minute_rules(
    logs: DataFrame,
    row_id: str,
    csv_path: str,
    rule_path: str,
    checkpoint: str,
    preset: str = "verb",
    antecedents=("verb",),
    k: int = CLUSTERS,
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
    minute=None,
    models=("logistic", "tree"),
    metrics_path: str | None = None,
    curve_path: str | None = None,
    enrich=None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """After each batch retrain on all rows since the stream began and write the rules.

    A batch adds the counts of its own feature combinations to :class:`RunningCounts`
    beside the checkpoint; no batch reads or writes history again. The first of ``models``
    explains the clusters and its precision stands in the rules; of every model that has
    enough rows the scores go to ``metrics_path`` and the first one's ROC points to
    ``curve_path``, each batch in a folder of its own. ``enrich`` is applied to the records
    of a batch, such as a lookup too large for a stream.

    The current minute is a partition of both rule outputs; a later batch of the same
    minute, or a repeated batch, replaces it. Batches without rows do nothing.
    ``minute`` (a column) replaces the clock in tests.
    """

    def emit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        counts = RunningCounts(f"{checkpoint}/combinations", query, compact_every)
        records = enrich(batch) if enrich else batch
        rows = feature_rows(records, keep=(row_id,))
        new = combinations(rows, SOURCE_COLUMNS[preset], row_id)
        counts.add(new, batch_id)
        totals = counts.totals(spark, new.schema, batch_id)
        analysis = analyse_combinations(totals, preset, k, model=models[0])
        if analysis.skipped:
            return
        # The clock is read once, so all outputs of a batch name the same minute.
        now = minute
        if minute is None:
            now = with_minute(spark.range(1)).first()["minute"]
        with cached(analysis.rules(antecedents).withColumn("minute", F.lit(now))) as rules:
            cluster_csv_sink(rules, csv_path, (*antecedents, "clusters", "precision"))
            rule_text_sink(rules, rule_path)
        if metrics_path:
            others = {model: classified(analysis, preset, model) for model in models[1:]}
            scores = _scores({models[0]: analysis, **others}, now)
            replace_batch(scores, metrics_path, query, batch_id)
        if curve_path:
            curve = analysis.roc_curve().withColumn("minute", F.lit(now))
            replace_batch(curve, curve_path, query, batch_id)

    return (
        logs.writeStream.foreachBatch(emit)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(available_now, interval))
        .start()
    )
