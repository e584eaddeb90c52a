"""IF ... THEN ... rules from clustered rows and their evaluation score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.operators.ordering import running_totals
from loglens.session import checkpointed

# Smallest score a rule may have, and the texts of a rule.
RULE_THRESHOLD = 0.0
IF_TEXT = "IF "
AND_TEXT = " AND "
THEN_TEXT = " THEN "
METRIC_TEXT = " -- "


def attach_metric(df: DataFrame, metrics: DataFrame, metric: str = "precision") -> DataFrame:
    """Add one value of a one-row table as a constant column."""
    return df.withColumn(metric, metrics.select(metric).scalar())


def rule_columns(
    df: DataFrame, antecedents=("verb",), consequent: str = "clusters", metric="precision", keep=()
) -> DataFrame:
    return df.select(*keep, *antecedents, consequent, metric)


def _part(name: str) -> Column:
    return F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("")))


def format_rule(antecedents, consequent: str = "clusters", metric: str = "precision") -> Column:
    return F.concat(
        F.lit(IF_TEXT),
        F.concat_ws(AND_TEXT, *[_part(a) for a in antecedents]),
        F.lit(THEN_TEXT),
        _part(consequent),
        F.lit(METRIC_TEXT),
        _part(metric),
    )


def above_threshold(
    df: DataFrame, metric: str = "precision", threshold: float = RULE_THRESHOLD
) -> DataFrame:
    """Keep rows whose score reaches the threshold; NaN and NULL never do."""
    score = F.col(metric)
    return df.filter((score >= threshold) & ~F.isnan(score))


def order_by_metric(df: DataFrame, metric: str = "precision", ties=()) -> DataFrame:
    """Ascending by score, NaN last; ``ties`` should make the order total.

    With a unique last tie column no sort partition can be dominated by equal rows.
    """
    return df.orderBy(F.asc(metric), *[F.asc(t) for t in ties])


def ranked_by_metric(
    df: DataFrame, metric: str = "precision", ties=(), single_task_rows=None
) -> DataFrame:
    """Adds ``rank``, the place (from 1) in the order of :func:`order_by_metric`.

    ``ties`` must make the order total. The table is stored once; no task sorts all of it.
    """
    order = [F.asc(metric), *[F.asc(t) for t in ties]]
    one = {"rank": F.lit(1).cast("bigint")}
    return running_totals(checkpointed(df), order, one, single_task_rows=single_task_rows)


def generate_rules(
    df: DataFrame,
    antecedents=("verb",),
    consequent: str = "clusters",
    metric: str = "precision",
    threshold: float = RULE_THRESHOLD,
    distinct: bool = True,
    weight: str | None = None,
    by=(),
    row_id: str | None = None,
) -> DataFrame:
    """Rules of a clustered table.

    ``distinct``: one row per rule with ``support``, the number of rows behind
    it (summed ``weight`` for pre-aggregated input); ``by`` adds grouping columns
    such as the minute. Otherwise one rule line per row, in no particular order
    unless sorted with :func:`order_by_metric`.
    """
    accepted = above_threshold(df, metric, threshold)
    rule = format_rule(antecedents, consequent, metric).alias("rule")
    columns = [*by, *antecedents, consequent, metric]
    if not distinct:
        keep = [row_id] if row_id else []
        return accepted.select(*keep, *columns, rule)
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    grouped = accepted.groupBy(*columns).agg(n.cast("bigint").alias("support"))
    return grouped.select(*columns, "support", rule)
