"""Evaluate a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add ``name``, computed once however many filters and columns use it.

    The optimizer moves filters below a projection and repeats the projected
    expression inside them, so a pattern match or a JSON parse would run once
    per filter and once more for the output. It does not move filters on the
    output of a generator below that generator.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))


def at_most_once(expression: Column) -> Column:
    """``expression``, never repeated by the optimizer, and left out where nothing uses it.

    The partition number makes it non-deterministic in name only: projections that are
    used several times stay, filters on it stay above, and column pruning still drops it.
    Filters on other columns stay above as well, so put those before it; where they
    have to pass, take :func:`evaluate_once`, which cannot be pruned.
    """
    return F.when(F.spark_partition_id() >= 0, expression)
