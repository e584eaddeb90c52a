"""Category indexing, vector assembly and scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    Normalizer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.operators.lookup import BROADCAST_BYTES, lookup_join, row_bytes
from loglens.operators.ordering import running_totals
from loglens.session import checkpointed

# Categorical source column and the index column made from it.
INDEX_COLUMNS = {
    "request": "requestIndex",
    "verb": "verbIndex",
    "city_name": "geoIpCityNameIndex",
}


@dataclass(frozen=True)
class Preset:
    """A named feature set: columns to index, vector inputs, vector name."""

    indexed: tuple
    inputs: tuple
    vector: str = "features"
    normalized: str | None = "features_normalized"


PRESETS = {
    "four": Preset(
        ("request", "verb", "city_name"),
        ("response", "requestIndex", "verbIndex", "geoIpCityNameIndex"),
    ),
    "verb": Preset(("verb",), ("verbIndex",)),
    "lat_long": Preset((), ("latitude", "longitude"), "latLong", None),
}


def category_frequency(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def index_table(
    counts: DataFrame, column: str, out: str, single_task_rows=None, rows: int | None = None
) -> DataFrame:
    """``(column, n)`` to ``(column, n, out)``: 0.0 for the most frequent value.

    Ties go by the value. ``counts`` should be a stored table: it is read more
    than once.
    """
    ranked = running_totals(
        counts,
        [F.desc("n"), F.asc(column)],
        {out: F.lit(1)},
        rows=rows,
        single_task_rows=single_task_rows,
    )
    return ranked.withColumn(out, (F.col(out) - 1).cast("double"))


def string_index(
    df: DataFrame,
    column: str,
    out: str,
    row_id: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    single_task_rows=None,
) -> DataFrame:
    """Index any column, however many values it has, by a join.

    The frequency table is computed once and stored; rows with a NULL category
    get a NULL index.
    """
    counts = checkpointed(category_frequency(df, column))
    labels = index_table(counts, column, out, single_task_rows).drop("n")
    return lookup_join(df, labels, column, salt_by=row_id, broadcast_bytes=broadcast_bytes)


def frequencies(df: DataFrame, columns, weight: str | None = None) -> DataFrame:
    """``(column, value, n)`` of several text columns in one pass over ``df``."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    )
    n = F.lit(1) if weight is None else F.col(weight)
    return (
        df.select(n.alias("_n"), F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.sum("_n").alias("n"))
    )


def index_columns(df: DataFrame, columns, row_id, weight: str | None = None) -> DataFrame:
    """Add the index column of each of ``columns``.

    One pass counts the values of all of them, one small job sizes the tables.
    """
    if not columns:
        return df
    counts = checkpointed(frequencies(df, columns, weight))
    sized = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(counts)).alias("bytes")
    )
    # One row per indexed column.
    sizes = {r["column"]: (r["rows"], r["bytes"]) for r in sized.collect()}
    for column in columns:
        rows, size = sizes.get(column, (0, 0))
        own = counts.filter(F.col("column") == column).select(F.col("value").alias(column), "n")
        labels = index_table(own, column, INDEX_COLUMNS[column], rows=rows).drop("n")
        df = lookup_join(df, labels, column, salt_by=row_id, dim_bytes=size)
    return df


def vector_stages(preset: Preset) -> list:
    stages = [VectorAssembler(inputCols=list(preset.inputs), outputCol=preset.vector)]
    if preset.normalized:
        stages.append(
            Normalizer(inputCol=preset.vector, outputCol=preset.normalized, p=2.0)
        )
    return stages


def assemble(df: DataFrame, preset: str) -> DataFrame:
    """Vector columns of a preset over rows that already have its inputs."""
    return Pipeline(stages=vector_stages(PRESETS[preset])).fit(df).transform(df)


def feature_table(df: DataFrame, preset: str, row_id: str) -> DataFrame:
    """Index, assemble and normalise in one call."""
    return assemble(index_columns(df, PRESETS[preset].indexed, row_id), preset)


def ml_feature_model(df: DataFrame, preset: str):
    """The same feature set as one fitted, saveable Spark ML model.

    The label lists of a ``StringIndexer`` live in the model, so this is for
    columns with few values; ``feature_table`` has no such bound.
    """
    chosen = PRESETS[preset]
    indexers = [
        StringIndexer(inputCol=c, outputCol=INDEX_COLUMNS[c], handleInvalid="keep")
        for c in chosen.indexed
    ]
    return Pipeline(stages=indexers + vector_stages(chosen)).fit(df)


def l2_normalize(df: DataFrame, vector: str = "features", out: str = "features_normalized"):
    return Normalizer(inputCol=vector, outputCol=out, p=2.0).transform(df)


def standard_scale(df: DataFrame, vector: str = "features", out: str = "featuresScaled"):
    scaler = StandardScaler(withMean=True, withStd=True, inputCol=vector, outputCol=out)
    return scaler.fit(df).transform(df)


def one_hot(df: DataFrame, column: str = "requestIndex", out: str = "requestVec"):
    return OneHotEncoder(inputCol=column, outputCol=out).fit(df).transform(df)


def vector_index(
    df: DataFrame, vector: str = "features", out: str = "featuresIndexed", max_categories=20
):
    indexer = VectorIndexer(inputCol=vector, outputCol=out, maxCategories=max_categories)
    return indexer.fit(df).transform(df)
