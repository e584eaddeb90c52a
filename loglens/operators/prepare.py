"""Projection and cleaning of log records before feature extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions.parsing import text_to_double

FEATURE_COLUMNS = ("city_name", "latitude", "longitude", "verb", "response", "request")


def project_log_features(logs: DataFrame, keep=()) -> DataFrame:
    return logs.select(
        *keep, "geoip.city_name", "geoip.latitude", "geoip.longitude", "verb", "response", "request"
    )


def response_to_double(df: DataFrame) -> DataFrame:
    return df.withColumn("response", text_to_double(F.col("response")))


def drop_null_rows(df: DataFrame, columns=FEATURE_COLUMNS) -> DataFrame:
    return df.na.drop(how="any", subset=list(columns))


def is_complete(df: DataFrame, columns=FEATURE_COLUMNS) -> Column:
    """True for the rows that :func:`drop_null_rows` keeps: no NULL, no NaN."""
    there = F.lit(True)
    for name in columns:
        there &= F.col(name).isNotNull()
        if df.schema[name].dataType.typeName() in ("double", "float"):
            there &= ~F.isnan(name)
    return there


def feature_rows(logs: DataFrame, keep=()) -> DataFrame:
    return drop_null_rows(response_to_double(project_log_features(logs, keep)))


def has_rows(df: DataFrame, more_than: int = 0) -> bool:
    """Whether ``df`` has more than ``more_than`` rows (a small number)."""
    if more_than == 0:
        return not df.isEmpty()
    return len(df.select(F.lit(1)).take(more_than + 1)) > more_than


def accumulate(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Bag union by column name; a column one side lacks is NULL there."""
    return history.unionByName(batch, allowMissingColumns=True)
