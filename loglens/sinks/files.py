"""File sinks. A minute is a partition that a later run of it replaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions.parsing import minute_stamp
from loglens.operators.jsonflat import CSV_PART_BYTES, csv_parts, flatten_json
from loglens.session import written


def with_minute(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """Add the ``minute`` partition column; without ``ts`` the current minute."""
    return df.withColumn("minute", minute_stamp(F.current_timestamp() if ts is None else ts))


def _by_minute(df: DataFrame, single_file: bool):
    # Rows of a minute come together in tasks of the advisory size: few rows give one file, a
    # minute that holds most rows is split.
    df = df.coalesce(1) if single_file else df.hint("rebalance", "minute")
    return (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("minute")
    )


def cluster_csv_sink(
    df: DataFrame,
    path: str,
    columns=("verb", "clusters", "precision"),
    single_file: bool = False,
) -> None:
    """CSV with header per minute. ``single_file`` is for small rule sets."""
    _by_minute(df.select("minute", *columns), single_file).option("header", True).csv(path)


def rule_text_sink(rules: DataFrame, path: str, single_file: bool = False) -> None:
    """Rule lines per minute."""
    _by_minute(rules.select("minute", "rule"), single_file).text(path)


def union_header_csv(flat: DataFrame, path: str, part_bytes: int = CSV_PART_BYTES) -> None:
    """Flattened documents as CSV whose header is the sorted union of all keys.

    Any number of keys: they are numbered in order by a distributed sort, a document meets the
    numbers of its own members, and its line is those cells with the commas between them. Every
    file begins with the header, a row as long as the lines. Keys never reach the driver.
    Lines are written as they are, so white space in values is kept. Only members are
    written, also ones named like a carried column.
    """
    csv_parts(flat, part_bytes).write.mode("overwrite").text(path)


def json_to_csv(df: DataFrame, doc_id: str, text: str, path: str) -> DataFrame:
    """Flatten a JSON text column into CSV files; returns the quarantined rows."""
    flat, bad = flatten_json(df, doc_id, text)
    union_header_csv(written(flat, "flat-json"), path)
    return bad


def console_sink(df: DataFrame, rows: int = 20):
    """Debugging aid: schema and first rows, or a running console stream."""
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", rows).start()
    df.printSchema()
    return df.show(rows, truncate=False)
