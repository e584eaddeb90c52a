"""Log files, JSON records and rule CSV as DataFrames, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loglens.functions.once import evaluate_once
from loglens.schema import LOG_SCHEMA

# Fixed value: tag of lines read from web-server log files.
LOG_TYPE = "apache-access"


def log_file_source(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Raw lines as ``(message, path, type)``, from the start of every file."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path).select(
        F.col("value").alias("message"),
        F.col("_metadata.file_path").alias("path"),
        F.lit(LOG_TYPE).alias("type"),
    )


def json_file_source(
    spark: SparkSession, path: str, schema: StructType | None = LOG_SCHEMA
) -> DataFrame:
    """JSON records, one per line. ``schema=None`` infers it, for exploration."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def message_file_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """``(key, value)`` messages from text files: the shape a broker delivers."""
    lines = spark.readStream.options(**options).text(path)
    return lines.select(F.lit(None).cast("string").alias("key"), "value")


_CORRUPT = "_corrupt_record"


def decode_messages(messages: DataFrame, schema: StructType = LOG_SCHEMA) -> DataFrame:
    """Parse ``value`` and add ``reason``, NULL for a good record.

    Fields the schema does not name are ignored, missing ones are NULL. A value
    that is not JSON, not an object, or has none of the fields is bad.
    """
    wide = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    record = F.from_json(
        "value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    parsed = evaluate_once(messages, "_record", record)
    known = F.lit(False)
    for field in schema.fields:
        known = known | F.col("_record")[field.name].isNotNull()
    reason = (
        F.when(F.col("value").isNull(), "missing value")
        .when(F.col("_record").isNull(), "malformed JSON")
        .when(F.col("_record")[_CORRUPT].isNotNull(), "malformed JSON")
        .when(~known, "no known field")
    )
    return parsed.withColumn("reason", reason)


def good_records(decoded: DataFrame, schema: StructType = LOG_SCHEMA, keep=()) -> DataFrame:
    fields = [F.col("_record")[f.name].alias(f.name) for f in schema.fields]
    return decoded.filter(F.col("reason").isNull()).select(*keep, *fields)


def bad_records(decoded: DataFrame, keep=()) -> DataFrame:
    return decoded.filter(F.col("reason").isNotNull()).select(*keep, "value", "reason")


def json_strings_to_table(messages: DataFrame, schema: StructType = LOG_SCHEMA, keep=()):
    """Typed records and quarantined messages of a ``value`` column."""
    decoded = decode_messages(messages, schema)
    return good_records(decoded, schema, keep), bad_records(decoded, keep)


def csv_rule_source(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rule table from CSV with a header line."""
    return spark.read.schema(schema).option("header", True).csv(path)


def register_view(df: DataFrame, name: str = "logs", cache: bool = False) -> DataFrame:
    """Name a table for SQL. A cached one is released with :func:`release_view`."""
    if cache:
        df.persist()
    df.createOrReplaceTempView(name)
    return df


def release_view(df: DataFrame, name: str = "logs") -> None:
    df.sparkSession.catalog.dropTempView(name)
    df.unpersist()
