"""Streaming ingest of JSON messages into an append-only table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loglens.schema import LOG_SCHEMA
from loglens.session import cached
from loglens.sources.logs import bad_records, decode_messages, good_records

# Fixed value: time between micro-batches.
BATCH_INTERVAL = "2 seconds"
# Partition columns of the tables that batches write.
QUERY_FIELD = StructField("query_id", StringType())
BATCH_FIELD = StructField("batch_id", LongType())


def trigger_options(available_now: bool = False, interval: str = BATCH_INTERVAL) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": interval}


def query_id(spark, checkpoint: str) -> str:
    """The id that Spark gave the query when it made its checkpoint.

    Batch numbers start anew with every checkpoint; the id tells them apart.
    """
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def replace_batch(df: DataFrame, path: str, query: str, batch_id: int) -> None:
    """A repeated batch replaces what its first attempt wrote, and nothing else."""
    df.write.mode("overwrite").parquet(f"{path}/query_id={query}/batch_id={batch_id}")


def ingest_logs(
    messages: DataFrame,
    table_path: str,
    quarantine_path: str,
    checkpoint: str,
    schema: StructType = LOG_SCHEMA,
    keep=(),
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
) -> StreamingQuery:
    """Append good records to one table and bad messages to another.

    Nothing accumulates in memory: history is the table, and every batch plan
    has the same size.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        query = query_id(batch.sparkSession, checkpoint)
        with cached(decode_messages(batch, schema)) as decoded:
            replace_batch(good_records(decoded, schema, keep), table_path, query, batch_id)
            replace_batch(bad_records(decoded, keep), quarantine_path, query, batch_id)

    return (
        messages.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(available_now, interval))
        .start()
    )


def read_ingested(spark, path: str, schema: StructType = LOG_SCHEMA, keep_fields=()) -> DataFrame:
    full = StructType([*keep_fields, *schema.fields, QUERY_FIELD, BATCH_FIELD])
    return spark.read.schema(full).parquet(path)


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; parquet may deliver it without a time zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
