"""Kafka source and sink. The connector package must be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: topic that collectors publish parsed records to.
DEFAULT_TOPIC = "logstash_logs"


def kafka_source_options(servers: str, topics, group: str | None = None, partitions=None, **extra):
    """Options for one or several topics (list or comma-separated text).

    ``partitions`` asks for at least that many parallel reads per batch.
    """
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(n.strip() for n in names if n.strip()),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if group:
        options["groupIdPrefix"] = group
    if partitions:
        options["minPartitions"] = str(partitions)
    return {**options, **extra}


def key_value_text(messages: DataFrame, position: bool = False) -> DataFrame:
    """Key and value as text; ``position`` adds ``row_id``, unique per message."""
    columns = ["CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value"]
    if position:
        columns.append("concat_ws('-', topic, partition, offset) AS row_id")
    return messages.selectExpr(*columns)


def kafka_source(spark: SparkSession, servers: str, topics=DEFAULT_TOPIC, **settings) -> DataFrame:
    """``(key, value, row_id)`` of every message; ``row_id`` is stable on replay."""
    options = kafka_source_options(servers, topics, **settings)
    return key_value_text(spark.readStream.format("kafka").options(**options).load(), position=True)


def kafka_payload(df: DataFrame, key: str | None = None) -> DataFrame:
    """``(key, value)`` with the whole row as JSON text."""
    key_text = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    return df.select(key_text.alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_sink_options(servers: str, topic: str = DEFAULT_TOPIC, **extra) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **extra}


def kafka_sink(df: DataFrame, servers: str, checkpoint: str, topic=DEFAULT_TOPIC, key=None):
    """A stream writer ready to ``start()``."""
    return (
        kafka_payload(df, key)
        .writeStream.format("kafka")
        .options(**kafka_sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
    )
