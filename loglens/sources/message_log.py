"""Messages in files, with topic, partition and offset: a log that needs no broker.

The columns are those of the Kafka source, so readers take either. A topic is a folder of
finished batches; the file stream remembers which of them it has read, and a repeated
batch of the writer finds its first attempt and leaves it as it is.

Defined results: messages with one key share a partition and keep the order in which
the batch holds them; messages without a key are dealt in turn. Offsets of a partition
start at 0 and have no gaps. A topic has one writer (one streaming query); another one raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from loglens.operators.ordering import running_totals
from loglens.session import cached, folder_exists, new_path, publish_folder
from loglens.sources.kafka import DEFAULT_TOPIC, kafka_payload, key_value_text
from loglens.streaming.ingest import query_id
from loglens.streaming.running_counts import RunningCounts

PARTITIONS = 8
# Columns of a message as the Kafka source gives them.
MESSAGE_SCHEMA = (
    StructType()
    .add("key", BinaryType())
    .add("value", BinaryType())
    .add("topic", StringType())
    .add("partition", IntegerType())
    .add("offset", LongType())
    .add("timestamp", TimestampType())
)
_COUNTS_SCHEMA = StructType().add("partition", IntegerType()).add("n", LongType())
_MESSAGES = "messages"


def key_partition(key: Column, row: Column, partitions: int = PARTITIONS) -> Column:
    """The partition of a key by its md5; rows without a key are dealt by their number."""
    leading = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(F.coalesce(leading, row), F.lit(partitions)).cast("int")


def _counts(path: str, topic: str, query: str) -> RunningCounts:
    return RunningCounts(f"{path}/{topic}/counts", query, weight="n")


def _claim(spark: SparkSession, path: str, topic: str, query: str) -> None:
    """Notes the writer of a topic; offsets of two writers would collide."""
    folder = f"{path}/{topic}/writer"
    spark.range(1).select(F.lit(query).alias("value")).write.mode("ignore").text(folder)
    owner = spark.read.text(folder).first()
    if owner is None or owner["value"] != query:
        raise ValueError(f"topic {topic} is written by another query")


def append_batch(
    payload: DataFrame, path: str, topic: str, query: str, batch_id: int, partitions=PARTITIONS
) -> None:
    """Adds ``(key, value)`` rows as batch ``batch_id``; a finished batch stays as it is.

    Rows are numbered by the ranges of :func:`running_totals`, not by partition: a
    partition that holds most messages is spread like the others.
    """
    spark = payload.sparkSession
    _claim(spark, path, topic, query)
    final = f"{path}/{topic}/{_MESSAGES}/{batch_id}"
    counts = _counts(path, topic, query)
    if not folder_exists(spark, final):
        rows = payload.withColumn("_row", F.monotonically_increasing_id())
        rows = rows.withColumn("partition", key_partition(F.col("key"), F.col("_row"), partitions))
        with cached(rows):
            # One row per partition: of this batch, and of the batches before.
            own = rows.groupBy("partition").agg(F.count("*").alias("n"))
            before = own.select("partition", F.lit(0).cast("bigint").alias("n"))
            if batch_id:
                before = counts.totals(spark, _COUNTS_SCHEMA, batch_id - 1)
            starts = before.withColumnRenamed("n", "start").join(own, "partition", "right")
            ahead = starts.select("partition", "n", F.coalesce("start", F.lit(0)).alias("start"))
            held = F.array_sort(F.collect_list(F.struct("partition", "n", "start")))
            # At most ``partitions`` rows.
            known = ahead.agg(held.alias("held")).first()["held"]
            shift, seen = {}, 0
            for row in known:
                shift[row["partition"]] = row["start"] - seen - 1
                seen += row["n"]
            numbered = running_totals(
                rows, [F.asc("partition"), F.asc("_row")], {"_number": F.lit(1)}, rows=seen
            )
            moved = F.lit(0).cast("bigint")
            if shift:
                pairs = [F.lit(x) for pair in shift.items() for x in pair]
                moved = F.create_map(*pairs)[F.col("partition")].cast("bigint")
            staged = new_path(spark, "messages")
            numbered.select(
                F.col("key").cast("binary").alias("key"),
                F.col("value").cast("binary").alias("value"),
                F.lit(topic).alias("topic"),
                "partition",
                (F.col("_number") + moved).alias("offset"),
                F.current_timestamp().alias("timestamp"),
            ).write.parquet(staged)
        publish_folder(spark, staged, final)
    stored = spark.read.schema(MESSAGE_SCHEMA).parquet(final)
    counts.add(stored.groupBy("partition").agg(F.count("*").alias("n")), batch_id)


def message_log_sink(
    df: DataFrame, path: str, checkpoint: str, topic=DEFAULT_TOPIC, key=None, partitions=PARTITIONS
):
    """A stream writer ready to ``start()``: whole rows as JSON, as for the Kafka sink."""

    def append(batch: DataFrame, batch_id: int) -> None:
        query = query_id(batch.sparkSession, checkpoint)
        append_batch(kafka_payload(batch, key), path, topic, query, batch_id, partitions)

    return df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)


def _folders(path: str, topics) -> str:
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    return f"{path}/{{{','.join(n.strip() for n in names if n.strip())}}}/{_MESSAGES}/*"


def from_offsets(messages: DataFrame, starting: dict | None) -> DataFrame:
    """Messages from ``{topic: {partition: offset}}`` on; others from their start."""
    for topic, offsets in (starting or {}).items():
        for partition, offset in offsets.items():
            own = (F.col("topic") == topic) & (F.col("partition") == int(partition))
            messages = messages.filter(~own | (F.col("offset") >= offset))
    return messages


def read_messages(spark: SparkSession, path: str, topics=DEFAULT_TOPIC, starting=None):
    """All messages of the topics now, with their places."""
    stored = spark.read.schema(MESSAGE_SCHEMA).parquet(_folders(path, topics))
    return from_offsets(stored, starting)


def message_log_source(
    spark: SparkSession, path: str, topics=DEFAULT_TOPIC, starting=None, **options
) -> DataFrame:
    """``(key, value, row_id)`` as a stream, like ``kafka_source``; each message once.

    ``maxFilesPerTrigger`` and the other options of a file stream bound a batch.
    """
    reader = spark.readStream.schema(MESSAGE_SCHEMA).options(**options)
    stored = reader.parquet(_folders(path, topics))
    return key_value_text(from_offsets(stored, starting), position=True)
