"""Sliding window counts, over tables and over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from loglens.session import cached, remove_folder
from loglens.streaming.ingest import (
    BATCH_FIELD,
    BATCH_INTERVAL,
    QUERY_FIELD,
    event_time,
    query_id,
    replace_batch,
    trigger_options,
)

# Window length and slide.
WINDOW = "10 seconds"
SLIDE = BATCH_INTERVAL
LATENESS = "10 minutes"
# Why a row is in no window that still counts.
TOO_LATE = "behind the watermark"
NO_TIME = "no event time"


def window_counts(
    df: DataFrame, by=(), ts: str = "ts", window: str = WINDOW, slide: str = SLIDE,
    lateness: str = LATENESS,
) -> DataFrame:
    """Rows per window and group. On a stream, rows later than ``lateness`` behind
    the newest event time no longer count."""
    timed = event_time(df, ts)
    if df.isStreaming:
        timed = timed.withWatermark(ts, lateness)
    return (
        timed.groupBy(F.window(ts, window, slide).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n"
        )
    )


def minute_counts(df: DataFrame, by=(), ts: str = "ts", lateness: str = LATENESS) -> DataFrame:
    return window_counts(df, by, ts, "1 minute", "1 minute", lateness)


def _marks(checkpoint: str, query: str) -> str:
    return f"{checkpoint}/event-times/query_id={query}"


def _newest_before(spark, checkpoint: str, query: str, batch_id: int):
    """The newest event time of all batches before this one; null for the first."""
    if batch_id == 0:
        return None
    path = f"{_marks(checkpoint, query)}/{batch_id - 1}"
    return spark.read.schema("newest timestamp").parquet(path).first()["newest"]


def write_windows_and_late_rows(
    rows: DataFrame,
    path: str,
    late_path: str,
    checkpoint: str,
    by=(),
    ts: str = "ts",
    window: str = WINDOW,
    slide: str = SLIDE,
    lateness: str = LATENESS,
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
) -> StreamingQuery:
    """Count rows per window and group, and write the rows that no longer count.

    The watermark of a batch is the newest event time of the batches before it less
    ``lateness``, and a window is closed when it ends at or before that. (Spark's own watermark,
    as in :func:`window_counts`, drops such rows unseen, from one batch later on.) A batch adds the counts of its own
    rows to ``path`` (:func:`summed_windows` reads them) and its rows with a closed window to
    ``late_path``: all their columns, ``missed`` (how many windows have closed) and ``reason``.
    Rows without a time have no window and are written there as well. What a batch reads and
    writes depends on its own rows only, and a repeated batch replaces it.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        newest = _newest_before(spark, checkpoint, query, batch_id)
        mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
        with cached(event_time(batch, ts)) as timed:
            numbered = timed.withColumn("_row", F.monotonically_increasing_id())
            # Rows meet their windows by time alone; only the number of a row goes along.
            placed = numbered.select("_row", ts, *by, F.window(ts, window, slide).alias("_w"))
            closed = F.coalesce(F.col("_w.end") <= mark, F.lit(False))
            counts = (
                placed.filter(~closed)
                .groupBy(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by)
                .agg(F.count(F.lit(1)).alias("n"))
            )
            replace_batch(counts, path, query, batch_id)
            missed = placed.filter(closed).groupBy("_row").agg(F.count(F.lit(1)).alias("missed"))
            late = numbered.join(missed, "_row").withColumn("reason", F.lit(TOO_LATE))
            timeless = numbered.filter(F.col(ts).isNull()).withColumns(
                {"missed": F.lit(0).cast("bigint"), "reason": F.lit(NO_TIME)}
            )
            behind = late.unionByName(timeless).drop("_row")
            replace_batch(behind, late_path, query, batch_id)
            last = timed.agg(F.greatest(F.max(ts), F.lit(newest).cast("timestamp")).alias("newest"))
            last.write.mode("overwrite").parquet(f"{_marks(checkpoint, query)}/{batch_id}")
            if batch_id >= 2:
                # A repeat of this batch needs the one before it, no older one.
                remove_folder(spark, f"{_marks(checkpoint, query)}/{batch_id - 2}")

    return (
        rows.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(available_now, interval))
        .start()
    )


def summed_windows(spark, path: str, by_fields=()) -> DataFrame:
    """The counts that :func:`write_windows_and_late_rows` has written, per window."""
    fields = [StructField(c, TimestampType()) for c in ("window_start", "window_end")]
    fields += [*by_fields, StructField("n", LongType()), QUERY_FIELD, BATCH_FIELD]
    written_counts = spark.read.schema(StructType(fields)).parquet(path)
    keys = ["window_start", "window_end", *[f.name for f in by_fields]]
    return written_counts.groupBy(*keys).agg(F.sum("n").alias("n"))


def write_window_updates(
    counts: DataFrame, path: str, checkpoint: str, available_now: bool = False,
    interval: str = BATCH_INTERVAL,
) -> StreamingQuery:
    """Write the windows each batch changed; :func:`latest_windows` reads them."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch, path, query_id(batch.sparkSession, checkpoint), batch_id)

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(available_now, interval))
        .start()
    )


def latest_windows(spark, path: str, schema, by=()) -> DataFrame:
    """The last written count of every window; counts of several queries add up."""
    fields = StructType([*schema.fields, QUERY_FIELD, BATCH_FIELD])
    updates = spark.read.schema(fields).parquet(path)
    keys = ["window_start", "window_end", *by]
    of_query = updates.groupBy("query_id", *keys).agg(F.max_by("n", "batch_id").alias("n"))
    return of_query.groupBy(*keys).agg(F.sum("n").alias("n"))
