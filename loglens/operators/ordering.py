"""Running totals over a global order without sending all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.session import checkpointed

SINGLE_TASK_ROWS = 1_000_000


def running_totals(
    df: DataFrame, order: list, totals: dict, rows: int | None = None, single_task_rows=None
) -> DataFrame:
    """Add, for each ``name -> column`` of ``totals``, its running sum in ``order``.

    ``order`` must be a total order. Up to ``single_task_rows`` rows one window
    does it. Beyond that the rows are range-partitioned, the partition number is
    fixed by a reliable checkpoint, and each partition starts from the sum of the
    partitions before it.
    """
    limit = SINGLE_TASK_ROWS if single_task_rows is None else single_task_rows
    rows = df.count() if rows is None else rows
    upto_here = (Window.unboundedPreceding, Window.currentRow)
    if rows <= limit:
        window = Window.orderBy(*order).rowsBetween(*upto_here)
        return df.withColumns({n: F.sum(c).over(window) for n, c in totals.items()})

    spark = df.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // limit))
    ranged = checkpointed(
        df.repartitionByRange(partitions, *order).withColumn("_part", F.spark_partition_id())
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = (
        ranged.groupBy("_part")
        .agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
        .select(
            "_part",
            *[
                F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_start_{n}")
                for n in totals
            ],
        )
    )
    window = Window.partitionBy("_part").orderBy(*order).rowsBetween(*upto_here)
    return (
        ranged.join(F.broadcast(starts), "_part")
        .withColumns(
            {n: F.sum(c).over(window) + F.col(f"_start_{n}") for n, c in totals.items()}
        )
        .drop("_part", *[f"_start_{n}" for n in totals])
    )
