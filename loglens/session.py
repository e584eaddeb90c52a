"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType


def build_session(app_name="loglens", master=None, **settings):
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there the driver
    and all tasks share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loglens-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def literal_rows(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """A few known rows as a table that needs no Python workers; any value may be null."""
    schema = StructType([StructField(f.name, f.dataType) for f in schema.fields])
    values = [
        F.struct(
            *[
                F.lit(value).cast(field.dataType).alias(field.name)
                for value, field in zip(row, schema.fields)
            ]
        )
        for row in rows
    ]
    table = F.array(*values).cast(ArrayType(schema))
    return spark.range(1).select(F.inline(table))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes ``path``, wherever it is stored; nothing happens where it does not exist."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def publish_folder(spark: SparkSession, staged: str, final: str) -> None:
    """Gives a finished folder its name at once, so that readers see all of it or nothing.

    Needs a store that renames folders atomically, and both paths in that store.
    """
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = make(final)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    if not store.rename(make(staged), target):
        raise OSError(f"cannot rename {staged} to {final}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as typed parquet in the shared folder and read it back.

    Later passes then scan only the columns they use instead of repeating the
    work that produced ``df``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(table: DataFrame) -> None:
    """Deletes what ``written`` stored for ``table``, once no plan reads it any more."""
    remove_folder(table.sparkSession, table.written_path)


@contextmanager
def shuffles_released(spark: SparkSession):
    """Within, each execution deletes its shuffle files at its end.

    Else they stay until the driver happens to collect its garbage. For executions that
    end in a written table or a reliable checkpoint, so that nothing reads them again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def spread_small_input(df: DataFrame) -> DataFrame:
    """Use every core for a table stored in fewer scan tasks than there are cores.

    For work that costs far more per row than moving the row, such as parsing.
    A table with enough scan tasks, and a stream, stays as it is.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def cached(df: DataFrame):
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()
