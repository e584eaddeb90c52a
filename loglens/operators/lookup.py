"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from loglens.session import literal_rows

BROADCAST_BYTES = 64 * 1024 * 1024
# Items that the hot-key sketch follows: so many for each partition, within these
# bounds, the upper one being the most that the sketch function takes.
_ITEMS_PER_PARTITION = 10
_SKETCH_ITEMS = (10_000, 1_000_000)


def _value_bytes(column: Column, spark_type) -> Column:
    if isinstance(spark_type, StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + 16
    if isinstance(spark_type, StructType):
        total = F.lit(16).cast("bigint")
        for field in spark_type.fields:
            total = total + _value_bytes(column[field.name], field.dataType)
        return total
    if isinstance(spark_type, ArrayType):
        return F.coalesce(F.size(column), F.lit(0)).cast("bigint") * 16 + 16
    return F.lit(16).cast("bigint")


def row_bytes(df: DataFrame) -> Column:
    row = F.lit(32).cast("bigint")
    for field in df.schema.fields:
        row = row + _value_bytes(F.col(f"`{field.name}`"), field.dataType)
    return row


def measured_bytes(df: DataFrame) -> int:
    """Bytes held by the rows of ``df``: one number reaches the driver."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()["bytes"]


def hot_keys(facts: DataFrame, key: str, partitions: int):
    """Keys with more rows than an average shuffle partition, and their pieces.

    One pass with a frequent-items sketch whose size follows the number of
    partitions, as fewer keys than partitions can be above the average. The number
    of pieces of a key is its row count in units of an average partition, so all
    pieces together are at most twice the number of partitions.
    """
    least, most = _SKETCH_ITEMS
    followed = min(most, max(least, _ITEMS_PER_PARTITION * partitions))
    row = facts.agg(
        F.count(F.lit(1)).alias("total"),
        F.expr(f"approx_top_k(`{key}`, {min(partitions, followed)}, {followed})").alias("top"),
    ).first()
    share = max(row["total"] / partitions, 1.0)
    return [
        (item["item"], int(-(-item["count"] // share)))
        for item in row["top"] or []
        if item["item"] is not None and item["count"] > share
    ]


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    salt_by,
    residual=None,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    dim_bytes: int | None = None,
) -> DataFrame:
    """Join ``facts`` to ``dim`` on ``key`` (plus ``residual(facts, dim)``).

    * ``dim`` measured within ``broadcast_bytes`` (here, or by the caller as
      ``dim_bytes``): broadcast, facts do not move.
    * otherwise a shuffled join in which the rows of each hot key are spread
      over several pieces by a hash of the unique column(s) ``salt_by``, and the
      matching ``dim`` rows are repeated once per piece.

    The keys of a stream cannot be counted ahead, so its rows are not spread.
    Columns of ``facts`` that ``dim`` has as well are replaced by those of ``dim``.
    """
    spark = facts.sparkSession
    facts = facts.drop(*[c for c in dim.columns if c != key])
    columns = facts.columns + [c for c in dim.columns if c != key]
    ids = [salt_by] if isinstance(salt_by, str) else list(salt_by)
    if dim_bytes is None:
        dim_bytes = measured_bytes(dim)
    small = dim_bytes <= broadcast_bytes
    salted = not small and not facts.isStreaming
    if salted:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        schema = StructType([facts.schema[key]]).add("_pieces", IntegerType())
        # At most one row per shuffle partition, see hot_keys.
        pieces = F.broadcast(literal_rows(spark, hot_keys(facts, key, partitions), schema))
        # Rows without a key match nothing, so they may go anywhere.
        spread = F.when(F.col(key).isNull(), partitions).otherwise(
            F.coalesce("_pieces", F.lit(1))
        )
        facts = (
            facts.join(pieces, key, "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*ids), spread.cast("bigint")).cast("int"))
            .drop("_pieces")
        )
        dim = (
            dim.join(pieces, key, "left")
            .withColumn(
                "_salt",
                F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)),
            )
            .drop("_pieces")
        )
    keys = [key, "_salt"] if salted else [key]
    renamed = dim
    for name in keys:
        renamed = renamed.withColumnRenamed(name, f"_dim_{name}")
    condition = facts[keys[0]] == renamed[f"_dim_{keys[0]}"]
    for name in keys[1:]:
        condition = condition & (facts[name] == renamed[f"_dim_{name}"])
    if residual is not None:
        condition = condition & residual(facts, renamed)
    right = F.broadcast(renamed) if small else renamed
    joined = facts.join(right, condition, how)
    return joined.select(*[F.col(f"`{name}`") for name in columns])
