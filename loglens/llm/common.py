"""Helpers of the corpus operators: columns by position, Arrow batches, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.session import (  # noqa: F401
    checkpointed,
    discard,
    new_path,
    shuffles_released,
    written,
)

# Text bytes that one Python step holds at a time, whatever the Arrow batch size.
SLICE_BYTES = 4 * 1024 * 1024


def ship(module_name):
    """Send the functions of a module with their tasks; executors need no copy."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def worker_cache() -> dict:
    """Objects that outlive a task in a reused Python worker, such as tokenizers."""
    name = "_loglens_llm_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def pick(df: DataFrame, **columns) -> DataFrame:
    """``new_name=old_name`` by exact name and position.

    Other columns never matter, not even ones that differ only in case or repeat
    a name; of repeated names the first counts.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.select(
        *[F.col(f"_c{names.index(old)}").alias(new) for new, old in columns.items()]
    )


def text_slices(batch: pa.RecordBatch, column: str, limit=SLICE_BYTES):
    """Zero-copy slices of a batch with a bounded number of text bytes.

    A single longer text is a slice of its own.
    """
    values = batch.column(column)
    if not pa.types.is_large_string(values.type) and not pa.types.is_string(values.type):
        values = values.cast(pa.large_string())
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str):
    """Python strings; null counts as empty."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def placed_rows(rows: DataFrame, group: str, order) -> DataFrame:
    """Adds ``pos``, the place of a row in its ``group``, and ``n``, the group's rows.

    Ranges of (group, order) are sorted and written with a number that fixes their
    order; places follow from the counts of each group in each range. No task holds a
    group, and a lost task gets the same places again. ``group`` must not be null.
    """
    ordered = (
        rows.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("at", F.monotonically_increasing_id())
    )
    ordered = written(ordered, "placed")
    part = F.shiftright("at", 33)
    # One row for each group and range.
    runs = ordered.groupBy(group, part.alias("part")).agg(
        F.count("*").alias("held"), F.min("at").alias("first")
    )
    whole = Window.partitionBy(group)
    starts = runs.select(
        group,
        "part",
        (F.sum("held").over(whole.orderBy("part")) - F.col("held") - F.col("first")).alias("shift"),
        F.sum("held").over(whole).alias("n"),
    )
    return (
        ordered.withColumn("part", part)
        .join(starts, [group, "part"])
        .withColumn("pos", F.col("at") + F.col("shift"))
        .drop("at", "part", "shift")
    )


def text_function(make, returns, limit=SLICE_BYTES):
    """A column function of a text column; ``make()`` gives ``texts -> Arrow array``.

    Python sees the texts only, in bounded slices: the other columns of a row wait in the
    JVM, which may spill them. It is evaluated once a row.
    """

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for texts in arrays:
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            parts = text_slices(batch, "text", limit)
            made = [function(texts_of(part, "text")) for part in parts]
            # The next batch is read while this one is no longer held.
            del texts, batch, parts
            yield pa.concat_arrays(made) if made else function([])

    return F.arrow_udf(run, returnType=returns).asNondeterministic()


def by_position(df: DataFrame) -> DataFrame:
    """Columns named by their place, whatever their names; ``toDF`` gives them back."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def components(edges: DataFrame, max_rounds=64) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the least node it reaches.

    Each round takes the least label among neighbours and then the label of that
    label (pointer jumping), so long chains need a logarithmic number of rounds.
    Rounds end in reliable checkpoints. Nodes may be of any orderable type.
    """
    both = checkpointed(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    )
    labels = checkpointed(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
    )
    for _ in range(max_rounds):
        # Least label among the neighbours of every member, given to the label itself.
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("other")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("other").alias("other"))
        )
        hooked = labels.join(near, "node").select(
            "node", "root", F.least("root", "other").alias("best")
        )
        roots = hooked.groupBy(F.col("root").alias("label")).agg(F.min("best").alias("new"))
        moved = checkpointed(
            hooked.join(roots, hooked["root"] == roots["label"]).select(
                "node", F.col("root").alias("old"), F.least("best", "new").alias("root")
            )
        )
        jump = moved.select(F.col("node").alias("label"), F.col("root").alias("further"))
        labels_next = checkpointed(
            moved.join(jump, moved["root"] == jump["label"], "left").select(
                "node", "old", F.least("root", F.coalesce("further", "root")).alias("root")
            )
        )
        settled = labels_next.filter("old <> root").isEmpty()
        labels = labels_next.select("node", "root")
        if settled:
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


ship(__name__)
