"""Exact dedup by content-defined chunk recipes.

Every text is cut where a rolling hash of its last bytes has a given value, so
equal texts have equal chunks. Chunks are deduplicated to identifiers, which are
verified against the bytes; texts are then equal when their ordered lists of
identifiers (recipes) are equal. Long texts move once, as chunks that are
combined before the shuffle; everything else moves recipes only.

Defined results: a null text is an empty one (recipe of no chunk); texts are
compared as UTF-8 bytes; rows without ``doc_id`` take part, and of a group the
row with the largest ``doc_id`` stays (null only if no row has one); of rows that
repeat both id and text :func:`distinct_documents` keeps one. An empty table
gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import (
    by_position,
    pick,
    ship,
    text_function,
    text_slices,
    texts_of,
    written,
)

# A chunk ends where the hash of the last WINDOW bytes has MASK bits zero.
WINDOW = 16
MASK = 2047
MIN_CHUNK, MAX_CHUNK = 512, 16384
ID_BYTES = 32
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(data: bytes) -> list[int]:
    """End offsets of the chunks of ``data``; they depend on nearby bytes only."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    hashed = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    hashed ^= hashed >> np.uint64(29)
    step = 1
    while step < WINDOW:
        factor = np.uint64(pow(0x100000001B3, step, 1 << 64))
        hashed = hashed[:-step] * factor + hashed[step:]
        step *= 2
    marks = np.flatnonzero((hashed >> np.uint64(40)) & np.uint64(MASK) == 0) + WINDOW
    ends, start = [], 0
    for mark in marks.tolist():
        while mark - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start)
        if mark - start >= MIN_CHUNK:
            ends.append(mark)
            start = mark
    while n - start > MAX_CHUNK:
        start += MAX_CHUNK
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunks(data: bytes) -> list[bytes]:
    ends = chunk_ends(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def recipe(data: bytes) -> bytes:
    """Chunk identifiers in order, joined; empty for an empty text."""
    return b"".join(hashlib.sha256(c).digest() for c in chunks(data))


def _recipe_batches(batches):
    for batch in batches:
        for part in text_slices(batch, "text"):
            data = [t.encode() for t in texts_of(part, "text")]
            kept = [part.column(i) for i, name in enumerate(part.schema.names) if name != "text"]
            names = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array([recipe(d) for d in data], pa.binary()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                ],
                names=[*names, "recipe", "text_sha256"],
            )


def _chunk_batches(batches):
    """Distinct chunks of a slice with their identifiers."""
    for batch in batches:
        for part in text_slices(batch, "text"):
            seen = {}
            for text in texts_of(part, "text"):
                for c in chunks(text.encode()):
                    seen[c] = None
            found = list(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.sha256(c).digest() for c in found], pa.binary()),
                    pa.array(found, pa.binary()),
                ],
                names=["chunk_id", "chunk"],
            )


def with_recipes(rows: DataFrame) -> DataFrame:
    """Replaces column ``text`` of ``rows`` by ``recipe`` and ``text_sha256``."""
    kept = [f.simpleString() for f in rows.schema.fields if f.name != "text"]
    fields = [f"`{k.split(':', 1)[0]}` {k.split(':', 1)[1]}" for k in kept]
    return rows.mapInArrow(
        _recipe_batches, ", ".join([*fields, "recipe binary", "text_sha256 string"])
    )


def chunk_table(docs: DataFrame, text="text") -> DataFrame:
    """``(chunk_id, variants)``: how many different byte strings an identifier names.

    The grouping key holds the bytes themselves, so one variant means verified.
    """
    found = pick(docs, text=text).mapInArrow(_chunk_batches, "chunk_id binary, chunk binary")
    stored = found.groupBy("chunk_id", "chunk").agg(F.count("*").alias("n"))
    return stored.groupBy("chunk_id").agg(F.count("*").alias("variants"))


def exact_groups(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """``(doc_id, recipe, text_sha256, keep_id, group_size)`` for every row."""
    _verify_chunks(docs, text)
    rows = written(with_recipes(pick(docs, doc_id=doc_id, text=text)), "recipes")
    groups = rows.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return rows.join(groups, "recipe")


def _verify_chunks(docs: DataFrame, text) -> None:
    if not chunk_table(docs, text).filter("variants > 1").isEmpty():
        raise ValueError("two different chunks share an identifier")


def distinct_documents(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    names = docs.columns
    at_id, at_text = (f"_c{names.index(c)}" for c in (doc_id, text))
    groups = (
        exact_groups(docs, doc_id, text)
        .filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("recipe")
        .agg(F.first("keep_id").alias("keep_id"), F.count("*").alias("holders"))
    )
    groups = written(groups, "recipe-groups")

    def recipes():
        return lambda texts: pa.array([recipe(t.encode()) for t in texts], pa.binary())

    recipe_of = text_function(recipes, "binary")
    rows = by_position(docs).withColumn("recipe", recipe_of(F.col(at_text)))
    kept = rows.join(groups, "recipe").filter(F.col(at_id).eqNullSafe(F.col("keep_id")))
    if not groups.filter("holders > 1").isEmpty():
        kept = kept.dropDuplicates(["recipe"])
    return kept.select(*[f"_c{i}" for i in range(len(names))]).toDF(*names)


def op9_query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = exact_groups(docs)
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


OP9_SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

ship(__name__)
