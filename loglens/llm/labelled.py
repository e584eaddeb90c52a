"""Bounded samples of labelled documents, and held-out rows by a checksum of the id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import pick


def held_out(doc_id, folds: int, fold: int):
    """True where crc32 of the id as text leaves ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, bound: int,
    doc_id="doc_id", text="text",
) -> DataFrame:
    """``(text, label)`` of at most ``bound`` labelled ids outside the held-out fold.

    The least hashes of the id are taken. The sample holds two numbers a row, so
    it is broadcast (``bound`` times 16 bytes) and texts do not move.
    """
    marked = pick(labels, doc_id="doc_id", label=label).filter(
        "doc_id is not null and label is not null"
    )
    sample = (
        marked.filter(~held_out(F.col("doc_id"), folds, fold))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    rows = pick(docs, doc_id=doc_id, text=text)
    return rows.join(F.broadcast(sample), "doc_id").select("text", F.col("label").cast("double"))
