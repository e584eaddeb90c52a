"""Training corpus pipeline: toxic documents out, copies out, repeats out, packed.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table, which is written as
Parquet in the shared folder and read again as the next stage's ``docs``. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from loglens.llm import exact_dedup, packing, shingle_join, suffix_dedup, toxicity
from loglens.session import written

# Stages 3, 6, 8 and 5 have no SQL equivalent; tests compare with brute force.
ORACLE_SQL = None


def toxicity_stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Documents that do not score as toxic; labels of ``sf_dir`` train the scores."""
    known = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(known, labels))


def exact_dedup_stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """The document with the largest id of each group of equal texts."""
    return exact_dedup.distinct_documents(docs)


def jaccard_stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """The document with the least id of each group of near copies."""
    return shingle_join.one_of_each(docs)


def suffix_stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """All documents, without the strings of 200 bytes that repeat."""
    return suffix_dedup.documents_without_repeats(docs)


def packing_stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Token pieces with their places in sequences."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed_documents(docs, path, encode_special_tokens=False)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("suffix_dedup", suffix_stage),
    ("packing", packing_stage),
]


def run(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
