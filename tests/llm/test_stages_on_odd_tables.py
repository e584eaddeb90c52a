"""Stages of the pipeline on extra columns, nulls, repeated rows and nothing at all."""

import pytest

import corpus_pipeline
from brute import jaccard, repeats
from loglens.llm import exact_dedup, near_vectors, shingle_join, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 91}x{i}" for i in range(400))
TEXTS = [
    (1, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (3, None),
    (4, ""),
    (5, LONG),
    (6, LONG + " end"),
    (7, "start " + LONG[:900]),
    (None, "a text without an id"),
    (None, "another text without an id"),
    (8, "é" * 4000),
]


@pytest.fixture(scope="module")
def table(spark):
    """Names that differ in case, names with spaces, nested columns, many partitions."""
    spark.conf.set("spark.sql.caseSensitive", "true")
    made = spark.createDataFrame(TEXTS, "doc_id bigint, text string").selectExpr(
        "named_struct('my field', doc_id, 'a-b', array(named_struct('x y', text))) AS `odd name`",
        "doc_id",
        "map('k', text) AS row",
        "'T' AS TEXT",
        "text",
        "CAST(7 AS INT) AS n_chars",
        "1.5D AS score",
        "binary(text) AS key",
        "doc_id AS node",
        "text AS recipe",
    )
    made = made.repartition(3).cache()
    made.count()
    spark.conf.set("spark.sql.caseSensitive", "false")
    return made


def _whole(df, table):
    assert df.columns == table.columns and df.dtypes == table.dtypes
    rows = df.collect()
    for r in rows:
        assert r["odd name"]["my field"] == r[1] and r[3] == "T" and r[6] == 1.5
    return sorted(((r[1], r[4]) for r in rows), key=repr)


def test_exact(table):
    expected = [r for r in TEXTS if r[0] not in (1, 3)]
    expected.remove(TEXTS[1])
    assert _whole(exact_dedup.distinct_documents(table), table) == sorted(expected, key=repr)


def test_jaccard(table):
    rows = [(d, t) for d, t in TEXTS]
    heads = {d for d, _, c in jaccard(rows) if d == c and d is not None}
    found = _whole(shingle_join.one_of_each(table), table)
    assert {d for d, t in found if d is not None} == heads
    assert len(found) == len(heads) + 2


def test_suffixes(table):
    expected = [
        (d, None if t is None else kept.decode(errors="ignore"))
        for (d, t), (_, _, _, _, kept) in zip(TEXTS, repeats(TEXTS))
    ]
    found = suffix_dedup.documents_without_repeats(table)
    assert _whole(found, table) == sorted(expected, key=repr)
    assert all(r[5] == (7 if r[4] is None else len(r[4])) or r[4] is None for r in found.collect())


def test_toxicity(spark, table):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    state = toxicity.train(docs, labels)
    assert len(_whole(toxicity.without_toxic(table, state), table)) == len(TEXTS)
    scores = toxicity.score_documents(docs, state).filter("score < 0.5").count()
    assert toxicity.without_toxic(docs, state).count() == scores < docs.count()


def test_nothing(spark, table):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert found.count() == 0 and (name == "packing" or found.columns == docs.columns)


def test_extreme_vectors(spark):
    rows = [
        (1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 0.0]), (4, [1.0, 0.0]),
        (5, [0.0, 0.0]), (6, None), (7, [float("nan"), 1.0]), (8, [5e-324, 0.0]),
        (9, [1.7e308, 1.7e308]), (10, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors.near_duplicates(df).collect()}
    links = {1: (2, 1), 2: (2, 1), 9: (2, 1), 3: (2, 3), 4: (2, 3), 8: (2, 3)}
    assert found == {i: links.get(i, (0, i)) for i, _ in rows}
