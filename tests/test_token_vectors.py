import pytest
from pyspark.sql import functions as F

from loglens.operators import models, token_vectors


def _requests(spark):
    """Two kinds of pages with words of their own, some requests repeated."""
    rows = []
    for i in range(120):
        kind = "shop" if i % 2 else "blog"
        words = [f"{kind}{(i * 7 + j) % 20}" for j in range(1, 4)]
        rows += [("/" + "/".join([kind, *words, "end"]),)] * (1 + i % 3)
    rows += [("/alone",), ("/",), ("",), (None,)]
    return spark.createDataFrame(rows, "request string").withColumn(
        "row_id", F.monotonically_increasing_id()
    )


def test_cooccurrences(spark):
    df = spark.createDataFrame([("/a/b/a",), ("/a/b/a",), ("x",), (None,)], "request string")
    found = token_vectors.cooccurrences(token_vectors.weighted_requests(df), reach=1)
    assert {(r["word"], r["other"]): r["n"] for r in found.collect()} == {("a", "b"): 4, ("b", "a"): 4}
    wide = token_vectors.cooccurrences(token_vectors.weighted_requests(df))
    assert {(r["word"], r["other"]): r["n"] for r in wide.collect()}["a", "a"] == 4


def test_words_of_one_kind_are_near(spark):
    requests = token_vectors.weighted_requests(_requests(spark))
    vectors = token_vectors.token_vectors(requests, size=8)
    near = token_vectors.nearest_tokens(vectors, asked=40, k=3).collect()
    kinds = [(r["word"][:4], r["neighbour"][:4]) for r in near if "end" not in (r["word"], r["neighbour"])]
    assert len(kinds) > 90
    assert sum(a == b for a, b in kinds) / len(kinds) > 0.95
    assert {r["rank"] for r in near} == {1, 2, 3}


def test_request_vectors(spark):
    df = _requests(spark)
    for row_id in ("row_id", None):
        found = token_vectors.request_vectors(df, size=4, row_id=row_id)
        assert found.columns == ["request", "row_id", "requestWords"]
        rows = found.collect()
        assert len(rows) == df.count()
        for r in rows:
            empty = r["request"] in (None, "", "/", "/alone")
            assert r["requestWords"].size == 4 and empty == (not any(r["requestWords"]))


def test_group_means(spark):
    rows = [(0, [1.0, None]), (0, [3.0, 4.0]), (1, None), (1, []), (2, [None, 1.0])]
    df = spark.createDataFrame(rows, "label int, v array<double>")
    found = {(r["label"], r["dim"]): r["mean"] for r in models.group_means(df, "v", "label").collect()}
    assert found == {(0, 0): 2.0, (0, 1): 4.0, (2, 0): None, (2, 1): 1.0}
    plan = models.group_means(df, "v", "label")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")
    assert models.group_means(df.limit(0), "v", "label").count() == 0
    with pytest.raises(Exception):
        models.group_means(df.union(df.selectExpr("label", "array(1D)")), "v", "label").collect()
