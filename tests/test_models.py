import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from loglens.operators import features, metrics, models
from loglens.plans.log_analysis import analyse_combinations, analyse_logs
from loglens.schema import LOG_SCHEMA


def _rows(spark, n=600):
    pick = random.Random(3)
    data = []
    for i in range(n):
        x, y = pick.randint(0, 5), pick.randint(0, 3)
        label = float((x > 2) + (y > 1) if pick.random() < 0.9 else pick.randint(0, 2))
        data.append((i, float(x), float(y), label))
    return spark.createDataFrame(data, "row_id int, x double, y double, label double"), data


def test_default_descent_stops_after_two_steps(spark):
    # mean(x * y) = 4.8: two steps of 1e-15 give 4.8e-15 * (1 + 1/sqrt(2)).
    df = spark.createDataFrame([(2.0, 2.0), (2.8, 2.0)], "x double, label double")
    (weight,) = models.linear_sgd(df, ("x",))
    assert weight == pytest.approx(4.8e-15 * (1 + 1 / math.sqrt(2)), rel=1e-9)


def test_descent_with_intercept_matches_numpy(spark):
    df, data = _rows(spark)
    found = models.linear_sgd(
        df, ("x", "y"), iterations=50, step=0.1, tolerance=0.0, intercept=True
    )
    a = np.array([[x, y, 1.0] for _, x, y, _ in data])
    b = np.array([label for *_, label in data])
    w = np.zeros(3)
    for t in range(1, 51):
        w -= 0.1 / math.sqrt(t) * a.T @ (a @ w - b) / len(b)
    assert found == pytest.approx(list(w), abs=1e-9)
    scored = models.predict_linear(df, ("x", "y"), found).orderBy("row_id").collect()
    assert [r["prediction"] for r in scored] == pytest.approx(list(a @ w), abs=1e-9)


def test_least_squares_matches_numpy(spark):
    df, data = _rows(spark)
    fitted = models.fit_weighted(df, "linear", ("x", "y"))
    a = np.array([[x, y, 1.0] for _, x, y, _ in data])
    expected, *_ = np.linalg.lstsq(a, np.array([d[3] for d in data]), rcond=None)
    assert [*fitted.model.coefficients, fitted.model.intercept] == pytest.approx(list(expected))


def _on_all_rows(df, estimator):
    return estimator.fit(models.vectors(df, ("x", "y")))


def test_grouped_fit_equals_fit_on_all_rows(spark):
    df, _ = _rows(spark)
    grouped = models.fit_weighted(df, "logistic", ("x", "y"), tol=1e-9)
    plain = _on_all_rows(df, LogisticRegression(family="multinomial", tol=1e-9))
    assert np.allclose(
        grouped.model.coefficientMatrix.toArray(), plain.coefficientMatrix.toArray(), atol=1e-4
    )
    tree = models.fit_weighted(df, "tree", ("x", "y"))
    plain = _on_all_rows(df, DecisionTreeClassifier(maxDepth=10, maxBins=1000))
    ready = models.vectors(df, ("x", "y"))
    both = tree.score(df, keep=("row_id",)).join(
        plain.transform(ready).select("row_id", F.col("prediction").alias("other")), "row_id"
    )
    assert both.filter("prediction <> other").isEmpty()
    net = models.fit_weighted(df, "elastic_net", ("x", "y"))
    plain = _on_all_rows(df, LinearRegression(**models.ELASTIC_NET))
    assert list(net.model.coefficients) == pytest.approx(list(plain.coefficients), abs=1e-6)


def test_naive_bayes_parameters(spark):
    df, data = _rows(spark)
    model = models.fit_weighted(df, "naive_bayes", ("x", "y")).model
    found = {
        (r["label"], r["feature"]): (r["log_prior"], r["log_likelihood"])
        for r in models.naive_bayes_parameters(df, ("x", "y")).collect()
    }
    for c in range(3):
        for f, name in enumerate(("x", "y")):
            prior, likelihood = found[float(c), name]
            assert prior == pytest.approx(math.log((sum(d[3] == c for d in data) + 1) / (600 + 3)))
            assert likelihood == pytest.approx(model.theta.toArray()[c, f])


def test_kmeans_numbers_clusters_by_centre(spark):
    df = spark.createDataFrame(
        [(i, float(i % 3) * 10 + (i % 7) / 100) for i in range(300)], "row_id int, x double"
    )
    for seed in (1, 2, 3):
        found = models.fit_kmeans(df, ("x",), k=3, seed=seed)
        made = found.assign(df).filter("clusters <> row_id % 3")
        assert made.isEmpty()
        centres = [r["center"][0] for r in found.centers(spark).orderBy("clusters").collect()]
        assert centres == pytest.approx([0.03, 10.03, 20.03], abs=0.001)


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,)], "x double")
    found = models.fit_kmeans(df, ("x",), k=5)
    assert {(r["x"], r["clusters"]) for r in found.assign(df).collect()} == {(0.0, 0), (1.0, 1)}


def test_nearest_centre_ties_go_to_the_smaller_number(spark):
    df = spark.createDataFrame([([0.0],), ([2.0],), ([1.0],)], "p array<double>")
    made = models.assign_nearest(df, "p", [(5, [2.0]), (3, [0.0])])
    assert [r["clusters"] for r in made.collect()] == [3, 5, 3]


def test_lloyd_keeps_empty_centres(spark):
    df = spark.createDataFrame([([0.0],), ([1.0],)], "p array<double>")
    made = models.lloyd(df, "p", [(0, [0.0]), (1, [100.0])], 3)
    assert {r["clusters"] for r in made.collect()} == {0}


def test_no_training_rows(spark):
    df, _ = _rows(spark)
    with pytest.raises(models.NoTrainingData):
        models.fit_weighted(df.limit(0), "tree", ("x",))


def test_vector_features(spark):
    df = spark.createDataFrame(
        [(1, 3.0, 4.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0, 0.0)],
        "row_id int, response double, requestIndex double, verbIndex double, geoIpCityNameIndex double",
    )
    made = features.assemble(df, "four").withColumn("u", vector_to_array("features_normalized"))
    assert {r["row_id"]: r["u"] for r in made.collect()} == {1: [0.6, 0.8, 0, 0], 2: [0, 0, 0, 0]}


def _brute_roc(pairs):
    pos = sum(label > 0.5 for _, label in pairs)
    neg = len(pairs) - pos
    points = [(0.0, 0.0)]
    for score in sorted({s for s, _ in pairs}, reverse=True):
        above = [label > 0.5 for s, label in pairs if s >= score]
        points.append(((len(above) - sum(above)) / neg, sum(above) / pos))
    return points + [(1.0, 1.0)]


def test_roc_and_area(spark):
    pick = random.Random(5)
    pairs = [(pick.randint(0, 40) / 7, float(pick.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "prediction double, label double")
    expected = _brute_roc(pairs)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(expected, expected[1:]))
    for limit in (None, 5):
        curve = metrics.roc_curve(df, single_task_rows=limit).orderBy("point").collect()
        assert np.allclose([(r["fpr"], r["tpr"]) for r in curve], expected)
        found = metrics.area_under_roc(df, single_task_rows=limit).first()["auc"]
        assert found == pytest.approx(area)
    one_class = df.filter("label = 0")
    assert metrics.area_under_roc(one_class).first()["auc"] is None
    assert metrics.area_under_roc(df, positive=0.0).first()["auc"] == pytest.approx(1 - area)


def test_weighted_metrics_equal_repeated_rows(spark):
    rows = [(1.0, 1.0, 3), (0.0, 1.0, 2), (2.0, 2.0, 4), (2.0, 0.0, 1)]
    weighted = spark.createDataFrame(rows, "prediction double, label double, w int")
    repeated = weighted.withColumn("i", F.explode(F.sequence(F.lit(1), "w"))).drop("i")
    for made in (metrics.scalar_metrics, metrics.class_metrics, metrics.weighted_metrics):
        a = {tuple(r) for r in made(weighted, "w").collect()}
        assert a == {tuple(r) for r in made(repeated).collect()}
    row = metrics.scalar_metrics(weighted, "w").first()
    assert (row["n"], row["n_correct"], row["n_wrong"]) == (10, 7, 3)
    assert row["precision"] == row["recall"] == row["f_measure"] == row["accuracy"] == 0.7
    assert row["mse"] == pytest.approx((2 * 1 + 1 * 4) / 10)
    empty = metrics.scalar_metrics(weighted.limit(0)).first()
    assert empty["n"] == 0 and empty["accuracy"] is None


def _logs(spark, rows):
    place = {"city_name": "Moscow", "latitude": 55.75, "longitude": 37.6}
    fields = "row_id int, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in LOG_SCHEMA.fields
    )
    empty = {f.name: None for f in LOG_SCHEMA.fields}
    geo = {f.name: None for f in LOG_SCHEMA["geoip"].dataType.fields}
    data = [
        {**empty, "row_id": i, "verb": v, "response": r, "request": "/a", "geoip": {**geo, **place}}
        for i, (v, r) in enumerate(rows)
    ]
    return spark.createDataFrame(data, fields)


def test_analysis_of_logs(spark):
    rows = [("GET", "200")] * 60 + [("PUT", "200")] * 30 + [("POST", "500")] * 20 + [("X", "-")] * 5
    analysis = analyse_logs(_logs(spark, rows), "row_id", model="tree")
    made = {r["rule"]: r["support"] for r in analysis.rules(("verb",)).collect()}
    assert made == {
        "IF verb=GET THEN clusters=0 -- precision=1.0": 60,
        "IF verb=PUT THEN clusters=1 -- precision=1.0": 30,
        "IF verb=POST THEN clusters=2 -- precision=1.0": 20,
    }
    assert analysis.metrics.first()["n"] < 110
    assert analysis.area_under_roc().first()["auc"] == 1.0


def test_analysis_skips_with_a_reason(spark):
    schema = "verb string, is_train boolean, weight bigint"
    assert analyse_combinations(spark.createDataFrame([], schema)).skipped == "no rows"
    only_test = spark.createDataFrame([("GET", False, 3)], schema)
    assert "no training rows" in analyse_combinations(only_test).skipped
