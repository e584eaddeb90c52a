import math

from pyspark.sql import functions as F

from loglens.operators import rules
from loglens.sinks.files import cluster_csv_sink, rule_text_sink, with_minute
from loglens.sources.logs import csv_rule_source

METRIC = 0.8809523809523809
SCHEMA = "verb string, response double, requestIndex double, clusters int, precision double"
ROWS = [
    ("GET", 200.0, 9.0, 2, METRIC),
    ("GET", 200.0, 9.0, 2, METRIC),
    ("GET", 404.0, 25.0, 1, METRIC),
]
ANTECEDENTS = ("verb", "response", "requestIndex")


def test_rule_text(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    made = {r["rule"]: r["support"] for r in rules.generate_rules(df, ANTECEDENTS).collect()}
    assert made == {
        "IF verb=GET AND response=200.0 AND requestIndex=9.0 THEN clusters=2"
        " -- precision=0.8809523809523809": 2,
        "IF verb=GET AND response=404.0 AND requestIndex=25.0 THEN clusters=1"
        " -- precision=0.8809523809523809": 1,
    }
    one = rules.generate_rules(df, ("verb",), distinct=False).select("rule").collect()
    assert len(one) == 3
    assert one[0]["rule"] == "IF verb=GET THEN clusters=2 -- precision=0.8809523809523809"


def test_threshold_and_order(spark):
    df = spark.createDataFrame(
        [(1, 0.5), (2, math.nan), (3, -0.1), (4, None), (5, 0.0), (6, 0.5)], "i int, precision double"
    )
    kept = rules.order_by_metric(rules.above_threshold(df), ties=("i",))
    assert [r["i"] for r in kept.collect()] == [5, 1, 6]
    ordered = rules.order_by_metric(df.filter("precision is not null"), ties=("i",))
    assert [r["i"] for r in ordered.collect()] == [3, 5, 1, 6, 2]


def test_attach_metric_and_columns(spark):
    df = spark.createDataFrame([("GET", 1)], "verb string, clusters int")
    metrics = spark.createDataFrame([(0.25,)], "precision double")
    made = rules.rule_columns(rules.attach_metric(df, metrics))
    assert made.columns == ["verb", "clusters", "precision"]
    assert made.first()["precision"] == 0.25


def test_second_run_of_a_minute_replaces_the_first(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    csv, text = str(tmp_path / "csv"), str(tmp_path / "text")

    def run(rows, minute):
        made = rules.generate_rules(rows, ("verb",)).withColumn("minute", F.lit(minute))
        cluster_csv_sink(made, csv)
        rule_text_sink(made, text, single_file=True)

    run(df, "2016-08-23--14-52")
    run(df, "2016-08-23--14-53")
    run(df.filter("clusters = 2"), "2016-08-23--14-53")
    schema = "verb string, clusters int, precision double, minute string"
    back = csv_rule_source(spark, csv, schema)
    found = {(r["minute"], r["clusters"], r["precision"]) for r in back.collect()}
    assert found == {
        ("2016-08-23--14-52", 2, METRIC),
        ("2016-08-23--14-52", 1, METRIC),
        ("2016-08-23--14-53", 2, METRIC),
    }
    lines = spark.read.text(text)
    assert lines.count() == 3 and back.count() == 3


def test_current_minute(spark):
    minute = with_minute(spark.range(1)).first()["minute"]
    assert len(minute) == 17 and minute[10:12] == "--"


def test_rank_is_the_order(spark):
    rows = [("a", 0.5), ("b", 0.25), ("c", 0.5), ("d", float("nan")), ("e", 0.1)]
    df = spark.createDataFrame(rows, "verb string, precision double")
    for limit in (None, 1):
        found = rules.ranked_by_metric(df, ties=("verb",), single_task_rows=limit).collect()
        assert {r["verb"]: r["rank"] for r in found} == {"e": 1, "b": 2, "a": 3, "c": 4, "d": 5}


def test_files_follow_the_bytes_of_a_minute(spark, tmp_path):
    """Small minutes have one file each; a minute with most rows is split."""
    rows = spark.range(0, 40_000, 1, 16).selectExpr(
        "CASE WHEN id % 20 = 0 THEN concat('m', id % 3) ELSE 'hot' END AS minute",
        "sha2(CAST(id AS STRING), 256) AS verb", "id AS clusters", "0.5D AS precision",
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "400k")
    try:
        cluster_csv_sink(rows, str(tmp_path / "csv"))
    finally:
        spark.conf.unset(name)
    held = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "csv").glob("minute=*")}
    assert held.pop("minute=hot") > 3
    assert set(held.values()) == {1} and len(held) == 3
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 40_000
