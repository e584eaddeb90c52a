"""Counts that a stream carries from batch to batch, and what it does when it breaks off."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from loglens.plans import log_analysis
from loglens.schema import GEOIP_SCHEMA, LOG_SCHEMA
from loglens.streaming import minute_rules
from loglens.streaming.running_counts import RunningCounts

SCHEMA = "verb string, is_train boolean, weight bigint"


def _bytes(folder):
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_totals_after_every_batch(spark, tmp_path):
    counts = RunningCounts(str(tmp_path), "q", every=3)
    held, sizes = {}, []
    for batch in range(10):
        rows = [("GET", True, batch + 1), (None, False, 2)]
        for verb, train, n in rows:
            held[verb, train] = held.get((verb, train), 0) + n
        new = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        # A repeated batch replaces what its first attempt left, also a new base.
        for _ in range(2):
            counts.add(new, batch)
            found = counts.totals(spark, new.schema, batch).collect()
            assert {(r["verb"], r["is_train"]): r["weight"] for r in found} == held
        sizes.append(_bytes(tmp_path / "query_id=q" / "delta" / str(batch)))
    # What a batch writes does not grow, and old tables are gone.
    assert max(sizes) < 1.2 * min(sizes)
    assert len(list((tmp_path / "query_id=q" / "base").iterdir())) <= 2
    assert len(list((tmp_path / "query_id=q" / "delta").iterdir())) <= 6


def test_queries_do_not_share_counts(spark, tmp_path):
    new = spark.createDataFrame([("GET", True, 1)], SCHEMA)
    for query in ("a", "b"):
        counts = RunningCounts(str(tmp_path), query)
        counts.add(new, 0)
        assert counts.totals(spark, new.schema, 0).first()["weight"] == 1


def _records(spark, rows):
    place = F.struct(
        *[
            F.lit({"city_name": "x", "latitude": 1.0, "longitude": 2.0}.get(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in GEOIP_SCHEMA.fields
        ]
    )
    made = spark.createDataFrame(rows, "row_id bigint, verb string").withColumns(
        {"request": F.lit("/"), "response": F.lit("200"), "geoip": place}
    )
    return made.select("row_id", *[f.name for f in LOG_SCHEMA.fields if f.name in made.columns])


def _run(spark, tmp_path, **options):
    stored = spark.read.parquet(str(tmp_path / "in" / "0"))
    stream = (
        spark.readStream.schema(stored.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "in" / "*"))
    )
    names = ("csv", "rules", "state")
    query = minute_rules.minute_rules(
        stream, "row_id", *[str(tmp_path / n) for n in names], available_now=True, minute="m",
        compact_every=2, **options,
    )
    query.awaitTermination()


def test_broken_batch_counts_once(spark, tmp_path, monkeypatch):
    verbs = ["GET"] * 30 + ["PUT"] * 20 + ["POST"] * 10
    for i in range(5):
        rows = [(100 * i + j, v) for j, v in enumerate(verbs)]
        _records(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    analyse, calls = minute_rules.analyse_combinations, []

    def breaks_once(totals, *args, **options):
        calls.append(totals.agg(F.sum("weight")).first()[0])
        if len(calls) == 4:
            raise RuntimeError("executor lost")
        return analyse(totals, *args, **options)

    monkeypatch.setattr(minute_rules, "analyse_combinations", breaks_once)
    metrics, curve = (str(tmp_path / n) for n in ("metrics", "curve"))
    with pytest.raises(StreamingQueryException):
        _run(spark, tmp_path, metrics_path=metrics, curve_path=curve)
    _run(spark, tmp_path, metrics_path=metrics, curve_path=curve)
    assert calls == [60, 120, 180, 240, 240, 300]
    scores = spark.read.parquet(metrics)
    batches = {r["model"]: r["count"] for r in scores.groupBy("model").count().collect()}
    assert batches == {"logistic": 5, "tree": 5}
    assert scores.agg(F.max("n")).first()[0] < 300
    assert scores.filter("mse IS NULL OR auc IS NULL").isEmpty()
    points = spark.read.parquet(curve).groupBy("batch_id").agg(F.min("fpr"), F.max("tpr"))
    assert [tuple(r)[1:] for r in points.collect()] == [(0.0, 1.0)] * 5


def test_tree_needs_more_than_two_rows(spark):
    for n, skipped in ((2, True), (3, False)):
        combos = spark.createDataFrame([("GET", True, n)], SCHEMA)
        found = log_analysis.analyse_combinations(combos, model="tree")
        assert bool(found.skipped) == skipped
