import json
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from loglens import session
from loglens.operators import features, token_vectors
from loglens.operators.lookup import lookup_join
from loglens.operators.prepare import accumulate, feature_rows, has_rows
from loglens.plans.queries import QUERIES
from loglens.schema import LOG_SCHEMA
from loglens.sinks.files import console_sink
from loglens.sources import kafka, logs, synthetic
from loglens.streaming import ingest, minute_rules, windows

RECORD = {
    "message": "m",
    "verb": "GET",
    "request": "/a",
    "response": "200",
    "geoip": {"city_name": "Moscow", "latitude": 55.75, "longitude": 37.6, "location": [37.6, 55.75]},
    "unknown": 1,
}


def test_messages_to_records(spark):
    values = [json.dumps(RECORD), "{bad", "17", '{"other":1}', None, '{"verb":"PUT","geoip":null}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    good, bad = logs.json_strings_to_table(df, keep=("i",))
    found = {r["i"]: r for r in good.collect()}
    assert set(found) == {0, 5}
    assert found[0]["geoip"]["location"] == [37.6, 55.75]
    assert found[5]["request"] is None
    assert good.columns == ["i", *[f.name for f in LOG_SCHEMA.fields]]
    assert {r["i"]: r["reason"] for r in bad.collect()} == {
        1: "malformed JSON",
        2: "malformed JSON",
        3: "no known field",
        4: "missing value",
    }


def test_feature_rows_drop_incomplete_records(spark):
    no_place = {**RECORD, "geoip": None}
    no_number = {**RECORD, "response": "-"}
    df = spark.createDataFrame(
        [(json.dumps(r),) for r in (RECORD, no_place, no_number)], "value string"
    )
    good, _ = logs.json_strings_to_table(df)
    rows = feature_rows(good).collect()
    assert [r["response"] for r in rows] == [200.0]
    assert has_rows(good) and has_rows(good, 2) and not has_rows(good, 3)


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2, 3.0)], "v string, id int, w double")
    both = accumulate(accumulate(a, b), a).orderBy("id")
    assert [tuple(r) for r in both.collect()] == [(1, "x", None), (1, "x", None), (2, "y", 3.0)]


def test_files(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.log").write_text("one\ntwo\n")
    rows = logs.log_file_source(spark, str(tmp_path / "lines")).collect()
    assert {(r["message"], r["type"]) for r in rows} == {("one", "apache-access"), ("two", "apache-access")}
    assert rows[0]["path"].endswith("a.log")
    (tmp_path / "r.json").write_text(json.dumps(RECORD) + "\n")
    record = logs.json_file_source(spark, str(tmp_path / "r.json")).first()
    assert record["geoip"]["city_name"] == "Moscow" and "unknown" not in record
    inferred = logs.json_file_source(spark, str(tmp_path / "r.json"), schema=None)
    assert "unknown" in inferred.columns


def test_view(spark):
    df = logs.register_view(spark.range(3), "logs", cache=True)
    assert spark.sql("SELECT count(*) AS n FROM logs").first()["n"] == 3
    logs.release_view(df)
    assert not spark.catalog.tableExists("logs") and not df.is_cached
    console_sink(spark.range(2))


def test_kafka_options(spark):
    options = kafka.kafka_source_options("h:9092", "a, b", group="g", partitions=4)
    assert options["subscribe"] == "a,b" and options["minPartitions"] == "4"
    assert kafka.kafka_source_options("h:9092", ["a"])["subscribe"] == "a"
    assert kafka.kafka_sink_options("h:9092")["topic"] == kafka.DEFAULT_TOPIC
    row = kafka.kafka_payload(spark.createDataFrame([(1, "x")], "k int, v string"), "k").first()
    assert row["key"] == "1" and json.loads(row["value"]) == {"k": 1, "v": "x"}
    raw = spark.createDataFrame([(b"k", b"v")], "key binary, value binary")
    assert tuple(kafka.key_value_text(raw).first()) == ("k", "v")
    placed = raw.selectExpr("*", "'t' AS topic", "3 AS partition", "42L AS offset")
    assert tuple(kafka.key_value_text(placed, position=True).first()) == ("k", "v", "t-3-42")
    with pytest.raises(AnalysisException):
        kafka.kafka_source(spark, "h:9092")


def test_synthetic_lines(spark):
    lines = synthetic.synthetic_access_log(spark, 20_000, seed=5, anomalies=True).cache()
    again = synthetic.synthetic_access_log(spark, 20_000, seed=5, anomalies=True)
    assert lines.exceptAll(again).isEmpty()
    shares = {r["verb"]: r["count"] / 20_000 for r in lines.groupBy("verb").count().collect()}
    for verb, share in synthetic.ANOMALOUS_VERBS:
        assert shares[verb] == pytest.approx(share, abs=0.02)
    shares = {r["response"]: r["count"] / 20_000 for r in lines.groupBy("response").count().collect()}
    for response, share in synthetic.RESPONSES:
        assert shares[response] == pytest.approx(share, abs=0.02)
    row = lines.agg(F.avg("bytes").alias("m"), F.stddev("bytes").alias("s")).first()
    assert row["m"] == pytest.approx(5000, abs=3) and row["s"] == pytest.approx(50, abs=2)
    from loglens.functions.parsing import parse_combined_log

    parsed = parse_combined_log(lines.select("id", "message"))
    assert parsed.filter("NOT parsed").isEmpty()
    normal = synthetic.synthetic_access_log(spark, 5_000, seed=5)
    assert normal.filter("verb = 'BADVERB'").isEmpty()
    lines.unpersist()


def test_synthetic_stream(spark, tmp_path):
    stream = synthetic.synthetic_log_stream(spark, rows_per_second=50)
    assert stream.isStreaming and "message" in stream.columns


def _write_messages(path, name, values):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(v + "\n" for v in values))


def test_ingest_in_batches(spark, tmp_path):
    source = tmp_path / "in"
    good, bad, state = (str(tmp_path / n) for n in ("good", "bad", "state"))

    def run():
        messages = logs.message_file_stream(spark, str(source), maxFilesPerTrigger=1)
        query = ingest.ingest_logs(messages, good, bad, state, available_now=True)
        query.awaitTermination()
        return ingest.read_ingested(spark, good).count(), spark.read.parquet(bad).count()

    _write_messages(source, "1.txt", [json.dumps(RECORD)] * 3 + ["{bad"])
    _write_messages(source, "2.txt", [json.dumps(RECORD)] * 2)
    assert run() == (5, 1)
    assert run() == (5, 1)
    _write_messages(source, "3.txt", [json.dumps(RECORD), "17"])
    assert run() == (6, 2)


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "x int")
    for _ in range(2):
        ingest.replace_batch(df, path, "query", 7)
    assert spark.read.parquet(path).count() == 1


def _event_stream(spark, path, batches):
    schema = "ts timestamp_ntz, kind string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "t string, kind string").selectExpr(
            "CAST(t AS timestamp_ntz) AS ts", "kind"
        ).coalesce(1).write.parquet(f"{path}/{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_window_updates_equal_batch_counts(spark, tmp_path):
    batches = [
        [("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:05", "a")],
        [("2024-01-01 00:00:09", "a"), ("2024-01-01 00:00:11", "b")],
    ]
    events = _event_stream(spark, str(tmp_path / "in"), batches)
    counts = windows.window_counts(events, ("kind",))
    out = str(tmp_path / "out")
    windows.write_window_updates(counts, out, str(tmp_path / "s"), available_now=True).awaitTermination()
    found = windows.latest_windows(spark, out, counts.schema, ("kind",))
    table = spark.read.schema("ts timestamp_ntz, kind string").parquet(str(tmp_path / "in/*"))
    expected = windows.window_counts(table, ("kind",)).select(*found.columns)
    assert found.count() == expected.count() > 0
    assert found.exceptAll(expected).isEmpty()


def test_late_rows_do_not_count(spark, tmp_path):
    batches = [
        [("2024-01-01 01:00:00", "a")],
        [("2024-01-01 01:00:01", "a")],
        [("2024-01-01 00:00:00", "late")],
    ]
    events = _event_stream(spark, str(tmp_path / "in"), batches)
    counts = windows.minute_counts(events, ("kind",))
    out = str(tmp_path / "out")
    windows.write_window_updates(counts, out, str(tmp_path / "s"), available_now=True).awaitTermination()
    found = windows.latest_windows(spark, out, counts.schema, ("kind",)).collect()
    assert [(r["kind"], r["n"]) for r in found] == [("a", 2)]


def test_late_rows_are_written(spark, tmp_path, monkeypatch):
    batches = [
        [("2024-01-01 01:00:00", "a"), (None, "timeless")],
        [("2024-01-01 01:00:01", "a"), ("2024-01-01 00:50:05", "b"), ("2024-01-01 00:49:55", "c")],
        [("2024-01-01 00:00:00", "late"), ("2024-01-01 00:50:08", "edge")],
        [("2024-01-01 02:00:00", "a"), ("2024-01-01 00:00:00", "late")],
        [("2024-01-01 01:49:51", "edge"), ("2024-01-01 01:49:40", "late"), (None, "timeless")],
    ]
    expected, behind, newest = Counter(), Counter(), None
    for batch in batches:
        mark = newest and newest - timedelta(minutes=10)
        for text, kind in batch:
            if text is None:
                behind[kind] += 1
                continue
            at = datetime.fromisoformat(text)
            last = at.replace(second=at.second // 2 * 2)
            starts = [last - timedelta(seconds=2 * i) for i in range(5)]
            ends = [(s, s + timedelta(seconds=10)) for s in starts]
            open_ = [(s, e, kind) for s, e in ends if mark is None or e > mark]
            expected.update(open_)
            behind[kind] += len(open_) < 5
            newest = max(at, newest or at)
    events = _event_stream(spark, str(tmp_path / "in"), batches)
    own, late = (str(tmp_path / n) for n in ("own", "late"))

    def run():
        windows.write_windows_and_late_rows(
            events, own, late, str(tmp_path / "t"), ("kind",), available_now=True
        ).awaitTermination()

    # One batch breaks off after its last output and is repeated.
    remove = windows.remove_folder
    monkeypatch.setattr(windows, "remove_folder", lambda *a: 1 / 0)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(windows, "remove_folder", remove)
    run()
    found = windows.summed_windows(spark, own, [StructField("kind", StringType())])
    assert {tuple(r)[:3]: r["n"] for r in found.collect()} == expected
    rows = spark.read.parquet(late)
    assert Counter(r["kind"] for r in rows.collect()) == +behind
    # Five windows hold every row: counted and missed ones are all of them.
    n = sum(len(b) for b in batches) - 2
    missed = rows.agg(F.sum("missed")).first()[0]
    assert found.agg(F.sum("n")).first()[0] + missed == 5 * n
    assert rows.filter(F.col("reason") == windows.NO_TIME).count() == 2


def test_minute_rules_follow_the_stream(spark, tmp_path):
    source = tmp_path / "in"
    csv, text, state = (str(tmp_path / n) for n in ("csv", "text", "state"))

    def run(minute):
        messages = logs.message_file_stream(spark, str(source))
        good = logs.good_records(logs.decode_messages(messages))
        query = minute_rules.minute_rules(
            good, "message", csv, text, state, available_now=True, minute=minute
        )
        query.awaitTermination()
        return {(r["minute"], r["value"].split(" --")[0]) for r in spark.read.text(text).collect()}

    def messages(verb, start, n):
        return [json.dumps({**RECORD, "verb": verb, "message": f"m{start + i}"}) for i in range(n)]

    _write_messages(source, "1.txt", messages("GET", 0, 30) + messages("PUT", 30, 20))
    first = {("m1", "IF verb=GET THEN clusters=0"), ("m1", "IF verb=PUT THEN clusters=1")}
    assert run("m1") == first
    # Nothing new: nothing is written.
    assert run("m2") == first
    _write_messages(source, "2.txt", messages("POST", 50, 40))
    second = {
        ("m2", "IF verb=POST THEN clusters=0"),
        ("m2", "IF verb=GET THEN clusters=1"),
        ("m2", "IF verb=PUT THEN clusters=2"),
    }
    assert run("m2") == first | second


def test_both_outputs_of_a_batch_name_one_minute(spark, tmp_path):
    source = tmp_path / "in"
    outputs = tmp_path / "csv", tmp_path / "text"
    verbs = ["GET"] * 30 + ["PUT"] * 20
    messages = [json.dumps({**RECORD, "verb": v, "message": f"m{i}"}) for i, v in enumerate(verbs)]
    _write_messages(source, "1.txt", messages)
    good = logs.good_records(logs.decode_messages(logs.message_file_stream(spark, str(source))))
    minute_rules.minute_rules(
        good, "message", *map(str, outputs), str(tmp_path / "state"), available_now=True
    ).awaitTermination()
    minutes = [[p.name for p in folder.glob("minute=*")] for folder in outputs]
    assert len(minutes[0]) == 1 and minutes[0] == minutes[1]


def test_stream_rules_are_those_of_the_same_logs_in_batch(spark):
    # Here the logs without a city change the ranks of three verbs.
    found, expected = (
        sorted(r["rule"] for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect())
        for name in ("stream_minute_rules", "log_rules")
    )
    assert found == expected


def test_stream_joins_a_large_table(spark, tmp_path):
    path, out = (str(tmp_path / n) for n in ("facts", "out"))
    spark.range(90).selectExpr("id", "id % 30 AS key").write.parquet(path)
    facts = spark.readStream.schema("id bigint, key bigint").parquet(path)
    dim = spark.range(20).selectExpr("id AS key", "concat('d', id) AS name")
    joined = lookup_join(facts, dim, "key", salt_by="id", broadcast_bytes=0)
    joined.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "s")).trigger(
        availableNow=True
    ).start(out).awaitTermination()
    found = {tuple(r) for r in spark.read.parquet(out).collect()}
    assert found == {(i, i % 30, f"d{i % 30}" if i % 30 < 20 else None) for i in range(90)}


def test_shared_folder(spark):
    folder = session.shared_dir(spark)
    assert session.new_path(spark, "x").startswith(folder)
    stored = session.checkpointed(spark.range(5))
    assert stored.count() == 5
    back = session.written(spark.range(5).withColumn("v", F.lit("a")), "t")
    assert back.count() == 5 and back.columns == ["id", "v"]


def test_presets_and_extras(spark):
    df = spark.createDataFrame(
        [(i, v, r, 200.0) for i, (v, r) in enumerate([("GET", "/a/b"), ("GET", "/a"), ("PUT", "/c")])],
        "row_id int, verb string, request string, response double",
    )
    made = features.feature_table(df, "verb", "row_id")
    assert {r["verb"]: r["verbIndex"] for r in made.collect()} == {"GET": 0.0, "PUT": 1.0}
    model = features.ml_feature_model(df, "verb")
    assert {r["verb"]: r["verbIndex"] for r in model.transform(df).collect()} == {"GET": 0.0, "PUT": 1.0}
    assert token_vectors.request_vectors(df, size=4).first()["requestWords"].size == 4
    scaled = features.standard_scale(made).collect()
    assert sum(r["featuresScaled"][0] for r in scaled) == pytest.approx(0)


def test_second_checkpoint_keeps_history(spark, tmp_path):
    source, good, bad = (str(tmp_path / n) for n in ("in", "good", "bad"))
    spark.createDataFrame([("{bad",), ('{"verb":"GET"}',)], "value string").write.text(source)
    messages = spark.readStream.text(source)
    for state in ("one", "two"):
        query = ingest.ingest_logs(messages, good, bad, str(tmp_path / state), available_now=True)
        query.awaitTermination()
    assert ingest.read_ingested(spark, good).count() == 2
    assert spark.read.parquet(bad).count() == 2


def test_seed_fixes_lines_whatever_the_partitions(spark):
    two = synthetic.synthetic_access_log(spark, 500, seed=3, partitions=2)
    eight = synthetic.synthetic_access_log(spark, 500, seed=3, partitions=8)
    assert two.exceptAll(eight).isEmpty()
