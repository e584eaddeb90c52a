"""The message log: places, repeats, restarts and replay."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from loglens.operators import ordering
from loglens.sources import kafka
from loglens.sources.message_log import (
    append_batch,
    message_log_sink,
    message_log_source,
    read_messages,
)


def _payload(spark, rows):
    return spark.createDataFrame(rows, "key string, value string").coalesce(1)


def _places(messages):
    """``(partition, offset)`` to value."""
    return {(r["partition"], r["offset"]): r["value"].decode() for r in messages.collect()}


def test_offsets_are_gapless_and_keys_keep_their_order(spark, tmp_path, monkeypatch):
    # Range partitions instead of one window.
    monkeypatch.setattr(ordering, "SINGLE_TASK_ROWS", 10)
    path, expected = str(tmp_path / "log"), {}
    for batch in range(23):
        rows = [("hot", f"{batch}-{i}") for i in range(20)] + [(f"k{i}", "x") for i in range(5)]
        rows += [(None, "free")] * 4
        append_batch(_payload(spark, rows), path, "t", "q", batch, partitions=3)
        expected.setdefault("hot", []).extend(v for k, v in rows if k == "hot")
    stored = read_messages(spark, path, "t").cache()
    assert stored.count() == 23 * 29
    for r in stored.groupBy("partition").agg(
        F.count("*").alias("n"), F.count_distinct("offset").alias("d"), F.max("offset").alias("m")
    ).collect():
        assert r["n"] == r["d"] == r["m"] + 1
    hot = stored.filter("CAST(key AS STRING) = 'hot'").orderBy("offset").collect()
    assert [r["value"].decode() for r in hot] == expected["hot"]
    assert len({r["partition"] for r in hot}) == 1
    free = stored.filter("key IS NULL").select("partition").distinct().count()
    assert free == 3


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    append_batch(_payload(spark, [("a", "1"), ("b", "2")]), path, "t", "q", 0)
    before = _places(read_messages(spark, path, "t"))
    append_batch(_payload(spark, [("a", "1"), ("b", "2")]), path, "t", "q", 0)
    assert _places(read_messages(spark, path, "t")) == before
    append_batch(_payload(spark, [("a", "3")]), path, "t", "q", 1)
    append_batch(_payload(spark, []), path, "t", "q", 2)
    append_batch(_payload(spark, [("a", "4")]), path, "t", "q", 3)
    after = _places(read_messages(spark, path, "t"))
    assert len(after) == 4 and sorted(after.values()) == ["1", "2", "3", "4"]
    (place,) = [p for p, v in after.items() if v == "1"]
    assert after[place[0], place[1] + 1] == "3" or len({p for p, _ in before}) == 1
    with pytest.raises(ValueError):
        append_batch(_payload(spark, [("a", "5")]), path, "t", "other", 0)


def test_restart_in_the_middle_reads_each_message_once(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    source, state, read_state = (str(tmp_path / n) for n in ("in", "state", "read"))
    fail = {"left": 1}

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if batch_id == 2 and fail["left"]:
            fail["left"] = 0
            raise RuntimeError("lost after its write")

    def read():
        stream = message_log_source(spark, path, "t", maxFilesPerTrigger=1)
        query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", read_state)
        query.trigger(availableNow=True).start().awaitTermination()

    for part in range(4):
        ids = spark.range(part * 10, part * 10 + 10).coalesce(1)
        ids.write.mode("append").parquet(source)
        rows = spark.readStream.schema("id bigint").parquet(source)
        sink = message_log_sink(rows, path, state, "t", key="id")
        sink.trigger(availableNow=True).start().awaitTermination()
        if part == 1:
            read()
        if part == 3:
            with pytest.raises(StreamingQueryException):
                read()
    read()
    found = spark.read.parquet(out)
    assert sorted(int(r["key"]) for r in found.collect()) == list(range(40))
    assert found.select("row_id").distinct().count() == 40


def test_topics_and_replay_from_offsets(spark, tmp_path):
    path = str(tmp_path / "log")
    append_batch(_payload(spark, [("a", str(i)) for i in range(6)]), path, "t", "q", 0, 1)
    append_batch(_payload(spark, [("a", "u")]), path, "u", "r", 0, 1)
    assert read_messages(spark, path, "t, u").count() == 7
    late = read_messages(spark, path, ["t", "u"], starting={"t": {"0": 4}})
    assert sorted(r["value"].decode() for r in late.collect()) == ["4", "5", "u"]
    stream = message_log_source(spark, path, "t", starting={"t": {0: 5}})
    broker = kafka.key_value_text(read_messages(spark, path, "t"), position=True)
    assert stream.schema == broker.schema
