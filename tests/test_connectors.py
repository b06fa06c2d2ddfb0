"""The topic source and the hash-store sink."""
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickscope.session import fresh_subdir
from clickscope.sinks import hashstore
from clickscope.sources import topic


def _lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.fixture
def path(spark):
    where = fresh_subdir(spark, "topic") + "/ads"
    topic.create(where, 3)
    return where


def _drain(df, where, **options):
    q = (df.writeStream.format("parquet").option("checkpointLocation", where + "/c").option("path", where + "/out")
           .trigger(availableNow=True).start())
    q.awaitTermination()


def test_topic_keeps_every_message_under_its_offset(spark, path):
    assert topic.topic_table(spark, path).count() == 0
    topic.append(_lines(spark, *(f"a{i}" for i in range(50))), path)
    topic.append(_lines(spark, "b", "two\nlines", "", None, "ümlaut"), path)
    rows = topic.topic_table(spark, path).collect()
    assert sorted(r.value for r in rows) == sorted([f"a{i}" for i in range(50)] + ["b", "two lines", "", "ümlaut"])
    by = {}
    for r in rows:
        by.setdefault(r.partition, []).append(r.offset)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= {0, 1, 2}
    assert topic.end_offsets(path) == {str(p): len(by.get(p, [])) for p in range(3)}


def test_latest_start_and_restart_at_the_stored_offsets(spark, path):
    out = fresh_subdir(spark, "topic-out")
    topic.append(_lines(spark, "before"), path)

    def run():
        _drain(topic.topic_lines(spark, path, "latest", out + "/start.json"), out)
        return sorted(r.value for r in spark.read.schema(topic.SCHEMA).parquet(out + "/out").collect())

    assert run() == []  # starts at the latest
    topic.append(_lines(spark, "one", "two", "three"), path)
    assert run() == ["one", "three", "two"]
    assert run() == ["one", "three", "two"]  # nothing new, nothing twice
    topic.append(_lines(spark, "four"), path)
    assert run() == ["four", "one", "three", "two"]


def test_a_query_that_dies_in_its_first_batch_begins_there_again(spark, path):
    out = fresh_subdir(spark, "topic-die")
    seen = []

    def start(fail):
        def batch(df, k):
            if fail:
                raise RuntimeError("killed")
            seen.extend(r.value for r in df.collect())
        lines = topic.topic_lines(spark, path, "latest", out + "/start.json")
        return lines.writeStream.foreachBatch(batch).option("checkpointLocation", out + "/c").trigger(
            processingTime="100 milliseconds").start()

    q = start(True)
    try:
        while not os.path.exists(out.removeprefix("file:") + "/start.json"):
            assert q.isActive
        topic.append(_lines(spark, "first"), path)
        with pytest.raises(StreamingQueryException):
            q.awaitTermination(60)
    finally:
        q.stop()
    topic.append(_lines(spark, "second"), path)
    q = start(False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(seen) == ["first", "second"]


def _kv(spark, *rows):
    return spark.createDataFrame(list(rows), hashstore.SCHEMA)


def _held(spark, path):
    return sorted(map(tuple, hashstore.read_store(spark, path).collect()))


def test_last_write_wins_replays_and_replaced_keys(spark):
    path = fresh_subdir(spark, "store") + "/s"
    assert _held(spark, path) == []
    hashstore.write_batch(_kv(spark, ("h", "a", "1"), ("h", "b", "1"), ("g", "x", "1")), path, 0)
    hashstore.write_batch(_kv(spark, ("h", "a", "2"), ("g", "x", None)), path, 2)
    hashstore.write_batch(_kv(spark, ("h", "a", "replayed otherwise")), path, 2)  # already there
    assert _held(spark, path) == [("h", "a", "2"), ("h", "b", "1")]
    hashstore.write_batch(hashstore.replaced(_kv(spark, ("h", "c", "3")), "h"), path, 10, writer="other")
    assert _held(spark, path) == [("h", "c", "3")]
    hashstore.write_batch(_kv(spark, ("h", "a", "4")), path, 11)
    assert _held(spark, path) == [("h", "a", "4"), ("h", "c", "3")]
    hashstore.write_batch(_kv(spark), path, 12)  # no rows
    assert _held(spark, path) == [("h", "a", "4"), ("h", "c", "3")]


def test_a_failed_batch_leaves_nothing(spark):
    path = fresh_subdir(spark, "store") + "/s"
    bad = spark.range(0, 4, 1, 4).select(
        F.lit("h").alias("key"), F.col("id").cast("string").alias("field"),
        F.when(F.col("id") < 3, "v").otherwise(F.raise_error(F.lit("dead task"))).alias("value"))
    with pytest.raises(Exception, match="dead task"):
        hashstore.write_batch(bad, path, 0)
    assert _held(spark, path) == []
    hashstore.write_batch(_kv(spark, ("h", "a", "1")), path, 0)  # the same batch again
    assert _held(spark, path) == [("h", "a", "1")]
    assert not [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("_")]


@pytest.mark.parametrize("mode,written", [("update", [2, 2]), ("complete", [2, 3])])
def test_running_counts_stream_into_the_store(spark, path, mode, written):
    store = fresh_subdir(spark, "store") + "/s"
    counts = topic.topic_lines(spark, path, "earliest").groupBy("value").count().select(
        F.lit("n").alias("key"), F.col("value").alias("field"), F.col("count").cast("string").alias("value"))
    for values, want in ((("a", "b", "a"), {"a": "2", "b": "1"}), (("b", "c"), {"a": "2", "b": "2", "c": "1"})):
        topic.append(_lines(spark, *values), path)
        hashstore.start_stream(counts, store, f"{store}-c", output_mode=mode,
                               trigger={"availableNow": True}).awaitTermination()
        assert {f: v for _, f, v in _held(spark, store)} == want
    batches = spark.read.parquet(store).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in batches] == written


def test_stream_writer_commits_whole_batches_only(spark, path):
    store, fail = fresh_subdir(spark, "store") + "/s", fresh_subdir(spark, "flag")
    topic.append(_lines(spark, *(f"k{i}" for i in range(20)), "bad"), path)
    lines = topic.topic_lines(spark, path, "earliest")
    rows = lines.select(F.lit("set").alias("key"), F.col("value").alias("field"), F.lit("").alias("value"))
    dies = rows.withColumn("value", F.when(F.col("field") == "bad", F.raise_error(F.lit("dead task"))).otherwise(""))
    with pytest.raises(StreamingQueryException, match="dead task"):
        hashstore.start_stream(dies, store, fail + "/c", trigger={"availableNow": True}).awaitTermination()
    assert _held(spark, store) == []
    for _ in range(2):  # the restarted query writes the batch, a further start nothing
        hashstore.start_stream(rows, store, fail + "/c", trigger={"availableNow": True}).awaitTermination()
        assert len(_held(spark, store)) == 21
    assert [r.batch for r in spark.read.parquet(store).select("batch").distinct().collect()] == [0]
