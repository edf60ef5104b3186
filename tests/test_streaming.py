from __future__ import annotations

from datetime import datetime

import pytest
from test_envelope_bronze import event, message

from gridlake.schemas import BRONZE, MESSAGE, REGION
from gridlake.sources import tables
from gridlake.streaming import ingest


class Topic:
    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.topic, self.bronze, self.quarantine, self.progress = (
            f"{tmp_path}/{n}" for n in ("topic", "bronze", "quarantine", "progress")
        )

    def send(self, *values, start):
        message(self.spark, *values, start=start).write.mode("append").parquet(self.topic)

    def run(self, progress=None, **options):
        stream = ingest.read_topic_files(self.spark, self.topic, **options)
        ingest.ingest_available_now(
            stream, self.bronze, self.quarantine, progress or self.progress
        )

    def ids(self):
        stored = tables.read_table(self.spark, self.bronze, BRONZE)
        return sorted(r["event_id"] for r in stored.select("event_id").collect())


def hour(h):
    return f"2026-01-01T{h:02d}:00:00+00:00"


def test_runs_resume_and_replays_add_nothing(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send(event("a", hour(0)), event("a", hour(0)), "{broken", event("b", hour(1)), start=0)
    topic.run()
    assert topic.ids() == ["a", "b"]
    topic.run()
    assert topic.ids() == ["a", "b"]
    topic.send(event("b", hour(1)), event("c", hour(1)), start=10)
    topic.run()
    assert topic.ids() == ["a", "b", "c"]
    # a lost checkpoint replays the whole topic
    topic.run(progress=f"{tmp_path}/elsewhere")
    assert topic.ids() == ["a", "b", "c"]
    refused = spark.read.parquet(topic.quarantine)
    assert [r["kafka_offset"] for r in refused.collect()] == [2]


def test_many_small_batches_equal_one(spark, tmp_path):
    one, many = Topic(spark, tmp_path / "one"), Topic(spark, tmp_path / "many")
    for topic in (one, many):
        for i in range(4):
            numbers = [(i * 3 + j) % 7 for j in range(5)]
            texts = [event(f"e{n}", hour(n)) for n in numbers]
            topic.send(*texts, start=i * 10)
    one.run()
    many.run(maxFilesPerTrigger="1")
    assert one.ids() == many.ids() == sorted(set(one.ids()))


def test_replays_within_the_window_are_dropped_before_the_lookup(spark, tmp_path, monkeypatch):
    """Over restarts; what can't be used, and what failed to be written, still gets through."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert spark.conf.get(provider).endswith("RocksDBStateStoreProvider")
    topic, looked_up = Topic(spark, tmp_path), []
    replay_safe = ingest.replay_safe_batch

    def recording(events, existing):
        looked_up.append(sorted(r["event_id"] for r in events.select("event_id").collect()))
        return replay_safe(events, existing)

    def run(window="2 hours"):
        stream = ingest.read_topic_files(spark, topic.topic)
        ingest.ingest_available_now(
            stream, topic.bronze, topic.quarantine, topic.progress, window
        )

    monkeypatch.setattr(ingest, "replay_safe_batch", recording)
    topic.send(event("a", hour(0)), event("a", hour(0)), "{broken", "{broken", start=0)
    run()
    topic.send(event("a", hour(0)), event("b", hour(1)), "{broken", event("a", hour(0)), start=10)
    with monkeypatch.context() as failing, pytest.raises(Exception, match="disk"):
        failing.setattr(ingest, "append_partitioned", lambda *_: (_ for _ in ()).throw(OSError("disk")))
        run()
    assert topic.ids() == ["a"]
    run()
    topic.send(event("b", hour(1)), event("c", hour(1)), start=20)
    run()
    assert topic.ids() == ["a", "b", "c"]
    assert [found for found in looked_up if found] == [["a"], ["b"], ["b"], ["c"]]
    refused = spark.read.parquet(topic.quarantine).collect()
    assert sorted(r["kafka_offset"] for r in refused) == [2, 3, 12]


def test_replays_beyond_the_window_are_refused_by_their_id(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    for start in (0, 10, 20):
        topic.send(event("a", hour(0)), event(f"e{start}", hour(1)), start=start)
        stream = ingest.read_topic_files(spark, topic.topic)
        ingest.ingest_available_now(
            stream, topic.bronze, topic.quarantine, topic.progress, "1 millisecond"
        )
    assert topic.ids() == ["a", "e0", "e10", "e20"]


def test_a_stream_with_state_writes_few_files(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send(*[event(f"e{n}", hour(n % 2)) for n in range(80)], start=0)
    stream = ingest.read_topic_files(spark, topic.topic)
    ingest.ingest_available_now(
        stream, topic.bronze, topic.quarantine, topic.progress, "2 hours"
    )
    stored = tables.read_table(spark, topic.bronze, BRONZE)
    assert stored.count() == 80
    assert len(stored.inputFiles()) == 2  # one per hour, not one per task and hour


def test_a_batch_of_one_partition_is_kept_in_several(spark, tmp_path, monkeypatch):
    topic, parts = Topic(spark, tmp_path), []
    replay_safe = ingest.replay_safe_batch

    def recording(events, existing):
        parts.append(events.rdd.getNumPartitions())
        return replay_safe(events, existing)

    monkeypatch.setattr(ingest, "replay_safe_batch", recording)
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # else a few rows stay together
    spark.conf.set(small, "false")
    try:
        texts = [event(f"e{n:02d}", hour(n % 5)) for n in range(40)]
        ingest.write_batch(message(spark, *texts).coalesce(1), topic.bronze, topic.quarantine)
    finally:
        spark.conf.set(small, "true")
    assert topic.ids() == [f"e{n:02d}" for n in range(40)]
    assert parts[0] > 1


def test_batch_write_is_repeatable_and_reads_only_touched_hours(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    batch = message(spark, event("a", hour(0)), event("b", hour(5)), "oops")
    for _ in range(2):
        ingest.write_batch(batch, topic.bronze, topic.quarantine)
    assert topic.ids() == ["a", "b"]
    assert spark.read.parquet(topic.quarantine).count() == 1
    from gridlake.operators.bronze import parse_envelope

    only = parse_envelope(message(spark, event("x", hour(5))))
    found = ingest.existing_ids(spark, only, topic.bronze)
    assert [r["event_id"] for r in found.collect()] == ["b"]
    later = event("z", "2026-01-02T00:00:00+00:00")
    ingest.write_batch(message(spark, later), topic.bronze, topic.quarantine)
    again = ingest.existing_ids(spark, only, topic.bronze)
    days = {path.split("event_day=")[1].split("/")[0] for path in again.inputFiles()}
    assert days == {"1"}  # no other day is listed


def test_bronze_window(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    texts = [event(f"e{h}", hour(h)) for h in range(4)]
    ingest.write_batch(message(spark, *texts), topic.bronze, topic.quarantine)
    got = tables.read_bronze(
        spark, topic.bronze, REGION, datetime(2026, 1, 1, 1), datetime(2026, 1, 1, 3)
    )
    assert sorted(r["event_id"] for r in got.collect()) == ["e1", "e2"]
    assert MESSAGE.names == ["value", "topic", "partition", "offset", "timestamp"]
