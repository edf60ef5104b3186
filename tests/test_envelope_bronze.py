from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridlake.functions.columns import normalize_period
from gridlake.operators import bronze, envelope, quality
from gridlake.plans.queries import QUERIES
from gridlake.schemas import BRONZE, BRONZE_PARTITIONS, MESSAGE, REGION, REGION_SPEC


def rows(spark, *maps):
    return spark.createDataFrame([(m,) for m in maps], "row map<string,string>")


def test_periods_of_every_notation(spark):
    texts = {
        "2026": "2026-01-01T00:00:00+00:00",
        "2026-02": "2026-02-01T00:00:00+00:00",
        "2026-02-03": "2026-02-03T00:00:00+00:00",
        "2026-02-03T04": "2026-02-03T04:00:00+00:00",
        "2026-02-03T04:05": "2026-02-03T04:05:00+00:00",
        "2026-02-03T04:05:06": "2026-02-03T04:05:06+00:00",
        "2026-02-03T04:05:06Z": "2026-02-03T04:05:06+00:00",
        "2026-02-03T04Z": "2026-02-03T04:00:00+00:00",
        "2026-02-03T04:05:06-05:00": "2026-02-03T09:05:06+00:00",
        "2026-02-03 04:05:06.25+0100": "2026-02-03T03:05:06.250000+00:00",
        "2026-02-03T04:05:06.123456Z": "2026-02-03T04:05:06.123456+00:00",
        "not-a-date": None,
        "": None,
        "12:30": None,
        "T12:30": None,
        "12:30:00": None,
        "99999": None,
        "0000": None,
        "2026-02-03T04:05:06 PST": None,
        "2026-02-30": None,
        " 2026": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", normalize_period(F.col("t")).alias("p")).collect()
    assert {r["t"]: r["p"] for r in got} == texts


def test_event_id_is_the_hash_of_canonical_json(spark):
    row = {"value": "100", "period": "2026-01-01T00", "respondent": "PJM", "type-name": None}
    document = {"dataset": REGION, "route": REGION_SPEC.route, "row": row}
    text = json.dumps(document, sort_keys=True, separators=(",", ":"))
    other_order = dict(reversed(row.items()))
    built = envelope.build_envelopes(
        rows(spark, row, other_order), REGION_SPEC, "run-1", "a", "b", datetime(2026, 1, 1)
    )
    again = envelope.build_envelopes(rows(spark, row), REGION_SPEC, "run-2", "c", "d")
    ids = {r["event_id"] for r in built.union(again).collect()}
    assert ids == {hashlib.sha256(text.encode()).hexdigest()}


def test_envelope_columns(spark):
    row = {"period": "2026-01", "respondent": "PJM", "value": "1.50"}
    built = envelope.build_envelopes(
        rows(spark, row), REGION_SPEC, "run", "s", "e", datetime(2026, 1, 2, 3)
    ).first()
    assert built["event_timestamp"] == "2026-01-01T00:00:00+00:00"
    assert built["ingestion_timestamp"] == "2026-01-02T03:00:00+00:00"
    assert built["metadata"] == {
        "frequency": "hourly",
        "route": REGION_SPEC.route,
        "respondent": "PJM",
        "ingestion_run_id": "run",
        "source_window_start": "s",
        "source_window_end": "e",
    }
    assert built["payload"] == row and built["source"] == "eia_api_v2"


def test_invalid_rows_are_split_or_raise(spark):
    good, bad = {"period": "2026-01-01T00"}, {"period": "nope"}
    built = envelope.build_envelopes(rows(spark, good, bad, bad), REGION_SPEC, "r", "s", "e")
    valid, invalid = envelope.split_invalid(built)
    assert valid.count() == 1
    assert [r["error"] for r in invalid.collect()] == ["Invalid period value: nope"] * 2
    with pytest.raises(envelope.InvalidRows, match="2 rows.*nope"):
        envelope.split_invalid(built, strict=True)


def message(spark, *values, start=42):
    data = [
        (v.encode() if v is not None else None, "t", 0, start + i, datetime(2026, 1, 1, 0, 10))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(data, MESSAGE)


def event(event_id="evt-1", at="2026-01-01T00:00:00+00:00", dataset=REGION, **payload):
    return json.dumps(
        {
            "event_id": event_id,
            "dataset": dataset,
            "source": "eia_api_v2",
            "event_timestamp": at,
            "ingestion_timestamp": "2026-01-01T00:10:00+00:00",
            "metadata": {"route": "r"},
            "payload": payload or {"value": "1"},
        },
        ensure_ascii=False,
    )


def test_parse_keeps_the_place_of_a_message(spark):
    got = bronze.parse_envelope(message(spark, event())).collect()
    assert len(got) == 1
    row = got[0]
    assert (row["kafka_topic"], row["kafka_partition"], row["kafka_offset"]) == ("t", 0, 42)
    assert (row["event_year"], row["event_month"], row["event_day"], row["event_hour"]) == (
        2026,
        1,
        1,
        0,
    )
    assert row["dataset_partition"] == REGION


def test_unusable_messages_are_refused_not_lost(spark):
    batch = message(
        spark,
        event(),
        "{broken",
        "null",
        event(event_id=None),
        event(at="nope"),
        event(dataset=None),
        None,
        event("evt-é", respondent="Zürich", value="1.50"),
    )
    parsed = bronze.parse_envelope(batch).collect()
    assert {r["event_id"] for r in parsed} == {"evt-1", "evt-é"}
    kept = next(r for r in parsed if r["event_id"] == "evt-é")
    assert kept["payload"] == {"respondent": "Zürich", "value": "1.50"}
    assert bronze.rejected(batch).count() == 6


def batch_of(spark, *pairs):
    """Bronze rows of (event id, hour) with rising offsets."""
    texts = [event(i, f"2026-01-01T{h:02d}:00:00+00:00") for i, h in pairs]
    return bronze.parse_envelope(message(spark, *texts))


def test_write_plan_counts(spark):
    batch = batch_of(spark, ("evt-1", 0), ("evt-2", 0), ("evt-2", 0), ("evt-3", 1))
    existing = spark.createDataFrame([("evt-1",)], "event_id string")
    plan = bronze.write_plan(batch, existing).first()
    assert plan.asDict() == {
        "transformed_count": 4,
        "duplicate_count": 2,
        "write_count": 2,
        "touched_partition_count": 2,
    }
    fresh = bronze.replay_safe_batch(batch, existing)
    assert {r["event_id"] for r in fresh.collect()} == {"evt-2", "evt-3"}
    assert sorted(fresh.columns) == sorted(BRONZE.names)


def test_write_plan_of_a_replayed_and_of_an_empty_batch(spark):
    existing = spark.createDataFrame([("evt-1",)], "event_id string")
    plan = bronze.write_plan(batch_of(spark, ("evt-1", 0)), existing).first()
    assert (plan["write_count"], plan["duplicate_count"]) == (0, 1)
    empty = bronze.write_plan(batch_of(spark, ("evt-1", 0)).limit(0), existing).first()
    assert list(empty) == [0, 0, 0, 0]


def test_dedupe_keeps_the_first_place(spark):
    batch = batch_of(spark, ("a", 0), ("a", 0), ("b", 1))
    kept = bronze.dedupe_batch(batch.orderBy(F.desc("kafka_offset"))).collect()
    assert {(r["event_id"], r["kafka_offset"]) for r in kept} == {("a", 42), ("b", 44)}
    assert quality.duplicate_count(batch, ["event_id"]).first()[0] == 1


def test_next_offsets_and_touched_partitions(spark):
    got = bronze.next_offsets(message(spark, event(), event())).collect()
    assert [tuple(r) for r in got] == [("t", 0, 44)]
    touched = bronze.touched_partitions(batch_of(spark, ("a", 0), ("b", 0), ("c", 5)))
    assert {tuple(r) for r in touched.select(*BRONZE_PARTITIONS).collect()} == {
        (REGION, 2026, 1, 1, 0),
        (REGION, 2026, 1, 1, 5),
    }


def test_messages_are_dealt_before_they_are_built_and_opened(spark):
    parsed = QUERIES["parse_envelope"](spark, "/root/testdata/sf0.001")
    assert parsed.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    below = plan.rsplit("Exchange", 1)[1]
    assert "payload" not in below and "Generate inline" not in below
