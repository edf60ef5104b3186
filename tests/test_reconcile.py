from __future__ import annotations

import json

from pyspark.sql import functions as F

from gridlake.operators import bronze, reconcile, silver
from gridlake.plans import jobs
from gridlake.schemas import FUEL_SPEC, GRAIN_KEYS, POWER, POWER_SPEC, REGION, REGION_SPEC
from gridlake.sources import feed, tables
from test_envelope_bronze import event, message


def keys(spark, at, *names, hour=0):
    data = [(n, at(1, hour), "PJM", "D") for n in names]
    return spark.createDataFrame(data, GRAIN_KEYS)


def row(df):
    return df.first().asDict()


def test_missing_and_extra(spark, at):
    expected, actual = keys(spark, at, "k1", "k2"), keys(spark, at, "k1", "k3")
    got = reconcile.reconcile(expected, actual).collect()
    assert {(r["grain_key"], r["reason"]) for r in got} == {("k2", "missing"), ("k3", "extra")}
    summary = row(reconcile.summary(expected, actual, "silver", REGION))
    assert summary == {
        "stage": "silver",
        "dataset_id": REGION,
        "status": "mismatch",
        "expected_count": 2,
        "actual_count": 2,
        "missing_count": 1,
        "extra_count": 1,
    }
    period = row(reconcile.by_period(expected, actual))
    assert (period["expected_count"], period["missing_count"], period["extra_count"]) == (2, 1, 1)


def test_statuses(spark, at):
    one, two, none = keys(spark, at, "k1"), keys(spark, at, "k1", "k1"), keys(spark, at)

    def status(expected, actual):
        return row(reconcile.summary(expected, actual, "s", "d"))["status"]

    assert status(none, none) == "not_populated"
    assert status(one, one) == "ok"
    assert status(one, two) == "count_mismatch"
    assert status(one, none) == "mismatch"


def test_differences_are_the_symmetric_difference(spark, at):
    left, right = [f"k{i % 13}" for i in range(50)], [f"k{i % 17}" for i in range(5, 40)]
    got = reconcile.reconcile(keys(spark, at, *left), keys(spark, at, *right))
    assert {r["grain_key"] for r in got.collect()} == set(left) ^ set(right)


def test_window_edge(spark, at):
    df = keys(spark, at, "in", hour=23).union(
        spark.createDataFrame([("out", at(2), "PJM", "D")], GRAIN_KEYS)
    )
    assert [r["grain_key"] for r in reconcile.trim(df, at(1), at(2)).collect()] == ["in"]


def raw(spark, *texts):
    return bronze.parse_envelope(message(spark, *texts))


def region_event(number, hour, kind, value="1"):
    return event(
        f"e{number}",
        f"2026-01-01T{hour:02d}:00:00+00:00",
        period=f"2026-01-01T{hour:02d}",
        respondent="PJM",
        type=kind,
        value=value,
    )


def test_expected_keys_per_layer(spark, at):
    rows = raw(
        spark,
        region_event(1, 0, "D"),
        region_event(2, 0, "DF"),
        region_event(3, 1, "D"),
        region_event(3, 1, "D"),
        region_event(4, 2, "DF"),
        region_event(5, 3, "D", "n/a"),
    )

    def found(target):
        got = reconcile.expected_keys(rows, REGION_SPEC, target).collect()
        return sorted(r["grain_key"] for r in got)

    assert len(found("bronze")) == 6
    assert len(found("silver")) == 4
    assert found("gold") == [f"2026-01-01T0{h}:00:00Z|PJM|" for h in range(3)]
    assert found(reconcile.HOURLY_MART) == found("gold")
    assert found(reconcile.DAILY_MARTS[0]) == ["2026-01-01T00:00:00Z|PJM|"]
    stored = reconcile.bronze_keys(rows, REGION_SPEC).collect()
    assert sorted(r["grain_key"] for r in stored) == found("bronze")


def test_power_keys(spark):
    payload = {
        "period": "2026-01",
        "location": "US",
        "stateDescription": "U.S.",
        "sectorid": "1",
        "sectorDescription": "s",
        "fueltypeid": "COL",
        "fuelTypeDescription": "coal",
    }
    text = json.loads(event("p", "2026-01-01T00:00:00+00:00", POWER))
    rows = raw(spark, json.dumps({**text, "payload": payload}))
    wanted = ["2026-01-01T00:00:00Z|US|1|COL"]
    for target in ("bronze", "silver", "gold", reconcile.POWER_MART):
        got = reconcile.expected_keys(rows, POWER_SPEC, target).collect()
        assert [r["grain_key"] for r in got] == wanted
    assert [r["grain_key"] for r in reconcile.bronze_keys(rows, POWER_SPEC).collect()] == wanted


def test_digests_ignore_order_and_partitioning(spark, at):
    names = [f"k{i % 40}" for i in range(60)]
    one, other = keys(spark, at, *names), keys(spark, at, *reversed(names)).repartition(5)
    assert reconcile.differing_hours(reconcile.digests(one), reconcile.digests(other)).count() == 0
    for changed in (names[1:], [*names, "k1"], [*names[1:], "k99"], []):
        digest = reconcile.digests(keys(spark, at, *changed))
        assert [r["hour"] for r in reconcile.differing_hours(reconcile.digests(one), digest).collect()] == [at(1)]


def test_only_days_that_differ_are_opened(spark, at, tmp_path):
    """The stored sides agree on all days but one."""

    def stored(name, *skipped):
        rows = [(f"{d}-{i}", at(d, i % 24), "PJM", "D") for d in range(1, 9) for i in range(30) if (d, i) not in skipped]
        path = f"{tmp_path}/{name}"
        table = spark.createDataFrame(rows, GRAIN_KEYS).withColumn("event_date", F.to_date("period_start_utc"))
        tables.overwrite_partitions(table, path)
        opened = []
        read = jobs.stored_keys(spark, path)

        def watched(days):
            rows = read(days)
            if days is not None:
                opened.append((days, rows.inputFiles()))
            return rows

        return watched, opened, spark.createDataFrame(rows, GRAIN_KEYS)

    (expected, opened, all_expected), (actual, seen, all_actual) = stored("expected", (5, 3)), stored("actual", (5, 27), (5, 9))
    got = reconcile.reconcile_by_digests(expected, actual).collect()
    assert sorted(map(str, got)) == sorted(map(str, reconcile.reconcile(all_expected, all_actual).collect()))
    assert {(r["grain_key"], r["reason"]) for r in got} == {("5-3", "extra"), ("5-27", "missing"), ("5-9", "missing")}
    for days, files in (*opened, *seen):
        assert days == {at(5).date()} and files and all("event_date=2026-01-05" in f for f in files)


def test_layers_are_compared_by_digests(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    raw = feed.bronze_fuel(spark, "/root/testdata/sf0.001")
    cleaned = silver.clean_fuel(raw).filter("respondent != 'PJM' or hour(period) != 3")
    tables.overwrite_partitions(cleaned, lake.silver(FUEL_SPEC))
    got = jobs.differences(spark, lake, FUEL_SPEC.dataset, raw, "silver", "2024-01-03", "2024-01-10")
    expected = reconcile.reconcile(
        reconcile.trim(reconcile.expected_keys(raw, FUEL_SPEC, "silver"), "2024-01-03", "2024-01-10"),
        reconcile.trim(reconcile.silver_keys(cleaned, FUEL_SPEC), "2024-01-03", "2024-01-10"),
    )
    rows = sorted(map(str, got.collect()))
    assert rows and rows == sorted(map(str, expected.collect()))
