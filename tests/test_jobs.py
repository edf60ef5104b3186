"""The pipeline end to end, on the derived feeds and on a small power feed."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_envelope_bronze import event, message

from gridlake import schemas as S
from gridlake.__main__ import instant, main, parser
from gridlake.operators import coverage
from gridlake.operators.quality import QualityError
from gridlake.plans import jobs, queries
from gridlake.session import shared_dir
from gridlake.sources import feed, notes, tables, versions
from gridlake.streaming import ingest

ROOT = "/root/testdata/sf0.001"
START, END = datetime(2024, 1, 1), datetime(2024, 1, 6)
AS_OF = datetime(2024, 2, 1)

needs_data = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


def rows(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


@needs_data
def test_hourly_pipeline_equals_the_direct_build_and_repeats(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    early = F.col("timestamp") < F.lit(END)
    for spec in (S.REGION_SPEC, S.FUEL_SPEC):
        topic = f"{tmp_path}/topics/{spec.table}"
        feed.messages(spark, ROOT, spec).filter(early).write.parquet(topic)
        jobs.ingest_topic(ingest.read_topic_files(spark, topic), lake, spec.table)
    contents = []
    before = set(os.listdir(shared_dir(spark)))
    for _ in range(2):
        jobs.run_window(spark, lake, START, END, AS_OF)
        contents.append(
            {m.name: rows(jobs.read_mart(spark, lake, m)) for m in jobs.MARTS}
        )
    assert contents[0] == contents[1]
    assert set(os.listdir(shared_dir(spark))) == before  # stages are gone
    assert {name for name, found in contents[0].items() if not found} == {jobs.POWER.name}

    bronze = {
        spec.dataset: tables.read_bronze(spark, lake.bronze, spec.dataset)
        for spec in (S.REGION_SPEC, S.FUEL_SPEC)
    }
    usable = (
        feed.events(spark, ROOT)
        .filter(F.col("ingestion_ts") < F.lit(END))
        .filter("event_id % 43 <> 0 and event_id % 41 <> 0")
    )
    hours = usable.select(F.date_trunc("hour", "ts")).distinct().count()
    coverage = jobs.read_mart(spark, lake, jobs.COVERAGE)
    assert coverage.filter(f"dataset_id = '{S.FUEL}' and status <> 'missing'").count() == hours

    # the same fact built straight from the feed, without messages and tables
    direct = queries.gold_region(spark, ROOT).filter(F.col("period") < F.lit(END))
    stored = tables.read_table(spark, lake.fact(jobs.REGION_FACT), S.GOLD_REGION)
    key = ["period", "respondent"]
    assert stored.count() > 0.9 * direct.count()
    assert stored.join(direct.select(*key), key, "left_anti").count() == 0

    summary = {
        (r["stage"], r["dataset_id"]): r
        for r in jobs.compare_layers(
            spark, lake, S.REGION, bronze[S.REGION], START, END
        ).collect()
    }
    assert summary["bronze", S.REGION]["status"] == "ok"
    assert summary["silver", S.REGION]["extra_count"] == 0
    assert set(summary) == {
        ("bronze", S.REGION),
        ("silver", S.REGION),
        ("gold", S.REGION),
        ("platinum", "platinum.region_demand_daily"),
        ("platinum", "platinum.grid_operations_hourly"),
        ("platinum", "platinum.resource_planning_daily"),
    }
    open_jobs = spark.createDataFrame([], "dataset_id string, hour_start_utc timestamp, status string")
    chosen = jobs.choose_repairs(spark, lake, S.REGION, END, open_jobs)
    stored = jobs.read_mart(spark, lake, jobs.COVERAGE)
    gaps = stored.filter(f"dataset_id = '{S.REGION}' and status = 'missing'")
    assert 0 < chosen.count() == gaps.filter(F.col("hour_start_utc") < F.lit(END)).count()
    assert chosen.filter("coverage_status <> 'missing'").count() == 0


def power_event(number, fuel, generation, month="2026-01", loaded="2026-02-01T00:00:00+00:00"):
    payload = {
        "period": month,
        "location": "US",
        "stateDescription": "U.S. Total",
        "sectorid": "1",
        "sectorDescription": "Utility",
        "fueltypeid": fuel,
        "fuelTypeDescription": fuel,
        "ash-content": None,
        "ash-content-units": "percent",
        "consumption-for-eg": "10",
        "consumption-for-eg-units": "thousand barrels",
        "generation": generation,
        "generation-units": "thousand megawatthours",
        "heat-content": "20",
        "heat-content-units": "btu per barrels",
    }
    text = json.loads(event(f"p{number}", f"{month}-01T00:00:00+00:00", S.POWER))
    return json.dumps({**text, "ingestion_timestamp": loaded, "payload": payload})


def test_power_pipeline_takes_revisions(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    window = (at(1), datetime(2026, 2, 1))

    def run(*texts):
        ingest.write_batch(message(spark, *texts), lake.bronze, lake.quarantine)
        jobs.clean_dataset(spark, lake, S.POWER, *window)
        jobs.curate_power(spark, lake, *window)
        jobs.build_power_monthly(spark, lake, *window)
        mart = jobs.read_mart(spark, lake, jobs.POWER)
        return {r["fueltype_id"]: r["generation_share_pct"] for r in mart.collect()}

    assert run(power_event(1, "COL", "60"), power_event(2, "NG", "40")) == {
        "COL": 60.0,
        "NG": 40.0,
    }
    later = "2026-02-02T00:00:00+00:00"
    revised = run(power_event(3, "NG", "140", loaded=later), power_event(4, "X", "-5"))
    assert revised == {"COL": 30.0, "NG": 70.0, "X": 0.0}


def region_event(number, unit="MWh", value="1", hour=0):
    at = f"2026-01-01T{hour:02d}"
    return event(
        f"r{number}",
        f"{at}:00:00+00:00",
        **{
            "period": at,
            "respondent": "PJM",
            "respondent-name": "PJM",
            "type": "D",
            "value": value,
            "value-units": unit,
        },
    )


def test_a_broken_rule_publishes_nothing(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    ingest.write_batch(
        message(spark, region_event(1), region_event(2, "GW")), lake.bronze, lake.quarantine
    )
    with pytest.raises(QualityError, match="unsupported values for value_units"):
        jobs.clean_dataset(spark, lake, S.REGION)
    assert not tables.exists(spark, lake.silver(S.REGION_SPEC))


def test_validation_only_writes_nothing(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    ingest.write_batch(message(spark, region_event(1)), lake.bronze, lake.quarantine)
    assert jobs.clean_dataset(spark, lake, S.REGION, validate_only=True).count() == 1
    assert not tables.exists(spark, lake.silver(S.REGION_SPEC))


def test_jobs_on_an_empty_lake_do_nothing(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    jobs.clean_dataset(spark, lake, S.FUEL, at(1), at(2))
    jobs.curate_power(spark, lake)
    jobs.build_region_daily(spark, lake, at(1), at(2))
    jobs.build_grid_operations(spark, lake, at(2))
    jobs.build_resource_planning(spark, lake, at(2))
    jobs.verify_coverage(spark, lake, S.FUEL, at(2))
    assert not any(tables.exists(spark, lake.mart(m.name)) for m in jobs.MARTS)


def test_region_daily_floors_its_window(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    texts = [region_event(h, value=str(h), hour=h) for h in (1, 9)]
    ingest.write_batch(message(spark, *texts), lake.bronze, lake.quarantine)
    jobs.clean_dataset(spark, lake, S.REGION)
    jobs.curate_hourly(spark, lake, S.REGION, at(1), at(2))
    jobs.build_region_daily(spark, lake, at(1, 8), at(1, 10))
    row = jobs.read_mart(spark, lake, jobs.REGION_DAILY).first()
    assert row["daily_demand_mwh"] == 10.0
    assert (row["source_window_start"], row["source_window_end"]) == (at(1), at(1, 10))


def test_jobs_without_a_window(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    texts = [region_event(h, value=str(h), hour=h) for h in (1, 9)]
    fuels = [power_event(1, "COL", "60"), power_event(2, "NG", "40")]
    ingest.write_batch(message(spark, *texts, *fuels), lake.bronze, lake.quarantine)
    jobs.clean_dataset(spark, lake, S.REGION)
    jobs.clean_dataset(spark, lake, S.POWER)
    jobs.curate_hourly(spark, lake, S.REGION)
    jobs.curate_power(spark, lake)
    jobs.build_region_daily(spark, lake)
    jobs.build_grid_operations(spark, lake, drop_unmeasured=True)
    jobs.build_resource_planning(spark, lake)
    jobs.build_power_monthly(spark, lake)
    daily = jobs.read_mart(spark, lake, jobs.REGION_DAILY).first()
    assert (daily["daily_demand_mwh"], daily["source_window_start"]) == (10.0, None)
    assert jobs.read_mart(spark, lake, jobs.GRID_STATUS).count() == 2
    assert jobs.read_mart(spark, lake, jobs.PLANNING).count() == 1
    assert jobs.read_mart(spark, lake, jobs.POWER).count() == 2


def test_coverage_reads_partition_columns_only(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    texts = [region_event(h, value=str(h), hour=h) for h in (1, 1, 9)]
    ingest.write_batch(message(spark, *texts), lake.bronze, lake.quarantine)
    counts = coverage.partition_counts(tables.read_bronze(spark, lake.bronze, S.REGION))
    got = {r["hour_start_utc"]: r["observed_row_count"] for r in counts.collect()}
    assert got == {at(1, 1): 1, at(1, 9): 1}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def seen(number, day, hour):
    return event(f"s{number}", f"2026-01-{day:02d}T{hour:02d}:00:00+00:00")


def stored_hours(spark, lake):
    table = jobs.hour_counts(spark, lake, S.REGION)
    return {r["hour_start_utc"]: r["observed_row_count"] for r in table.collect()}


def test_coverage_counts_touched_days_only(spark, tmp_path, at, monkeypatch):
    lake = jobs.Lake(str(tmp_path))

    def append(*events):
        ingest.write_batch(message(spark, *events), lake.bronze, lake.quarantine)

    append(seen(1, 1, 1), seen(2, 2, 1))
    assert stored_hours(spark, lake) == {at(1, 1): 1, at(2, 1): 1}
    assert notes.pending(spark, lake.bronze, S.REGION) == []
    opened = []
    read = tables.read_bronze_days

    def recording(spark, path, days):
        opened.extend(day["event_day"] for day in days)
        return read(spark, path, days)

    monkeypatch.setattr(tables, "read_bronze_days", recording)
    monkeypatch.setattr(tables, "read_bronze", None)  # all of Bronze is not listed again
    # a row added to an hour that is there, and an hour filled in, both of day 1
    append(seen(3, 1, 1), seen(4, 1, 0))
    assert stored_hours(spark, lake) == {at(1, 0): 1, at(1, 1): 2, at(2, 1): 1}
    assert opened == [1]
    # nothing new: nothing is opened, and no version is written
    version = versions.version(spark, lake.hour_counts(S.REGION)).number
    assert stored_hours(spark, lake)[at(1, 1)] == 2
    assert opened == [1]
    assert versions.version(spark, lake.hour_counts(S.REGION)).number == version


def test_notes_outlive_a_failed_count_and_a_replay(spark, tmp_path, at, monkeypatch):
    lake = jobs.Lake(str(tmp_path))
    batch = message(spark, seen(1, 1, 1))
    ingest.write_batch(batch, lake.bronze, lake.quarantine)
    stored_hours(spark, lake)
    again = message(spark, seen(2, 1, 1))
    # the batch fails between the append and its note; its replay notes the day all the same
    with monkeypatch.context() as failing, pytest.raises(OSError):
        failing.setattr(notes, "leave", lambda *_: (_ for _ in ()).throw(OSError()))
        ingest.write_batch(again, lake.bronze, lake.quarantine)
    assert stored_hours(spark, lake) == {at(1, 1): 1}
    ingest.write_batch(again, lake.bronze, lake.quarantine)
    # counting fails before its result is stored: the note is still there
    with monkeypatch.context() as failing, pytest.raises(OSError):
        failing.setattr(tables, "upsert_table", lambda *_, **__: (_ for _ in ()).throw(OSError()))
        stored_hours(spark, lake)
    assert len(notes.pending(spark, lake.bronze, S.REGION)) == 1
    assert stored_hours(spark, lake) == {at(1, 1): 2}


def test_recount_sees_rows_without_notes(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    ingest.write_batch(message(spark, seen(1, 1, 1)), lake.bronze, lake.quarantine)
    stored_hours(spark, lake)
    other = tables.read_bronze(spark, lake.bronze, S.REGION).withColumn("event_hour", F.lit(5))
    tables.append_partitioned(tables.materialized(other, "other"), lake.bronze)
    assert stored_hours(spark, lake) == {at(1, 1): 1}
    jobs.verify_coverage(spark, lake, S.REGION, at(1, 6), recount=True)
    assert stored_hours(spark, lake) == {at(1, 1): 1, at(1, 5): 1}
    found = jobs.read_mart(spark, lake, jobs.COVERAGE)
    assert {r["status"]: r["hours"] for r in found.groupBy("status").agg(
        F.count("*").alias("hours")).collect()} == {"verified": 2, "missing": 3}


def test_repairs_and_comparison_from_the_command_line(spark, tmp_path, at):
    lake = jobs.Lake(str(tmp_path))
    texts = [region_event(h, value=str(h), hour=h) for h in (1, 4)]
    ingest.write_batch(message(spark, *texts), lake.bronze, lake.quarantine)
    root = ["--root", str(tmp_path), "--dataset", S.REGION]
    main(["clean", *root])
    main(["verify-coverage", *root, "--end", "2026-01-01T06:00:00Z"])
    main(["choose-repairs", *root, "--end", "2026-01-01T06:00:00Z", "--output", f"{tmp_path}/gaps"])
    assert spark.read.csv(f"{tmp_path}/gaps", header=True).count() == 3
    raw = f"{tmp_path}/raw"
    tables.read_bronze(spark, lake.bronze, S.REGION).write.parquet(raw)
    main(["compare", *root, "--raw", raw, "--output", f"{tmp_path}/compared"])
    found = spark.read.csv(f"{tmp_path}/compared", header=True).collect()
    assert {r["stage"]: r["status"] for r in found if r["stage"] in ("bronze", "silver")} == {
        "bronze": "ok",
        "silver": "ok",
    }


def test_command_line():
    args = parser().parse_args(["clean", "--root", "/x", "--start", "2026-01-01T00:00:00Z"])
    assert (args.job, args.start, args.dataset) == ("clean", datetime(2026, 1, 1), None)
    args = parser().parse_args(["grid-operations", "--root", "/x", "--end", "2026-01-31"])
    assert args.lookback_days == S.GRID_LOOKBACK_DAYS and not args.drop_unmeasured
    assert instant("2026-01-01T05:00:00+05:00") == datetime(2026, 1, 1)
    assert instant("2026-01-01") + timedelta(days=1) == datetime(2026, 1, 2)
    with pytest.raises(SystemExit):
        parser().parse_args(["clean", "--root", "/x", "--dataset", "unknown"])
