from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gridlake.operators import coverage, serving
from gridlake.schemas import HOURLY_COVERAGE

EVENTS = "event_ts timestamp"


def events(spark, *stamps):
    return spark.createDataFrame([(s,) for s in stamps], EVENTS)


def test_coverage_golden_case(spark, at):
    df = events(spark, at(1, 0, 5), at(1, 0, 25), at(1, 1, 15), at(1, 2, 5), at(1, 2, 35))
    got = coverage.hourly_coverage(df, "d", at(1, 4), at(2))
    assert {
        r["hour_start_utc"].hour: (r["observed_row_count"], r["status"], r["expected_row_count"])
        for r in got.collect()
    } == {0: (2, "verified", 2), 1: (1, "partial", 2), 2: (2, "verified", 2), 3: (0, "missing", 2)}
    assert got.columns == HOURLY_COVERAGE.names
    summary = {r["status"]: r["hour_count"] for r in coverage.coverage_summary(got).collect()}
    assert summary == {"verified": 2, "partial": 1, "missing": 1}


def test_coverage_ties_boundary_and_empty(spark, at):
    tie = events(spark, at(1, 0), at(1, 1), at(1, 1, 1), at(1, 5))
    counts = coverage.hourly_counts(tie)
    assert coverage.modal_count(counts).first()[0] == 1
    even = coverage.hourly_counts(events(spark, at(1, 0), at(1, 1), at(1, 1, 1)))
    assert coverage.modal_count(even).first()[0] == 2
    # a boundary before the first hour still gives that hour, hours beyond are not listed
    got = coverage.hourly_coverage(tie, "d", at(1, 0)).collect()
    assert [r["hour_start_utc"] for r in got] == [at(1, 0)]
    empty = events(spark)
    assert coverage.modal_count(coverage.hourly_counts(empty)).first()[0] is None
    assert coverage.hourly_coverage(empty, "d", at(1, 4)).count() == 0


def test_excess_hours(spark, at):
    df = events(spark, at(1, 0), at(1, 1), at(1, 2), at(1, 2, 1))
    got = coverage.hourly_coverage(df, "d", at(1, 3)).filter("status = 'excess'").collect()
    assert [(r["hour_start_utc"], r["row_count_delta"]) for r in got] == [(at(1, 2), 1)]


def covered(spark, at, *hours):
    return spark.createDataFrame(
        [("d", at(1, h), status) for h, status in hours],
        "dataset_id string, hour_start_utc timestamp, status string",
    )


def test_repair_windows_count_open_ones(spark, at):
    stored = covered(
        spark, at, *[(h, "missing") for h in (5, 1, 3, 2)], (4, "partial"), (6, "verified")
    )
    jobs = spark.createDataFrame(
        [("d", at(1, 2), "pending"), ("d", at(1, 3), "completed"), ("x", at(1, 1), "pending")],
        "dataset_id string, hour_start_utc timestamp, status string",
    )

    def hours(**options):
        got = coverage.repair_windows(stored, jobs, "d", at(1, 5), **options)
        return sorted(r["hour_start_utc"].hour for r in got.collect())

    assert hours() == [1, 3]
    assert hours(max_open=2) == [1]
    assert hours(max_open=0, statuses=("missing", "partial")) == [1, 3, 4]
    row = coverage.repair_windows(stored, jobs, "d", at(1, 5)).first()
    assert row["hour_end_utc"] - row["hour_start_utc"] == timedelta(hours=1)


STATUS = (
    "period timestamp, respondent string, respondent_name string, actual_demand_mwh double,"
    " forecast_error_mwh double, forecast_error_zscore double, demand_ramp_zscore double,"
    " coverage_ratio double"
)


def ops(spark, at):
    return spark.createDataFrame(
        [(at(1, h), r, r, float(h), 0.0, 0.0, 0.0, 1.0) for h in range(3) for r in "BA"]
        + [(at(1, 3), "C", "C", 9.0, 0.0, 0.0, 0.0, 1.0)],
        STATUS,
    )


def test_history_and_snapshot(spark, at):
    df = ops(spark, at)
    got = serving.history(df, "period", at(1, 1), at(1, 2), ["A", "B"]).collect()
    assert [(r["period"].hour, r["respondent"]) for r in got] == [
        (1, "A"),
        (1, "B"),
        (2, "A"),
        (2, "B"),
    ]
    assert serving.selected(df, "period", entities=[]).count() == 7
    latest = serving.latest_snapshot(df, "period", entities=["A", "B"]).collect()
    assert {(r["period"].hour, r["respondent"]) for r in latest} == {(2, "A"), (2, "B")}
    assert serving.latest_snapshot(df, "period", first=at(5)).count() == 0


def test_watchlist(spark, at):
    alerts = spark.createDataFrame(
        [(at(1, 2), "A", "HIGH"), (at(1, 2), "A", "medium"), (at(1, 1), "B", "high")],
        "period timestamp, respondent string, severity string",
    )
    got = serving.grid_watchlist(ops(spark, at), alerts, last=at(1, 2))
    assert {
        r["respondent"]: (r["active_alert_count"], r["has_high_alert"], r["has_medium_alert"])
        for r in got.collect()
    } == {"A": (2, True, True), "B": (0, False, False)}


def test_table_summaries(spark, at):
    df = ops(spark, at)
    assert serving.table_coverage(df, "period").first().asDict() == {
        "min_period": at(1, 0),
        "max_period": at(1, 3),
        "row_count": 7,
        "respondent_count": 3,
    }
    assert [r[0] for r in serving.list_entities(df).collect()] == ["A", "B", "C"]
    counts = serving.table_counts({"x": df, "y": df.limit(0)})
    assert {r["target_name"]: r["row_count"] for r in counts.collect()} == {"x": 7, "y": 0}


RUNS = (
    "dag_id string, run_id string, state string, execution_date timestamp, queued_at timestamp,"
    " start_date timestamp, end_date timestamp"
)


def test_run_health(spark):
    now = datetime(2026, 1, 2, 12)

    def run(name, run_id, hours_ago, state="success"):
        start = None if hours_ago is None else now - timedelta(hours=hours_ago)
        return (name, run_id, state, now - timedelta(days=9), None, start, None)

    runs = spark.createDataFrame(
        [
            run("electricity_fuel_type_data_incremental", "1", 25),
            run("electricity_region_data_incremental", "1", 1),
            run("electricity_region_data_incremental", "2", 3, "failed"),
            run("platinum_x", "1", 2),
            run("platinum_late", "1", 2.01),
            run("electricity_x_backfill", "1", 0.5),
            run("electricity_other", "1", 5),
            run("unrelated", "1", 99),
            run("electricity_unstarted", "1", None),
        ],
        RUNS,
    )
    named = runs.select("dag_id").distinct().union(
        spark.createDataFrame([("electricity_never",), ("platinum_paused",)], "dag_id string")
    )
    flows = named.withColumn("is_paused", F.col("dag_id") == "platinum_paused")
    got = {r["dag_id"]: r for r in serving.latest_run_health(flows, runs, now).collect()}
    assert {k: r["is_overdue"] for k, r in got.items()} == {
        "electricity_fuel_type_data_incremental": False,
        "electricity_region_data_incremental": False,
        "platinum_x": False,
        "platinum_late": True,
        "electricity_x_backfill": True,
        "electricity_other": False,
        "electricity_never": True,
        "electricity_unstarted": True,
        "platinum_paused": False,
    }
    assert got["electricity_region_data_incremental"]["latest_run_state"] == "success"
    recent = serving.recent_runs(runs, 2).collect()
    assert [r["dag_id"] for r in recent] == [
        "electricity_x_backfill",
        "electricity_region_data_incremental",
    ]
    failed = serving.recent_failures(runs.withColumn("task_id", F.lit("t"))).collect()
    assert [r["run_id"] for r in failed] == ["2"]
