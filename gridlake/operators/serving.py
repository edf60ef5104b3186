"""Read queries over the marts and over job and run tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import as_instant
from gridlake.operators.rank import latest_by_key

# --- fixed values: how late a workflow may be, by name pattern, first match wins

EXPECTED_LAG_MINUTES = (
    ("electricity_fuel_type_data_incremental", 26 * 60),
    ("%\\_incremental", 2 * 60),
    ("%\\_backfill", 20),
    ("%\\_bronze\\_hourly\\_verification", 2 * 60),
    ("%\\_bronze\\_hourly\\_repair", 2 * 60),
    ("platinum\\_%", 2 * 60),
)
DEFAULT_LAG_MINUTES = 6 * 60
OWN_WORKFLOWS = ("electricity_%", "platinum_%")

Limit = datetime | date | str | None


def selected(
    df: DataFrame,
    time: str,
    first: Limit = None,
    last: Limit = None,
    entities: Sequence[str] | None = None,
) -> DataFrame:
    """Rows between ``first`` and ``last``, both included, of the listed respondents."""
    if first is not None:
        df = df.filter(F.col(time) >= F.lit(first).cast(df.schema[time].dataType))
    if last is not None:
        df = df.filter(F.col(time) <= F.lit(last).cast(df.schema[time].dataType))
    if entities:
        df = df.filter(F.col("respondent").isin(*entities))
    return df


def history(
    df: DataFrame,
    time: str,
    first: Limit = None,
    last: Limit = None,
    entities: Sequence[str] | None = None,
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """``selected`` in display order."""
    return selected(df, time, first, last, entities).orderBy(*(order or [time, "respondent"]))


def latest_snapshot(
    df: DataFrame,
    time: str,
    first: Limit = None,
    last: Limit = None,
    entities: Sequence[str] | None = None,
) -> DataFrame:
    """The selected rows at the latest time among them.

    The latest time is a scalar subquery: it runs first and reaches the scan of the
    main query as a plain predicate.
    """
    rows = selected(df, time, first, last, entities)
    return rows.filter(F.col(time) == rows.agg(F.max(time)).scalar())


def alert_rollup(alerts: DataFrame) -> DataFrame:
    """Per respondent: number of alerts and whether any is high or medium."""
    severity = F.lower("severity")
    return alerts.groupBy("respondent").agg(
        F.count("*").alias("active_alert_count"),
        F.bool_or(severity == "high").alias("has_high_alert"),
        F.bool_or(severity == "medium").alias("has_medium_alert"),
    )


def grid_watchlist(
    status: DataFrame,
    alerts: DataFrame,
    first: Limit = None,
    last: Limit = None,
    entities: Sequence[str] | None = None,
) -> DataFrame:
    """The latest status rows with a rollup of the alerts of that hour."""
    rows = selected(status, "period", first, last, entities)
    latest = rows.agg(F.max("period")).scalar()
    current = rows.filter(F.col("period") == latest)
    raised = selected(alerts, "period", first, last, entities).filter(F.col("period") == latest)
    return current.join(alert_rollup(raised), "respondent", "left").select(
        "period",
        "respondent",
        "respondent_name",
        "actual_demand_mwh",
        "forecast_error_mwh",
        "forecast_error_zscore",
        "demand_ramp_zscore",
        "coverage_ratio",
        F.coalesce("active_alert_count", F.lit(0)).alias("active_alert_count"),
        F.coalesce("has_high_alert", F.lit(False)).alias("has_high_alert"),
        F.coalesce("has_medium_alert", F.lit(False)).alias("has_medium_alert"),
    )


def table_coverage(df: DataFrame, time: str, entity: str = "respondent") -> DataFrame:
    """One row: time range, rows and distinct entities of a mart."""
    return df.agg(
        F.min(time).alias(f"min_{time}"),
        F.max(time).alias(f"max_{time}"),
        F.count("*").alias("row_count"),
        F.count_distinct(entity).alias(f"{entity}_count"),
    )


def list_entities(df: DataFrame, entity: str = "respondent") -> DataFrame:
    return df.select(entity).filter(F.col(entity).isNotNull()).distinct().orderBy(entity)


def status_rollup(
    jobs: DataFrame, by: Sequence[str], start: str, end: str, updated: str = "updated_at"
) -> DataFrame:
    """Jobs per group: count, covered range and last update."""
    return jobs.groupBy(*by).agg(
        F.count("*").alias("job_count"),
        F.min(start).alias(f"min_{start}"),
        F.max(end).alias(f"max_{end}"),
        F.max(updated).alias(f"last_{updated}"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("target_name"), "*")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionAll(part)
    return result


def own_workflow(name: str) -> Column:
    match = F.lit(False)
    for pattern in OWN_WORKFLOWS:
        match = match | F.col(name).like(pattern)
    return match


def expected_lag(name: str) -> Column:
    """Minutes a workflow may be behind."""
    lag = F.lit(DEFAULT_LAG_MINUTES)
    for pattern, minutes in reversed(EXPECTED_LAG_MINUTES):
        lag = F.when(F.col(name).like(pattern), minutes).otherwise(lag)
    return lag


def latest_run_health(workflows: DataFrame, runs: DataFrame, as_of: datetime) -> DataFrame:
    """Latest run per workflow and whether it is overdue at ``as_of``.

    A paused workflow is never overdue, one that never ran always is.
    """
    started = runs.withColumn("_at", F.coalesce("start_date", "execution_date"))
    newest = latest_by_key(started, ["dag_id"], ["_at", "run_id"]).select(
        "dag_id",
        F.col("state").alias("latest_run_state"),
        F.col("start_date").alias("latest_run_start"),
        F.col("end_date").alias("latest_run_end"),
    )
    behind = (
        F.unix_micros(as_instant(as_of)) - F.unix_micros("latest_run_start")
    ) > expected_lag("dag_id").cast("bigint") * 60_000_000
    return (
        workflows.filter(own_workflow("dag_id"))
        .join(newest, "dag_id", "left")
        .withColumn(
            "is_overdue", ~F.col("is_paused") & (F.col("latest_run_start").isNull() | behind)
        )
    )


def recent_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """The most recent runs."""
    at = F.coalesce("start_date", "queued_at", "execution_date")
    return (
        runs.filter(own_workflow("dag_id"))
        .orderBy(at.desc(), F.col("run_id").desc())
        .limit(limit)
        .select("dag_id", "run_id", "state", "queued_at", "start_date", "end_date")
    )


def recent_failures(tasks: DataFrame, limit: int = 20) -> DataFrame:
    """The most recent failed tasks."""
    at = F.coalesce("end_date", "start_date")
    return (
        tasks.filter((F.col("state") == "failed") & own_workflow("dag_id"))
        .orderBy(at.desc(), F.col("run_id").desc(), F.col("task_id"))
        .limit(limit)
        .select("dag_id", "task_id", "run_id", "state", "start_date", "end_date")
    )
