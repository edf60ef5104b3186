"""Gap detection on an hour spine."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import as_instant, now_or


def hourly_counts(events: DataFrame) -> DataFrame:
    """Rows per observed hour."""
    return (
        events.filter(F.col("event_ts").isNotNull())
        .groupBy(F.date_trunc("hour", "event_ts").alias("hour_start_utc"))
        .agg(F.count("*").alias("observed_row_count"))
    )


def partition_counts(bronze: DataFrame) -> DataFrame:
    """Rows per hour of one dataset's Bronze table, from its partition columns alone.

    The hour is the partition, so Spark counts rows without reading a column.
    """
    hour = F.make_timestamp(
        "event_year", "event_month", "event_day", "event_hour", F.lit(0), F.lit(0)
    )
    return bronze.groupBy(hour.alias("hour_start_utc")).agg(
        F.count("*").alias("observed_row_count")
    )


def count_profile(counts: DataFrame, boundary: datetime | str | Column) -> DataFrame:
    """One row: the usual hourly count and the ends of the hour spine.

    The usual count is the most frequent one, the larger on a tie. The spine ends
    an hour before ``boundary``, but never before it starts.
    """
    by_count = counts.groupBy("observed_row_count").agg(
        F.count("*").alias("hours"), F.min("hour_start_utc").alias("first")
    )
    before = as_instant(boundary) - F.expr("INTERVAL 1 HOUR")
    return by_count.agg(
        F.max(F.struct("hours", "observed_row_count")).alias("usual"),
        F.min("first").alias("oldest_hour_utc"),
    ).select(
        F.col("usual.observed_row_count").cast("int").alias("expected_row_count"),
        "oldest_hour_utc",
        F.when(
            F.col("oldest_hour_utc").isNotNull(), F.greatest(F.col("oldest_hour_utc"), before)
        ).alias("newest_hour_utc"),
    )


def modal_count(counts: DataFrame) -> DataFrame:
    """One row: the most frequent hourly count, null without rows."""
    by_count = counts.groupBy("observed_row_count").agg(F.count("*").alias("hours"))
    return by_count.agg(F.max(F.struct("hours", "observed_row_count")).alias("usual")).select(
        F.col("usual.observed_row_count").cast("int").alias("expected_row_count")
    )


def hour_spine(profile: DataFrame) -> DataFrame:
    """One row per hour between the ends of the profile; none without observations.

    Days come first and are dealt out before they are opened into hours, so no row holds
    an array of all hours and no single task makes them.
    """
    days = F.expr("sequence(to_date(oldest_hour_utc), to_date(newest_hour_utc))")
    hours = F.expr(
        "sequence(timestamp(_day), timestamp(_day) + INTERVAL 23 HOURS, INTERVAL 1 HOUR)"
    )
    return (
        profile.filter(F.col("oldest_hour_utc").isNotNull())
        .select("*", F.explode(days).alias("_day"))
        .repartition("_day")
        .select("*", F.explode(hours).alias("hour_start_utc"))
        .filter(F.col("hour_start_utc").between(F.col("oldest_hour_utc"), F.col("newest_hour_utc")))
        .drop("_day")
    )


def hourly_coverage(
    events: DataFrame,
    dataset: str,
    boundary: datetime | str | Column,
    verified_at: datetime | str | Column | None = None,
) -> DataFrame:
    """Every hour of the spine with its observed and expected count and a status."""
    return coverage_of(hourly_counts(events), dataset, boundary, verified_at)


def coverage_of(
    counts: DataFrame,
    dataset: str,
    boundary: datetime | str | Column,
    verified_at: datetime | str | Column | None = None,
) -> DataFrame:
    """The same from counts per hour."""
    spine = hour_spine(count_profile(counts, boundary))
    observed, expected = F.col("observed_row_count"), F.col("expected_row_count")
    return (
        spine.join(counts, "hour_start_utc", "left")
        .fillna(0, ["observed_row_count"])
        .select(
            F.lit(dataset).alias("dataset_id"),
            "hour_start_utc",
            "observed_row_count",
            "expected_row_count",
            (observed - expected).alias("row_count_delta"),
            F.when(observed == 0, "missing")
            .when(expected.isNull(), "observed")
            .when(observed == expected, "verified")
            .when(observed < expected, "partial")
            .otherwise("excess")
            .alias("status"),
            "oldest_hour_utc",
            "newest_hour_utc",
            as_instant(boundary).alias("verification_boundary_hour_utc"),
            now_or(verified_at).alias("verified_at"),
        )
    )


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """Hours per dataset and status with their range."""
    return coverage.groupBy("dataset_id", "status").agg(
        F.count("*").alias("hour_count"),
        F.min("hour_start_utc").alias("min_hour_start_utc"),
        F.max("hour_start_utc").alias("max_hour_start_utc"),
        F.max("verified_at").alias("last_verified_at"),
    )


def repair_windows(
    coverage: DataFrame,
    open_jobs: DataFrame,
    dataset: str,
    boundary: datetime | str | Column,
    statuses: Sequence[str] = ("missing",),
    max_open: int = 0,
) -> DataFrame:
    """Hour windows to fetch again, oldest first.

    All of them, unless ``max_open`` says how many windows may be open at a time, those
    already open included. ``open_jobs`` holds (dataset_id, hour_start_utc, status).
    """
    wanted = coverage.filter(
        (F.col("dataset_id") == dataset)
        & F.col("status").isin(*statuses)
        & (F.col("hour_start_utc") < as_instant(boundary))
    ).orderBy("hour_start_utc")
    if max_open > 0:
        wanted = wanted.limit(max_open)
    pending = open_jobs.filter(F.col("status").isin("pending", "in_progress")).select(
        "dataset_id", "hour_start_utc"
    )
    return wanted.join(pending, ["dataset_id", "hour_start_utc"], "left_anti").select(
        "dataset_id",
        "hour_start_utc",
        (F.col("hour_start_utc") + F.expr("INTERVAL 1 HOUR")).alias("hour_end_utc"),
        F.col("status").alias("coverage_status"),
    )
