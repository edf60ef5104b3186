"""Late rows through to the marts: what changed in the facts decides what is built again.

Facts have versions, so the rows that differ between the version the marts follow and the
newest one are found by opening the replaced partitions alone. They give a list of changed
(day, respondent), and that the mart rows they feed:

* daily demand and planning: the same day and respondent;
* grid status and alerts: the day and, by its scores, the ``days`` - 1 that follow.

Only mart partitions with such rows are written again; all other rows keep their values.
Which versions the marts follow is a table of its own, written after the marts: a run that
dies in between is repeated and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import schemas as S
from gridlake.operators import marts
from gridlake.plans import jobs
from gridlake.sources import tables, versions

FOLLOWED = S.table("fact string, version bigint")
_FACTS = {jobs.REGION_FACT: S.GOLD_REGION, jobs.FUEL_FACT: S.GOLD_FUEL}


def _folder(day: date) -> str:
    return f"{tables.DAY}={day.isoformat()}"


def followed(spark: SparkSession, lake: jobs.Lake) -> dict[str, int]:
    """The fact versions that the marts contain; 0 where none has been followed yet."""
    rows = tables.read_table(spark, lake.mart("followed_facts"), FOLLOWED).collect()
    return {name: 0 for name in _FACTS} | {row["fact"]: row["version"] for row in rows}


def changed_rows(
    spark: SparkSession, path: str, schema: T.StructType, keys: Collection[str], since: int, until: int
) -> DataFrame:
    """(day, respondent) of the rows that version ``until`` has otherwise than ``since``.

    Reads the partitions replaced in between, and compares rows by a hash of their columns,
    load times included: the marts carry them.
    """
    replaced = versions.changed_since(spark, path, since)
    values = [name for name in schema.names if name not in keys]

    def hashed(number: int, name: str) -> DataFrame:
        rows = versions.read(spark, path, schema, number, replaced.__contains__)
        return rows.select(*keys, F.xxhash64(*values).alias(name))

    both = hashed(since, "old").join(hashed(until, "new"), list(keys), "full")
    return (
        both.filter(~F.col("old").eqNullSafe(F.col("new")))
        .select(F.to_date("period").alias("day"), "respondent")
        .distinct()
    )


def _facts_of(spark: SparkSession, lake: jobs.Lake, name: str, days: Collection[date], at: int) -> DataFrame:
    """A fact's rows of the given days; no other partition is listed."""
    wanted = {_folder(day) for day in days}
    return versions.read(spark, lake.fact(name), _FACTS[name], at, wanted.__contains__)


def _days(rows: DataFrame) -> list[date]:
    """The days of a stored list: as many as there are days of data."""
    return sorted(row["day"] for row in rows.select("day").distinct().collect())


def replace_rows(
    lake: jobs.Lake, mart: jobs.Mart, fresh: DataFrame, scope: DataFrame
) -> versions.Version | None:
    """Put ``fresh`` in place of the mart's rows of ``scope`` (day, respondent).

    Unlike an upsert this also removes rows that are no longer there. ``scope`` and
    ``fresh`` read stages. Only the partitions that the scope falls in are written.
    """
    spark = fresh.sparkSession
    path = lake.mart(mart.name)
    base = versions.version(spark, path)
    name, place = mart.placed()
    parts = scope.select(F.date_format("day", mart.layout).alias(name)).distinct()
    touched = {f"{name}={row[0]}" for row in parts.collect()}
    fields = T.StructType([*mart.schema.fields, T.StructField(name, T.StringType())])
    current = versions.read(spark, path, fields, base, touched.__contains__)
    inside = (F.to_date(F.col(mart.time)) == F.col("_day")) & (F.col("respondent") == F.col("_respondent"))
    listed = scope.select(F.col("day").alias("_day"), F.col("respondent").alias("_respondent"))
    kept = current.join(listed, inside, "left_anti")
    merged = kept.unionByName(fresh.withColumn(name, place))
    return versions.commit(merged, path, name, base, touched)


def propagate(
    spark: SparkSession,
    lake: jobs.Lake,
    before: datetime | None = None,
    days: int = S.GRID_LOOKBACK_DAYS,
    as_of: jobs.Time = None,
) -> dict[str, versions.Version | None]:
    """Bring the hourly marts up to the newest facts; returns the new version of each.

    ``before`` leaves the grid marts' days from it on to the job that builds the lookback.
    Without facts, or without a change, nothing is written.
    """
    since = followed(spark, lake)
    newest = {name: versions.version(spark, lake.fact(name)).number for name in _FACTS}
    region_keys, fuel_keys = ("period", "respondent"), S.FUEL_SPEC.business_key
    changes = tables.materialized(
        changed_rows(
            spark, lake.fact(jobs.REGION_FACT), S.GOLD_REGION, region_keys,
            since[jobs.REGION_FACT], newest[jobs.REGION_FACT],
        )
        .union(
            changed_rows(
                spark, lake.fact(jobs.FUEL_FACT), S.GOLD_FUEL, fuel_keys,
                since[jobs.FUEL_FACT], newest[jobs.FUEL_FACT],
            )
        )
        .distinct(),
        "late-changes",
    )
    limit = F.lit(True) if before is None else F.col("day") < F.lit(before).cast("date")
    written: dict[str, versions.Version | None] = {}
    if own := _days(changes):
        written |= _daily_marts(spark, lake, own, changes, newest, as_of)
    following = F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("day")
    scored = tables.materialized(
        changes.select(following, "respondent").distinct().filter(limit), "late-scored"
    )
    if own := _days(scored):
        written |= _grid_marts(spark, lake, own, scored, newest, days, as_of)
    state = spark.createDataFrame(list(newest.items()), FOLLOWED)
    if newest != since:
        tables.write_dimension(state, lake.mart("followed_facts"))
    return written


def _only(rows: DataFrame, scope: DataFrame, time: str) -> DataFrame:
    """The rows of ``scope`` (day, respondent)."""
    listed = scope.select(F.col("day").alias("_day"), F.col("respondent").alias("_respondent"))
    same = (F.to_date(F.col(time)) == F.col("_day")) & (F.col("respondent") == F.col("_respondent"))
    return rows.join(listed, same, "left_semi")


def _daily_marts(
    spark: SparkSession, lake: jobs.Lake, days: list[date], scope: DataFrame, at: dict[str, int], as_of: jobs.Time
) -> dict[str, versions.Version | None]:
    region = _only(_facts_of(spark, lake, jobs.REGION_FACT, days, at[jobs.REGION_FACT]), scope, "period")
    fuel = _only(_facts_of(spark, lake, jobs.FUEL_FACT, days, at[jobs.FUEL_FACT]), scope, "period")
    fuels = tables.read_table(spark, lake.dimension("fuel_type"), S.DIM_FUEL)
    day = F.col("date").cast("timestamp")
    after = day + F.make_dt_interval(F.lit(1))
    built = {
        jobs.REGION_DAILY: (marts.region_daily(region, day, after, as_of), marts.REGION_DAILY_RULES),
        jobs.PLANNING: (marts.planning_daily(region, fuel, fuels, as_of), marts.PLANNING_RULES),
    }
    return {
        mart.name: replace_rows(lake, mart, jobs.staged(rows, rules, f"platinum.{mart.name}_late"), scope)
        for mart, (rows, rules) in built.items()
    }


def _grid_marts(
    spark: SparkSession, lake: jobs.Lake, scored: list[date], scope: DataFrame, at: dict[str, int], days: int,
    as_of: jobs.Time,
) -> dict[str, versions.Version | None]:
    # the days scored, those their scores take in, and those that may hold the first ramp
    read = {day - timedelta(days=back) for day in scored for back in range(2 * days)}
    concerned = scope.select(F.col("respondent").alias("_respondent")).distinct()
    region, fuel = (
        _facts_of(spark, lake, name, read, at[name]).join(
            concerned, F.col("respondent") == F.col("_respondent"), "left_semi"
        )
        for name in (jobs.REGION_FACT, jobs.FUEL_FACT)
    )
    built = marts.grid_status_by_day(
        region,
        fuel,
        days,
        lambda rows: tables.materialized(rows, "late-measures"),
        as_of,
        lambda rows: _only(rows, scope, "period"),
    )
    status = jobs.staged(built, marts.GRID_STATUS_RULES, "platinum.grid_operations_hourly_late")
    alerts = jobs.staged(
        marts.grid_alerts(status, as_of), marts.GRID_ALERT_RULES, "platinum.grid_operations_alert_hourly_late"
    )
    return {
        mart.name: replace_rows(lake, mart, rows, scope)
        for mart, rows in ((jobs.GRID_STATUS, status), (jobs.GRID_ALERTS, alerts))
    }


def run_window(
    spark: SparkSession,
    lake: jobs.Lake,
    start: datetime,
    end: datetime,
    datasets: Collection[str] = (S.REGION, S.FUEL),
    as_of: jobs.Time = None,
) -> None:
    """All layers of one source window, and what its late rows change in older days."""
    with tables.stages(spark):
        jobs.run_window(spark, lake, start, end, as_of, datasets)
        if set(datasets) & {S.REGION, S.FUEL}:
            horizon = end - timedelta(days=S.GRID_LOOKBACK_DAYS - 1)
            propagate(spark, lake, horizon, as_of=as_of)
