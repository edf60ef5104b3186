"""The pipeline's jobs: read a window, build, store a stage, check it, publish it.

A stage is a table in the shared folder (or of a database). Checks read the stage,
so nothing is computed twice, and a table changes only after its stage has passed.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import schemas as S
from gridlake.operators import coverage, gold, marts, reconcile, silver
from gridlake.operators.quality import Rule, check, counting
from gridlake.operators.windowing import in_window, lookback
from gridlake.sources import notes, tables, versions
from gridlake.streaming import ingest

Time = datetime | str | None


@dataclass(frozen=True)
class Lake:
    """Where the tables are, all under one root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/events"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/bronze/quarantine"

    def hour_counts(self, dataset: str) -> str:
        return f"{self.root}/bronze/hour_counts/{dataset}"

    def progress(self, topic: str) -> str:
        return f"{self.root}/bronze/checkpoints/{topic}"

    def silver(self, spec: S.DatasetSpec) -> str:
        return f"{self.root}/silver/{spec.table}"

    def fact(self, name: str) -> str:
        return f"{self.root}/gold/facts/{name}"

    def dimension(self, name: str) -> str:
        return f"{self.root}/gold/dimensions/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/platinum/{name}"


REGION_FACT = "region_demand_forecast_hourly"
FUEL_FACT = "fuel_generation_hourly"
POWER_FACT = "electric_power_operations_monthly"


@dataclass(frozen=True)
class Mart:
    """A keyed serving table and the partition its rows fall in."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    time: str
    partition: str
    layout: str

    def placed(self) -> tuple[str, Column]:
        return self.partition, F.date_format(self.time, self.layout)


REGION_DAILY = Mart(
    "region_demand_daily", S.REGION_DAILY, ("date", "respondent"), "date", "month", "yyyy-MM"
)
GRID_STATUS = Mart(
    "grid_operations_hourly",
    S.GRID_STATUS,
    ("period", "respondent"),
    "period",
    "day",
    "yyyy-MM-dd",
)
GRID_ALERTS = Mart(
    "grid_operations_alert_hourly",
    S.GRID_ALERTS,
    ("period", "respondent", "alert_type"),
    "period",
    "day",
    "yyyy-MM-dd",
)
PLANNING = Mart(
    "resource_planning_daily",
    S.PLANNING_DAILY,
    ("date", "respondent"),
    "date",
    "month",
    "yyyy-MM",
)
POWER = Mart(
    "electric_power_operations_monthly",
    S.POWER_MONTHLY,
    ("period", "location", "sector_id", "fueltype_id"),
    "period",
    "year",
    "yyyy",
)
COVERAGE = Mart(
    "bronze_hourly_coverage",
    S.HOURLY_COVERAGE,
    ("dataset_id", "hour_start_utc"),
    "hour_start_utc",
    "month",
    "yyyy-MM",
)
MARTS = (REGION_DAILY, GRID_STATUS, GRID_ALERTS, PLANNING, POWER, COVERAGE)


def read_mart(spark: SparkSession, lake: Lake, mart: Mart) -> DataFrame:
    return tables.read_table(spark, lake.mart(mart.name), mart.schema)


def staged(df: DataFrame, rules: Sequence[Rule], label: str) -> DataFrame:
    """Store ``df`` and return it once its rules hold.

    Rules on rows are counted while the stage is written; only rules on keys read it.
    """
    watched, counts = counting(df, rules)
    stage = tables.write_stage(watched, label.replace(".", "-"))
    check(stage, rules, label, counts.known())
    return stage


def _publish(lake: Lake, mart: Mart, stage: DataFrame, afterwards: Sequence[Rule] = ()) -> None:
    tables.upsert_table(
        stage, lake.mart(mart.name), mart.schema, mart.key, by=mart.placed(), stored=True
    )
    if afterwards:
        check(read_mart(stage.sparkSession, lake, mart), afterwards, f"platinum.{mart.name}")


# --- ingest and silver --------------------------------------------------------


def ingest_topic(
    stream: DataFrame, lake: Lake, topic: str, replay_window: str | None = None
) -> None:
    """Take what the topic holds now into Bronze and the quarantine.

    Progress with a ``replay_window`` is kept apart, since it has ids as its state.
    """
    progress = lake.progress(f"{topic}-replays" if replay_window else topic)
    ingest.ingest_available_now(stream, lake.bronze, lake.quarantine, progress, replay_window)


def clean_dataset(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    start: Time = None,
    end: Time = None,
    validate_only: bool = False,
) -> DataFrame:
    """Bronze window to Silver; ``validate_only`` checks without publishing."""
    spec = S.SPECS[dataset]
    events = tables.read_bronze(spark, lake.bronze, dataset, start, end)
    # Bronze is opened once; rules, cleaning and retention read the typed rows
    typed = staged(silver.extract(events, spec), silver.extract_rules(spec), f"silver.{spec.table}")
    cleaned = staged(
        silver.newest_complete(typed, spec), silver.clean_rules(spec), f"silver.{spec.table}"
    )
    silver.check_retention(typed, cleaned, spec)
    if not validate_only:
        tables.merge_partitions(
            cleaned, lake.silver(spec), ["event_id"], ["loaded_at", "period"], stored=True
        )
    return cleaned


# --- gold ---------------------------------------------------------------------


def _silver(
    spark: SparkSession, lake: Lake, spec: S.DatasetSpec, start: Time, end: Time
) -> DataFrame:
    return tables.read_window(spark, lake.silver(spec), spec.schema, start, end)


def _fact(
    lake: Lake, name: str, built: DataFrame, rules: Sequence[Rule], key: Sequence[str]
) -> None:
    stage = staged(built, rules, f"gold.{name}")
    tables.merge_partitions(stage, lake.fact(name), key, ["loaded_at"], stored=True)


def curate_hourly(
    spark: SparkSession,
    lake: Lake,
    dataset: str = "all",
    start: Time = None,
    end: Time = None,
    as_of: Time = None,
) -> None:
    """Silver window to the hourly facts and both dimensions."""
    region = fuel = None
    if dataset in ("all", S.REGION):
        region = _silver(spark, lake, S.REGION_SPEC, start, end)
        key = ("period", "respondent")
        _fact(lake, REGION_FACT, gold.region_hourly(region), gold.REGION_RULES, key)
    if dataset in ("all", S.FUEL):
        fuel = _silver(spark, lake, S.FUEL_SPEC, start, end)
        key = S.FUEL_SPEC.business_key
        _fact(lake, FUEL_FACT, gold.fuel_hourly(fuel), gold.FUEL_RULES, key)
    respondents = lake.dimension("respondent")
    base = versions.version(spark, respondents)
    prior = versions.read(spark, respondents, S.DIM_RESPONDENT, base)
    stage = staged(
        gold.dim_respondent(region, fuel, prior, as_of),
        gold.DIM_RESPONDENT_RULES,
        "gold.dim_respondent",
    )
    tables.write_dimension(stage, respondents, base)
    if fuel is not None:
        fuels = lake.dimension("fuel_type")
        base = versions.version(spark, fuels)
        prior = versions.read(spark, fuels, S.DIM_FUEL, base)
        stage = staged(
            gold.dim_fuel_type(fuel, prior, as_of), gold.DIM_FUEL_RULES, "gold.dim_fuel_type"
        )
        tables.write_dimension(stage, fuels, base)


def curate_power(
    spark: SparkSession, lake: Lake, start: Time = None, end: Time = None
) -> None:
    """Silver window to the monthly power fact."""
    rows = _silver(spark, lake, S.POWER_SPEC, start, end)
    key = S.POWER_SPEC.business_key
    _fact(lake, POWER_FACT, gold.power_monthly(rows), gold.POWER_RULES, key)


# --- platinum -----------------------------------------------------------------


def build_region_daily(
    spark: SparkSession,
    lake: Lake,
    start: datetime | None = None,
    end: datetime | None = None,
    as_of: Time = None,
) -> None:
    """Daily demand of a window. Its start is floored to the day, so days are whole.

    Rows are stamped with the floored window, and that is also what is checked
    afterwards. Without a bound all facts on that side are taken and the stamp is null.
    """
    if start is not None:
        start = start.replace(hour=0, minute=0, second=0, microsecond=0)
    facts = tables.read_window(spark, lake.fact(REGION_FACT), S.GOLD_REGION, start, end)
    built = marts.region_daily(facts, start, end, as_of)
    stage = staged(built, marts.REGION_DAILY_RULES, "platinum.region_demand_daily_stage")
    _publish(lake, REGION_DAILY, stage, marts.region_daily_published_rules(start, end))


def _after_newest(facts: DataFrame) -> datetime | None:
    """The hour after the newest fact, as a window's end; None without facts."""
    after = F.max("period") + F.expr("INTERVAL 1 HOUR")
    text = facts.agg(F.date_format(after, "yyyy-MM-dd HH:mm:ss")).first()[0]
    return datetime.fromisoformat(text) if text else None


def build_grid_operations(
    spark: SparkSession,
    lake: Lake,
    end: datetime | None = None,
    days: int = S.GRID_LOOKBACK_DAYS,
    as_of: Time = None,
    drop_unmeasured: bool = False,
) -> None:
    """Grid status and alerts over the lookback before ``end``, or up to the newest fact."""
    if end is None:
        end = _after_newest(tables.read_table(spark, lake.fact(REGION_FACT), S.GOLD_REGION))
        if end is None:
            return
    start, end = lookback(end, days)
    region = tables.read_window(spark, lake.fact(REGION_FACT), S.GOLD_REGION, start, end)
    fuel = tables.read_window(spark, lake.fact(FUEL_FACT), S.GOLD_FUEL, start, end)
    built = marts.grid_status(
        region,
        fuel,
        as_of,
        drop_unmeasured,
        keep=lambda measures: tables.materialized(measures, "grid-measures"),
    )
    status = staged(built, marts.GRID_STATUS_RULES, "platinum.grid_operations_hourly_stage")
    alerts = staged(
        marts.grid_alerts(status, as_of),
        marts.GRID_ALERT_RULES,
        "platinum.grid_operations_alert_hourly_stage",
    )
    _publish(lake, GRID_STATUS, status, marts.grid_published_rules(end))
    _publish(lake, GRID_ALERTS, alerts)


def build_resource_planning(
    spark: SparkSession,
    lake: Lake,
    end: datetime | None = None,
    days: int = S.PLANNING_LOOKBACK_DAYS,
    as_of: Time = None,
) -> None:
    """Daily planning figures over the lookback before ``end``, or up to the newest fact."""
    if end is None:
        end = _after_newest(tables.read_table(spark, lake.fact(REGION_FACT), S.GOLD_REGION))
        if end is None:
            return
    start, end = lookback(end, days)
    region = tables.read_window(spark, lake.fact(REGION_FACT), S.GOLD_REGION, start, end)
    fuel = tables.read_window(spark, lake.fact(FUEL_FACT), S.GOLD_FUEL, start, end)
    fuels = tables.read_table(spark, lake.dimension("fuel_type"), S.DIM_FUEL)
    built = marts.planning_daily(region, fuel, fuels, as_of)
    stage = staged(built, marts.PLANNING_RULES, "platinum.resource_planning_daily_stage")
    _publish(lake, PLANNING, stage, marts.planning_published_rules(end))


def build_power_monthly(
    spark: SparkSession,
    lake: Lake,
    start: datetime | None = None,
    end: datetime | None = None,
    as_of: Time = None,
) -> None:
    """Monthly power figures of a window; without a bound, of all facts on that side."""
    facts = tables.read_window(spark, lake.fact(POWER_FACT), S.GOLD_POWER, start, end)
    built = marts.power_mart(facts, start, end, as_of)
    stage = staged(
        built, marts.POWER_MART_RULES, "platinum.electric_power_operations_monthly_stage"
    )
    _publish(lake, POWER, stage, marts.power_published_rules(start, end))


def hour_counts(
    spark: SparkSession, lake: Lake, dataset: str, recount: bool = False
) -> DataFrame:
    """Rows per hour of a dataset's Bronze, kept in a table of their own.

    Only days that got rows since the last call are listed and counted again, whole; the
    table has one row per hour. The first call, and every one with ``recount``, counts all of
    Bronze: for rows that were appended without a note or removed.
    """
    path = lake.hour_counts(dataset)
    base = versions.version(spark, path)
    found = notes.pending(spark, lake.bronze, dataset)
    month = F.date_format("hour_start_utc", "yyyy-MM")
    if recount or base.number == 0:
        events = tables.read_bronze(spark, lake.bronze, dataset)
        counted = coverage.partition_counts(events).withColumn("month", month)
        versions.commit(counted, path, "month", base, emptied=tuple(base.places))
    elif found:
        days = notes.days(spark, found, dataset)
        events = tables.read_bronze_days(spark, lake.bronze, days)
        counted = coverage.partition_counts(events)
        tables.upsert_table(
            counted, path, S.HOUR_COUNTS, ["hour_start_utc"], by=("month", month)
        )
    notes.settle(spark, found)
    return tables.read_table(spark, path, S.HOUR_COUNTS)


def verify_coverage(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    boundary: datetime,
    as_of: Time = None,
    recount: bool = False,
) -> None:
    """Hourly coverage of a dataset up to ``boundary``, from the stored counts per hour.

    Every hour is written again, since the usual count and the end of the spine are
    columns of each; that is 24 rows per day, whatever Bronze holds.
    """
    hour = boundary.replace(minute=0, second=0, microsecond=0)
    counts = hour_counts(spark, lake, dataset, recount)
    built = coverage.coverage_of(counts, dataset, hour, as_of)
    _publish(lake, COVERAGE, tables.materialized(built, "coverage"))


def choose_repairs(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    boundary: datetime,
    open_jobs: DataFrame,
    statuses: Sequence[str] = ("missing",),
    max_open: int = 0,
) -> DataFrame:
    """Windows to fetch again, from the stored coverage."""
    stored = read_mart(spark, lake, COVERAGE)
    return coverage.repair_windows(stored, open_jobs, dataset, boundary, statuses, max_open)


# --- reconciliation -----------------------------------------------------------


def compare_layers(
    spark: SparkSession, lake: Lake, dataset: str, raw: DataFrame, start: Time, end: Time
) -> DataFrame:
    """Summary per layer and mart of the keys derived from ``raw`` against those stored.

    ``raw`` holds freshly fetched rows of the dataset with the columns of Bronze.
    """
    spec = S.SPECS[dataset]
    fact, schema = {
        S.REGION: (REGION_FACT, S.GOLD_REGION),
        S.FUEL: (FUEL_FACT, S.GOLD_FUEL),
        S.POWER: (POWER_FACT, S.GOLD_POWER),
    }[dataset]
    stored = {
        "bronze": reconcile.bronze_keys(
            tables.read_bronze(spark, lake.bronze, dataset, start, end), spec
        ),
        "silver": reconcile.silver_keys(_silver(spark, lake, spec, start, end), spec),
        "gold": reconcile.gold_keys(
            tables.read_window(spark, lake.fact(fact), schema, start, end), spec
        ),
    }
    pairs = [
        (layer, dataset, reconcile.expected_keys(raw, spec, layer), actual)
        for layer, actual in stored.items()
    ]
    served = {S.REGION: (REGION_DAILY, GRID_STATUS, PLANNING), S.POWER: (POWER,)}
    for mart in served.get(dataset, ()):
        name = f"platinum.{mart.name}"
        actual = reconcile.mart_keys(read_mart(spark, lake, mart), name)
        pairs.append(("platinum", name, reconcile.expected_keys(raw, spec, name), actual))
    return reconcile.snapshot(
        [
            (stage, name, reconcile.trim(expected, start, end), reconcile.trim(actual, start, end))
            for stage, name, expected, actual in pairs
        ]
    )


def _of_days(days: Collection[date] | None) -> Callable[[str], bool] | None:
    """Which day folders to open; None for all."""
    if days is None:
        return None
    return {f"{tables.DAY}={day.isoformat()}" for day in days}.__contains__


def stored_keys(spark: SparkSession, path: str) -> reconcile.KeyReader:
    """Reads a stored table of keys by days."""
    at = versions.version(spark, path)
    return lambda days: versions.read(spark, path, S.GRAIN_KEYS, at, _of_days(days))


def differences(
    spark: SparkSession, lake: Lake, dataset: str, raw: DataFrame, layer: str, start: Time, end: Time
) -> DataFrame:
    """Keys that ``raw`` has and Silver or Gold (``layer``) lacks, or the other way round.

    Layers are compared by hourly digests, and only days that differ are opened. Both sides
    are read at one version, whatever is written meanwhile.
    """
    spec = S.SPECS[dataset]
    name, schema = {
        S.REGION: (REGION_FACT, S.GOLD_REGION),
        S.FUEL: (FUEL_FACT, S.GOLD_FUEL),
        S.POWER: (POWER_FACT, S.GOLD_POWER),
    }[dataset]
    path = lake.silver(spec) if layer == "silver" else lake.fact(name)
    shape = spec.schema if layer == "silver" else schema
    keys_in = reconcile.silver_keys if layer == "silver" else reconcile.gold_keys
    at = versions.version(spark, path)
    wanted = tables.materialized(
        reconcile.trim(reconcile.expected_keys(raw, spec, layer), start, end), "expected-keys"
    )

    def expected(days: Collection[date] | None) -> DataFrame:
        return wanted if days is None else wanted.filter(F.to_date("period_start_utc").isin(list(days)))

    def actual(days: Collection[date] | None) -> DataFrame:
        rows = versions.read(spark, path, shape, at, _of_days(days))
        day = tables.DAY if tables.DAY in shape.names else None
        return reconcile.trim(keys_in(in_window(rows, "period", start, end, day), spec), start, end)

    return reconcile.reconcile_by_digests(expected, actual)


def run_window(
    spark: SparkSession,
    lake: Lake,
    start: datetime,
    end: datetime,
    as_of: Time = None,
    datasets: Collection[str] = (S.REGION, S.FUEL),
) -> None:
    """All layers of one source window after ingestion, by default of the hourly datasets.

    Stages are deleted at the end, also after a failure; the tables hold what was published.
    """
    hourly = [dataset for dataset in (S.REGION, S.FUEL) if dataset in datasets]
    with tables.stages(spark):
        for dataset in hourly:
            clean_dataset(spark, lake, dataset, start, end)
        if hourly:
            curate_hourly(spark, lake, hourly[0] if len(hourly) == 1 else "all", start, end, as_of)
            build_region_daily(spark, lake, start, end, as_of)
            build_grid_operations(spark, lake, end, as_of=as_of, drop_unmeasured=True)
            build_resource_planning(spark, lake, end, as_of=as_of)
        for dataset in hourly:
            verify_coverage(spark, lake, dataset, end + timedelta(hours=1), as_of)
        if S.POWER in datasets:
            clean_dataset(spark, lake, S.POWER, start, end)
            curate_power(spark, lake, start, end)
            build_power_monthly(spark, lake, start, end, as_of)
