"""Grid feeds derived from general-purpose tables (``events``, ``lineitem``, ``orders``).

No electricity data ships with this repository, so every row of ``events`` becomes a
region row and a fuel row, every row of ``lineitem`` a monthly power row, and every
row of ``orders`` a workflow run. The mapping is deterministic. It also plants what
the pipeline has to cope with: replays, late revisions, padded and missing text, bad
numbers, bad periods, unknown fuels and negative readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.frames import evaluated_once
from gridlake.operators.envelope import build_envelopes, envelope, envelope_json
from gridlake.schemas import FUEL, FUEL_SPEC, POWER, REGION, REGION_SPEC, DatasetSpec

RESPONDENTS = ("PJM", "MISO", "ERCO", "CISO", "NYIS", "XBA")
FUEL_OF_EVENT = {"click": "NG", "view": "SUN", "purchase": "WND", "signup": "COL", "error": "NUC"}
FUEL_NAMES = {
    "NG": "Natural Gas",
    "SUN": "Solar",
    "WND": "Wind",
    "COL": "Coal",
    "NUC": "Nuclear",
    "XX": "Unclassified",
}
POWER_FUELS = ("COL", "NG", "PET", "NUC", "WND")
LOCATIONS = {"US": "U.S. Total", "TX": "Texas", "CA": "California"}
WORKFLOWS = (
    "electricity_region_data_incremental",
    "electricity_fuel_type_data_incremental",
    "electricity_region_data_backfill",
    "electricity_region_data_bronze_hourly_verification",
    "electricity_region_data_bronze_hourly_repair",
    "platinum_grid_operations_hourly",
    "platinum_resource_planning_daily",
    "maintenance_cleanup",
)
RENAMED_FROM = "2024-01-16"
REPLAY_DELAY = "INTERVAL 5 MINUTES"
RUN_ID = "fetch_derived"
WINDOW = ("2024-01-01T00", "2024-01-31T00")


def load(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}.parquet")


def _every(n: int, column: str = "event_id") -> Column:
    return F.col(column) % n == 0


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _lookup(names: dict[str, str], code: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[code]


def _money(value: Column) -> Column:
    """Two decimals as text, the same in every SQL dialect."""
    return value.cast("decimal(18,2)").cast("string")


def events(spark: SparkSession, root: str) -> DataFrame:
    """Every event, and a replayed second copy of some of them."""
    copies = F.sequence(F.lit(0), F.when(_every(13), 1).otherwise(0))
    return (
        load(spark, root, "events")
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withColumn("copy", F.explode(copies))
        .withColumn(
            "ingestion_ts",
            F.when(F.col("copy") == 1, F.col("ts") + F.expr(REPLAY_DELAY)).otherwise(F.col("ts")),
        )
    )


def _period() -> Column:
    return F.when(_every(41), "not-a-date").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH"))


def _respondent() -> Column:
    return _pick(RESPONDENTS, F.col("user_id"))


def _respondent_name() -> Column:
    name = F.concat(F.lit("Balancing area "), _respondent())
    renamed = F.when(F.to_date("ts") >= F.lit(RENAMED_FROM), F.concat(name, F.lit(" (new)")))
    return F.when(~_every(29), F.coalesce(renamed, name))


def _map(entries: dict[str, Column]) -> Column:
    return F.create_map(*[x for key, value in entries.items() for x in (F.lit(key), value)])


def region_row(faulty: bool = False) -> Column:
    """The payload of a region row; ``faulty`` also plants units that must be refused."""
    demand = _every(2)
    unit = F.when(_every(3), " MegaWattHours").otherwise("MWh")
    if faulty:
        unit = F.when(_every(71), "GW").otherwise(unit)
    return _map(
        {
            "period": _period(),
            "respondent": F.when(
                _every(11), F.concat(F.lit("  "), _respondent(), F.lit(" "))
            ).otherwise(_respondent()),
            "respondent-name": _respondent_name(),
            "type": F.when(demand, "D").otherwise("DF"),
            "type-name": F.when(demand, "Demand").otherwise("Day-ahead demand forecast"),
            "value": F.when(_every(37), "n/a").otherwise(_money(F.col("value"))),
            "value-units": unit,
        }
    )


def fuel_code() -> Column:
    return F.when(_every(53), "XX").otherwise(_lookup(FUEL_OF_EVENT, F.col("event_type")))


def fuel_row() -> Column:
    """The payload of a fuel row."""
    reading = F.when(_every(31), -F.col("value")).otherwise(F.col("value"))
    return _map(
        {
            "period": _period(),
            "respondent": _respondent(),
            "respondent-name": _respondent_name(),
            "fueltype": fuel_code(),
            "type-name": F.when(~_every(19), _lookup(FUEL_NAMES, fuel_code())),
            "value": F.when(_every(37), "n/a").otherwise(_money(reading)),
            "value-units": F.lit("megawatthours"),
        }
    )


def power_row() -> Column:
    """The payload of a monthly power row."""
    flagged = F.concat("l_returnflag", "l_linestatus")
    location = _pick(tuple(LOCATIONS), F.col("l_suppkey"))
    fuel = _pick(POWER_FUELS, F.col("l_partkey"))
    generation = F.when(_every(101, "l_orderkey"), -F.col("l_quantity")).otherwise(
        F.col("l_quantity")
    )
    return _map(
        {
            "period": F.date_format("l_shipdate", "yyyy-MM"),
            "location": location,
            "stateDescription": _lookup(LOCATIONS, location),
            "sectorid": flagged,
            "sectorDescription": F.when(
                ~_every(47, "l_orderkey"), F.concat(F.lit("Sector "), flagged)
            ),
            "fueltypeid": fuel,
            "fuelTypeDescription": F.concat(F.lit(" Fuel "), fuel, F.lit(" ")),
            "ash-content": _money(F.col("l_tax") * 100),
            "ash-content-units": F.lit("percent"),
            "consumption-for-eg": F.when(_every(59, "l_orderkey"), "n/a").otherwise(
                _money(F.col("l_extendedprice"))
            ),
            "consumption-for-eg-units": F.lit("Thousand Short Tons"),
            "generation": _money(generation),
            "generation-units": F.lit("thousand megawatthours"),
            "heat-content": _money(F.col("l_discount") * 100),
            "heat-content-units": F.lit(" BTU per short tons"),
        }
    )


def power_id() -> Column:
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return F.concat_ws("-", *keys, _money(F.col("l_extendedprice")))


def power_loaded() -> Column:
    return F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=F.col("l_linenumber"))


def _placed(rows: DataFrame) -> DataFrame:
    """Events with a place in the topic and the hour they are about."""
    return rows.withColumns(
        {
            "event_ts": F.date_trunc("hour", "ts"),
            "kafka_partition": (F.col("user_id") % 4).cast("int"),
            "kafka_offset": F.col("event_id") * 2 + F.col("copy"),
        }
    )


def source_id() -> Column:
    """The number of the event a message is about. Ids hash rows, which two events may share."""
    return F.shiftright("kafka_offset", 1).cast("string")


def _batch(rows: DataFrame, dataset: str, event_id: Column, row: Column, loaded: Column):
    """The columns of Bronze that cleaning reads. The payload is built once per row."""
    return evaluated_once(
        rows,
        event_id.alias("event_id"),
        F.lit(dataset).alias("dataset"),
        row.alias("payload"),
        loaded.alias("ingestion_ts"),
    )


def bronze_region(spark: SparkSession, root: str, faulty: bool = False) -> DataFrame:
    """Region events with the Bronze columns that cleaning reads."""
    rows = events(spark, root)
    event_id = F.col("event_id").cast("string")
    return _batch(rows, REGION, event_id, region_row(faulty), F.col("ingestion_ts"))


def bronze_fuel(spark: SparkSession, root: str) -> DataFrame:
    rows = events(spark, root)
    event_id = F.col("event_id").cast("string")
    return _batch(rows, FUEL, event_id, fuel_row(), F.col("ingestion_ts"))


def bronze_power(spark: SparkSession, root: str) -> DataFrame:
    return _batch(load(spark, root, "lineitem"), POWER, power_id(), power_row(), power_loaded())


def event_hours(spark: SparkSession, root: str) -> DataFrame:
    """The hour every event is about, all that coverage reads of Bronze."""
    return _placed(events(spark, root)).select("event_ts")


def _hourly_rows(
    spark: SparkSession, root: str, spec: DatasetSpec, dealt: bool = False
) -> DataFrame:
    row = {REGION: region_row, FUEL: fuel_row}[spec.dataset]()
    rows = events(spark, root)
    if dealt:
        # the number is given: by their bytes, adaptive execution would merge the parts again
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(parts, "event_id")
    placed = _placed(rows)
    return evaluated_once(placed, row.alias("row"), keep=tuple(placed.columns))


def envelopes(spark: SparkSession, root: str, spec: DatasetSpec = REGION_SPEC) -> DataFrame:
    """Envelopes of an hourly feed, including those whose period does not parse."""
    rows = _hourly_rows(spark, root, spec)
    return build_envelopes(rows, spec, RUN_ID, *WINDOW, ingested_at=F.col("ingestion_ts"))


def messages(
    spark: SparkSession, root: str, spec: DatasetSpec = REGION_SPEC, dealt: bool = False
) -> DataFrame:
    """Topic messages of an hourly feed; some of them are not JSON.

    With ``dealt`` events are dealt by number first, into ``spark.sql.shuffle.partitions``
    parts. They take a few bytes each in a file, and building and opening their messages many
    times longer than reading them, so that a part of the file is a long task.
    """
    built = envelope(spec, F.col("row"), RUN_ID, *WINDOW, ingested_at=F.col("ingestion_ts"))
    text = F.when(_every(43), "{broken").otherwise(envelope_json(built))
    return evaluated_once(
        _hourly_rows(spark, root, spec, dealt),
        text.cast("binary").alias("value"),
        F.lit(f"feed_{spec.table}").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingestion_ts").alias("timestamp"),
    )


def workflow_runs(spark: SparkSession, root: str) -> DataFrame:
    """Every order as a workflow run."""
    started = F.col("o_orderdate").cast("timestamp")
    state = {"F": "failed", "O": "success", "P": "running"}
    return load(spark, root, "orders").select(
        _pick(WORKFLOWS, F.col("o_custkey")).alias("dag_id"),
        F.col("o_orderpriority").alias("task_id"),
        F.concat(F.lit("run-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias(
            "run_id"
        ),
        _lookup(state, F.col("o_orderstatus")).alias("state"),
        started.alias("execution_date"),
        (started + F.expr("INTERVAL 1 MINUTE")).alias("queued_at"),
        F.when(~_every(17, "o_orderkey"), started + F.expr("INTERVAL 2 MINUTES")).alias(
            "start_date"
        ),
        F.when(
            F.col("o_orderstatus") != "P", started + F.make_dt_interval(
                hours=(F.col("o_orderkey") % 5).cast("int")
            )
        ).alias("end_date"),
    )


def workflows(spark: SparkSession, root: str) -> DataFrame:
    """The workflows that appear in the runs; backfills are paused."""
    named = workflow_runs(spark, root).select("dag_id").distinct()
    return named.withColumn("is_paused", F.col("dag_id").like("%backfill"))


def backfill_jobs(spark: SparkSession, root: str) -> DataFrame:
    """Every order as a backfill job for the day of the order."""
    day = F.col("o_orderdate").cast("timestamp")
    status = {"F": "failed", "O": "completed", "P": "pending"}
    return load(spark, root, "orders").select(
        _pick((REGION, FUEL, POWER), F.col("o_custkey")).alias("dataset_id"),
        _lookup(status, F.col("o_orderstatus")).alias("status"),
        day.alias("chunk_start_utc"),
        (day + F.expr("INTERVAL 1 DAY")).alias("chunk_end_utc"),
        (day + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))).alias(
            "updated_at"
        ),
    )
