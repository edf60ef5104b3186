"""Table schemas, dataset specifications and the fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def table(columns: str) -> T.StructType:
    """A schema from ``name type, ...``; unlike DDL parsing it needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- fixed values -----------------------------------------------------------
# Codes, factors, thresholds, labels and message texts that results must carry.

REGION = "electricity_region_data"
FUEL = "electricity_fuel_type_data"
POWER = "electricity_power_operational_data"

ENVELOPE_SOURCE = "eia_api_v2"

RENEWABLE_FUELS = ("SUN", "WND", "WAT", "GEO")
FOSSIL_FUELS = ("COL", "NG", "OIL", "OTH")
NUCLEAR_FUELS = ("NUC",)
GAS = "NG"

EMISSIONS_KG_PER_MWH = {
    "COL": 1000.0,
    "NG": 490.0,
    "OIL": 780.0,
    "OTH": 650.0,
    "NUC": 12.0,
    "SUN": 35.0,
    "WND": 12.0,
    "WAT": 24.0,
    "GEO": 45.0,
}

DEMAND = "D"
FORECAST = "DF"

ENERGY_UNITS = ("mwh", "megawatthours")
ASH_UNITS = ("percent",)
CONSUMPTION_UNITS = (
    "thousand physical units",
    "thousand short tons",
    "thousand mcf",
    "thousand barrels",
)
GENERATION_UNITS = ("thousand megawatthours",)
HEAT_UNITS = (
    "btu per physical units",
    "btu per short tons",
    "btu per mcf",
    "btu per barrels",
)

MIN_RETENTION = 0.8

Z_ALERT = 2.5
Z_HIGH = 3.5
COVERAGE_ALERT = 0.9
COVERAGE_HIGH = 0.8

PRIORITIES = ("Critical", "Elevated", "Stable")

GRID_LOOKBACK_DAYS = 14
PLANNING_LOOKBACK_DAYS = 35

# --- message and bronze -----------------------------------------------------

STRING_MAP = T.MapType(T.StringType(), T.StringType(), True)

ENVELOPE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("event_id", "dataset", "source")]
    + [T.StructField(n, T.StringType()) for n in ("event_timestamp", "ingestion_timestamp")]
    + [T.StructField(n, STRING_MAP) for n in ("metadata", "payload")]
)

MESSAGE = table(
    "value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

BRONZE_PARTITIONS = (
    "dataset_partition",
    "event_year",
    "event_month",
    "event_day",
    "event_hour",
)

BRONZE = T.StructType(
    ENVELOPE.fields
    + table(
        "raw_json string, kafka_topic string, kafka_partition int, kafka_offset bigint,"
        " kafka_timestamp timestamp, event_ts timestamp, ingestion_ts timestamp,"
        " bronze_loaded_at timestamp, event_date date, dataset_partition string,"
        " event_year int, event_month int, event_day int, event_hour int"
    ).fields
)


# --- datasets ---------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One payload entry: target column, payload key, and text / unit / number."""

    column: str
    key: str
    kind: str = "text"
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class DatasetSpec:
    """What the generic cleaning, keying and merging operators need to know."""

    dataset: str
    table: str
    route: str
    frequency: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    # payload columns that two copies of one event must agree on
    versioned: tuple[str, ...]
    entity: str
    dimension: tuple[str, ...]
    business_key: tuple[str, ...]
    # columns a raw row needs to be expected downstream
    expected: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        kinds = {"number": T.DoubleType()}
        return T.StructType(
            [T.StructField("event_id", T.StringType()), T.StructField("period", T.TimestampType())]
            + [T.StructField(f.column, kinds.get(f.kind, T.StringType())) for f in self.fields]
            + [
                T.StructField("loaded_at", T.TimestampType()),
                T.StructField("event_date", T.DateType()),
            ]
        )


REGION_SPEC = DatasetSpec(
    dataset=REGION,
    table="region_data",
    route="electricity/rto/region-data",
    frequency="hourly",
    fields=(
        Field("respondent", "respondent"),
        Field("respondent_name", "respondent-name"),
        Field("type", "type", allowed=(DEMAND, FORECAST)),
        Field("type_name", "type-name"),
        Field("value", "value", "number"),
        Field("value_units", "value-units", "unit", ENERGY_UNITS),
    ),
    required=("period", "respondent", "value", "respondent_name", "type", "value_units"),
    versioned=(
        "period",
        "respondent",
        "respondent_name",
        "type",
        "type_name",
        "value",
        "value_units",
    ),
    entity="respondent",
    dimension=("type",),
    business_key=("period", "respondent", "type"),
    expected=("period", "respondent", "value"),
)

FUEL_SPEC = DatasetSpec(
    dataset=FUEL,
    table="fuel_type_data",
    route="electricity/rto/fuel-type-data",
    frequency="hourly",
    fields=(
        Field("respondent", "respondent"),
        Field("respondent_name", "respondent-name"),
        Field("fueltype", "fueltype"),
        Field("fueltype_name", "type-name"),
        Field("value", "value", "number"),
        Field("value_units", "value-units", "unit", ENERGY_UNITS),
    ),
    required=("period", "respondent", "value", "respondent_name", "fueltype", "value_units"),
    versioned=(
        "period",
        "respondent",
        "respondent_name",
        "fueltype",
        "fueltype_name",
        "value",
        "value_units",
    ),
    entity="respondent",
    dimension=("fueltype",),
    business_key=("period", "respondent", "fueltype"),
    expected=("period", "respondent", "fueltype", "value"),
)

POWER_SPEC = DatasetSpec(
    dataset=POWER,
    table="electric_power_operational_data",
    route="electricity/electric-power-operational-data",
    frequency="monthly",
    fields=(
        Field("location", "location"),
        Field("location_name", "stateDescription"),
        Field("sector_id", "sectorid"),
        Field("sector_name", "sectorDescription"),
        Field("fueltype_id", "fueltypeid"),
        Field("fueltype_name", "fuelTypeDescription"),
        Field("ash_content_pct", "ash-content", "number"),
        Field("ash_content_units", "ash-content-units", "unit", ASH_UNITS),
        Field("consumption_for_eg_thousand_units", "consumption-for-eg", "number"),
        Field("consumption_for_eg_units", "consumption-for-eg-units", "unit", CONSUMPTION_UNITS),
        Field("generation_thousand_mwh", "generation", "number"),
        Field("generation_units", "generation-units", "unit", GENERATION_UNITS),
        Field("heat_content_btu_per_unit", "heat-content", "number"),
        Field("heat_content_units", "heat-content-units", "unit", HEAT_UNITS),
    ),
    required=(
        "period",
        "location",
        "sector_id",
        "fueltype_id",
        "location_name",
        "sector_name",
        "fueltype_name",
    ),
    versioned=(
        "period",
        "location",
        "location_name",
        "sector_id",
        "sector_name",
        "fueltype_id",
        "fueltype_name",
        "ash_content_pct",
        "consumption_for_eg_thousand_units",
        "generation_thousand_mwh",
        "heat_content_btu_per_unit",
    ),
    entity="location",
    dimension=("sector_id", "fueltype_id"),
    business_key=("period", "location", "sector_id", "fueltype_id"),
    expected=(
        "period",
        "location",
        "sector_id",
        "fueltype_id",
        "location_name",
        "sector_name",
        "fueltype_name",
    ),
)

SPECS = {spec.dataset: spec for spec in (REGION_SPEC, FUEL_SPEC, POWER_SPEC)}

# --- gold -------------------------------------------------------------------

GOLD_REGION = table(
    "period timestamp, event_date date, respondent string, respondent_name string,"
    " value_units string, actual_demand_mwh double, day_ahead_forecast_mwh double,"
    " forecast_error_mwh double, forecast_error_pct double, loaded_at timestamp"
)
GOLD_FUEL = table(
    "period timestamp, event_date date, respondent string, respondent_name string,"
    " fueltype string, fueltype_name string, value_units string, generation_mwh double,"
    " loaded_at timestamp"
)
GOLD_POWER = table(
    "period timestamp, event_date date, location string, location_name string,"
    " sector_id string, sector_name string, fueltype_id string, fueltype_name string,"
    " ash_content_pct double, consumption_for_eg_thousand_units double,"
    " generation_mwh double, heat_content_btu_per_unit double, loaded_at timestamp"
)
DIM_RESPONDENT = table(
    "respondent string, respondent_name string, first_seen_date date,"
    " last_seen_date date, source_dataset_count bigint, updated_at timestamp"
)
DIM_FUEL = table(
    "fueltype string, fueltype_name string, fuel_category string,"
    " emissions_factor_kg_per_mwh double, updated_at timestamp"
)

# --- platinum ---------------------------------------------------------------

REGION_DAILY = table(
    "date date, respondent string, daily_demand_mwh double, avg_hourly_demand_mwh double,"
    " peak_hourly_demand_mwh double, loaded_at timestamp, source_window_start timestamp,"
    " source_window_end timestamp, updated_at timestamp"
)
GRID_STATUS = table(
    "period timestamp, respondent string, respondent_name string, actual_demand_mwh double,"
    " day_ahead_forecast_mwh double, forecast_error_mwh double, forecast_error_pct double,"
    " forecast_error_zscore double, demand_ramp_mwh double, demand_ramp_zscore double,"
    " demand_zscore double, total_generation_mwh double, renewable_generation_mwh double,"
    " fossil_generation_mwh double, gas_generation_mwh double, renewable_share_pct double,"
    " fossil_share_pct double, gas_share_pct double, generation_gap_mwh double,"
    " coverage_ratio double, alert_count int, updated_at timestamp"
)
GRID_ALERTS = table(
    "period timestamp, respondent string, respondent_name string, alert_type string,"
    " severity string, metric_value double, threshold_value double, message string,"
    " updated_at timestamp"
)
PLANNING_DAILY = table(
    "date date, respondent string, respondent_name string, daily_demand_mwh double,"
    " peak_hourly_demand_mwh double, avg_abs_forecast_error_pct double,"
    " renewable_share_pct double, fossil_share_pct double, gas_share_pct double,"
    " carbon_intensity_kg_per_mwh double, fuel_diversity_index double,"
    " peak_hour_gas_share_pct double, clean_coverage_ratio double, weekend_flag boolean,"
    " updated_at timestamp"
)
POWER_MONTHLY = table(
    "period timestamp, location string, location_name string, sector_id string,"
    " sector_name string, fueltype_id string, fueltype_name string, generation_mwh double,"
    " generation_share_pct double, consumption_for_eg_thousand_units double,"
    " ash_content_pct double, heat_content_btu_per_unit double,"
    " fuel_heat_input_mmbtu double, heat_rate_btu_per_kwh double, loaded_at timestamp,"
    " source_window_start timestamp, source_window_end timestamp, updated_at timestamp"
)
HOURLY_COVERAGE = table(
    "dataset_id string, hour_start_utc timestamp, observed_row_count bigint,"
    " expected_row_count int, row_count_delta bigint, status string,"
    " oldest_hour_utc timestamp, newest_hour_utc timestamp,"
    " verification_boundary_hour_utc timestamp, verified_at timestamp"
)
HOUR_COUNTS = table("hour_start_utc timestamp, observed_row_count bigint")
GRAIN_KEYS = table(
    "grain_key string, period_start_utc timestamp, respondent string, dimension_value string"
)
