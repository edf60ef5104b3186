"""Gold facts and dimensions: the newest revision per business key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import at_least_zero, now_or
from gridlake.operators.quality import NonNegative, NotNull, Rule, Unique
from gridlake.operators.rank import latest_by_key
from gridlake.schemas import (
    DEMAND,
    DIM_FUEL,
    DIM_RESPONDENT,
    EMISSIONS_KG_PER_MWH,
    FORECAST,
    FOSSIL_FUELS,
    FUEL,
    FUEL_SPEC,
    GOLD_FUEL,
    GOLD_POWER,
    GOLD_REGION,
    NUCLEAR_FUELS,
    POWER_SPEC,
    REGION,
    RENEWABLE_FUELS,
)

NEWEST = ("loaded_at", "event_id")


def _newest_of(kind: str) -> Column:
    """The newest revision of one row type, as a struct led by its version."""
    version = F.struct(*NEWEST, "value", "respondent_name")
    return F.max(F.when(F.col("type") == kind, version))


def region_hourly(silver: DataFrame) -> DataFrame:
    """Demand and forecast of an hour side by side, with the forecast's error.

    One grouped aggregate picks the newest revision of each type and pivots the two
    types; hours with only one of them stay, the other side null.
    """
    wide = (
        silver.filter(F.col("type").isin(DEMAND, FORECAST))
        .groupBy("period", "respondent")
        .agg(
            F.max("event_date").alias("event_date"),
            _newest_of(DEMAND).alias("actual"),
            _newest_of(FORECAST).alias("forecast"),
        )
    )
    return with_forecast_error(
        wide.select(
            "period",
            "event_date",
            "respondent",
            F.coalesce("actual.respondent_name", "forecast.respondent_name", "respondent").alias(
                "respondent_name"
            ),
            F.col("actual.value").alias("actual_demand_mwh"),
            F.col("forecast.value").alias("day_ahead_forecast_mwh"),
            F.greatest("actual.loaded_at", "forecast.loaded_at").alias("loaded_at"),
        )
    )


def region_hourly_joined(silver: DataFrame) -> DataFrame:
    """``region_hourly`` for demand and forecast kept in separate tables: a full outer join."""

    def side(kind: str, prefix: str) -> DataFrame:
        rows = silver.filter(F.col("type") == kind)
        return latest_by_key(rows, ["period", "respondent"], NEWEST).select(
            "period",
            "respondent",
            *[
                F.col(c).alias(f"{prefix}_{c}")
                for c in ("event_date", "respondent_name", "value", "loaded_at")
            ],
        )

    both = side(DEMAND, "d").join(side(FORECAST, "f"), ["period", "respondent"], "full_outer")
    return with_forecast_error(
        both.select(
            "period",
            F.coalesce("d_event_date", "f_event_date").alias("event_date"),
            "respondent",
            F.coalesce("d_respondent_name", "f_respondent_name", "respondent").alias(
                "respondent_name"
            ),
            F.col("d_value").alias("actual_demand_mwh"),
            F.col("f_value").alias("day_ahead_forecast_mwh"),
            F.greatest("d_loaded_at", "f_loaded_at").alias("loaded_at"),
        )
    )


def with_forecast_error(sides: DataFrame) -> DataFrame:
    actual, forecast = F.col("actual_demand_mwh"), F.col("day_ahead_forecast_mwh")
    error = actual - forecast
    return sides.withColumns(
        {
            "value_units": F.lit("MWh"),
            "forecast_error_mwh": error,
            "forecast_error_pct": F.when(forecast != 0, error / forecast * 100.0),
        }
    ).select(*GOLD_REGION.names)


def fuel_hourly(silver: DataFrame) -> DataFrame:
    """Newest generation per hour, respondent and fuel; negative readings count as 0."""
    newest = latest_by_key(silver, FUEL_SPEC.business_key, NEWEST)
    return newest.withColumns(
        {
            "value_units": F.lit("MWh"),
            "generation_mwh": F.greatest(F.col("value"), F.lit(0.0)),
        }
    ).select(*GOLD_FUEL.names)


def power_monthly(silver: DataFrame) -> DataFrame:
    """Newest monthly operations row per key, in MWh, negative measures as 0."""
    newest = latest_by_key(silver, POWER_SPEC.business_key, NEWEST)
    measures = ("consumption_for_eg_thousand_units", "ash_content_pct", "heat_content_btu_per_unit")
    return newest.withColumns(
        {
            "generation_mwh": at_least_zero(F.col("generation_thousand_mwh")) * 1000.0,
            **{m: at_least_zero(F.col(m)) for m in measures},
        }
    ).select(*GOLD_POWER.names)


def _latest_name(column: str) -> Column:
    """The name on the latest date, the last in text order within that date."""
    seen = F.struct("event_date", F.col(column).alias("name"))
    return F.max(F.when(F.col(column).isNotNull(), seen))["name"]


def dim_respondent(
    region: DataFrame | None,
    fuel: DataFrame | None,
    prior: DataFrame | None = None,
    as_of: datetime | str | Column | None = None,
) -> DataFrame:
    """Respondents with their latest name, first and last day and number of sources.

    ``region`` and ``fuel`` are Silver tables, ``prior`` the dimension as it stands.
    Its dates take part like observations and its source count never shrinks. All
    of it is one grouped aggregate, combined before the shuffle.
    """

    def observed(df: DataFrame, day: str, source: str | None, count: Column) -> DataFrame:
        return df.select(
            "respondent",
            "respondent_name",
            F.col(day).alias("event_date"),
            F.lit(source).cast("string").alias("source"),
            count.cast("bigint").alias("prior_count"),
        )

    parts = []
    if region is not None:
        parts.append(observed(region, "event_date", REGION, F.lit(None)))
    if fuel is not None:
        parts.append(observed(fuel, "event_date", FUEL, F.lit(None)))
    if prior is not None:
        # both dates of a row from one pass over the dimension
        dates = F.explode(F.array("first_seen_date", "last_seen_date")).alias("seen")
        seen = prior.select("respondent", "respondent_name", "source_dataset_count", dates)
        parts.append(observed(seen, "seen", None, F.col("source_dataset_count")))
    if not parts:
        raise ValueError("dim_respondent needs a region or a fuel source")
    observations = parts[0]
    for part in parts[1:]:
        observations = observations.unionByName(part)
    per_respondent = (
        observations.filter(F.col("respondent").isNotNull())
        .groupBy("respondent")
        .agg(
            _latest_name("respondent_name").alias("respondent_name"),
            F.min("event_date").alias("first_seen_date"),
            F.max("event_date").alias("last_seen_date"),
            *[
                F.max(F.when(F.col("source") == s, 1).otherwise(0)).alias(s)
                for s in (REGION, FUEL)
            ],
            F.coalesce(F.max("prior_count"), F.lit(0)).alias("prior_count"),
        )
    )
    sources = (F.col(REGION) + F.col(FUEL)).cast("bigint")
    return (
        per_respondent.filter(F.col("first_seen_date").isNotNull())
        .withColumns(
            {
                "source_dataset_count": F.greatest(sources, F.col("prior_count")),
                "updated_at": now_or(as_of),
            }
        )
        .select(*DIM_RESPONDENT.names)
    )


def dim_fuel_type(
    fuel: DataFrame | None,
    prior: DataFrame | None = None,
    as_of: datetime | str | Column | None = None,
    prior_wins: bool = True,
) -> DataFrame:
    """Fuels with their latest name, category and emissions factor (0.0 if unknown).

    With ``prior_wins`` a name in the prior dimension counts as seen on the day of
    ``as_of``, so it outranks names observed on earlier days; otherwise it counts
    as older than any observation.
    """
    parts = []
    if fuel is not None:
        parts.append(fuel.select("fueltype", "fueltype_name", "event_date"))
    if prior is not None:
        day = F.to_date(now_or(as_of)) if prior_wins else F.lit(None).cast("date")
        parts.append(prior.select("fueltype", "fueltype_name", day.alias("event_date")))
    if not parts:
        raise ValueError("dim_fuel_type needs a fuel source")
    observations = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    code = F.col("fueltype")
    factors = F.create_map(
        *[F.lit(x) for entry in EMISSIONS_KG_PER_MWH.items() for x in entry]
    )
    return (
        observations.filter(code.isNotNull())
        .groupBy("fueltype")
        .agg(_latest_name("fueltype_name").alias("fueltype_name"))
        .withColumns(
            {
                "fuel_category": F.when(code.isin(*RENEWABLE_FUELS), "renewable")
                .when(code.isin(*FOSSIL_FUELS), "fossil")
                .when(code.isin(*NUCLEAR_FUELS), "nuclear")
                .otherwise("other"),
                "emissions_factor_kg_per_mwh": F.coalesce(factors[code], F.lit(0.0)),
                "updated_at": now_or(as_of),
            }
        )
        .select(*DIM_FUEL.names)
    )


REGION_RULES: list[Rule] = [
    NotNull(("period", "event_date", "respondent", "respondent_name", "value_units")),
    Unique(("period", "respondent")),
    NonNegative(("actual_demand_mwh", "day_ahead_forecast_mwh")),
]
FUEL_RULES: list[Rule] = [
    NotNull(
        (
            "period",
            "event_date",
            "respondent",
            "respondent_name",
            "fueltype",
            "generation_mwh",
            "value_units",
        )
    ),
    Unique(FUEL_SPEC.business_key),
    NonNegative(("generation_mwh",)),
]
POWER_RULES: list[Rule] = [
    NotNull(("event_date", *POWER_SPEC.required)),
    Unique(POWER_SPEC.business_key),
    NonNegative(
        (
            "ash_content_pct",
            "consumption_for_eg_thousand_units",
            "generation_mwh",
            "heat_content_btu_per_unit",
        )
    ),
]
DIM_RESPONDENT_RULES: list[Rule] = [
    NotNull(("respondent", "respondent_name", "first_seen_date", "last_seen_date")),
    Unique(("respondent",)),
]
DIM_FUEL_RULES: list[Rule] = [
    NotNull(("fueltype", "fueltype_name", "fuel_category")),
    Unique(("fueltype",)),
    NonNegative(("emissions_factor_kg_per_mwh",)),
]
