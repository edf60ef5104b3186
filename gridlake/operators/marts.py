"""Platinum marts: grid status and alerts, daily planning, daily demand, monthly power."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import as_instant, now_or, percent, ratio, sum_for
from gridlake.operators.quality import (
    Bounds,
    BoundsWhere,
    MinDistinct,
    MinRows,
    NonNegative,
    NotNull,
    Rule,
    Unique,
)
from gridlake.operators.moments import day_moments, zscores_from_moments
from gridlake.operators.stats import with_group_stats, with_previous
from gridlake.schemas import (
    COVERAGE_ALERT,
    COVERAGE_HIGH,
    FOSSIL_FUELS,
    GAS,
    GRID_ALERTS,
    GRID_LOOKBACK_DAYS,
    GRID_STATUS,
    PLANNING_DAILY,
    PLANNING_LOOKBACK_DAYS,
    POWER_MONTHLY,
    REGION_DAILY,
    RENEWABLE_FUELS,
    Z_ALERT,
    Z_HIGH,
)

Instant = datetime | str | Column | None

# --- fixed values: alert types, the column they watch, their text -------------

Z_ALERTS = (
    ("forecast_error", "forecast_error_zscore", "Forecast error z-score reached "),
    ("ramp_risk", "demand_ramp_zscore", "Demand ramp z-score reached "),
    ("demand_anomaly", "demand_zscore", "Demand z-score reached "),
)
COVERAGE_ALERT_TYPE = "fuel_mix_support_gap"
COVERAGE_ALERT_TEXT = "Generation coverage ratio dropped to "

# --- daily demand -------------------------------------------------------------


def region_daily(
    region: DataFrame, start: Instant = None, end: Instant = None, as_of: Instant = None
) -> DataFrame:
    """Sum, mean and peak of hourly demand per day and respondent."""
    demand = F.col("actual_demand_mwh")
    return (
        region.filter(demand.isNotNull())
        .groupBy(F.to_date("period").alias("date"), "respondent")
        .agg(
            F.sum(demand).alias("daily_demand_mwh"),
            F.avg(demand).alias("avg_hourly_demand_mwh"),
            F.max(demand).alias("peak_hourly_demand_mwh"),
            F.max("loaded_at").alias("loaded_at"),
        )
        .withColumns(
            {
                "source_window_start": as_instant(start),
                "source_window_end": as_instant(end),
                "updated_at": now_or(as_of),
            }
        )
        .select(*REGION_DAILY.names)
    )


# --- grid operations ----------------------------------------------------------


def fuel_mix_hourly(fuel: DataFrame) -> DataFrame:
    """Total, renewable, fossil and gas generation per hour and respondent."""
    return fuel.groupBy("period", "respondent").agg(
        F.max("respondent_name").alias("fuel_respondent_name"),
        F.sum("generation_mwh").alias("total_generation_mwh"),
        sum_for(RENEWABLE_FUELS, "fueltype", "generation_mwh").alias("renewable_generation_mwh"),
        sum_for(FOSSIL_FUELS, "fueltype", "generation_mwh").alias("fossil_generation_mwh"),
        sum_for([GAS], "fueltype", "generation_mwh").alias("gas_generation_mwh"),
    )


def demand_ramp(region: DataFrame, reach_days: int | None = None) -> DataFrame:
    """Change of demand against the respondent's previous row, not its previous hour.

    With ``reach_days``, a row that is more than so many days older is none.
    """
    month = F.date_trunc("month", "period")
    if reach_days is None:
        before = F.col("_previous")
        previous = with_previous(
            region, "actual_demand_mwh", "respondent", "period", month, "_previous"
        )
    else:
        paired = region.withColumn("_pair", F.struct("actual_demand_mwh", "period"))
        previous = with_previous(
            paired, "_pair", "respondent", "period", month, "_previous"
        ).drop("_pair")
        near = F.col("_previous.period") >= F.col("period") - F.make_dt_interval(F.lit(reach_days))
        before = F.when(near, F.col("_previous.actual_demand_mwh"))
    return previous.withColumn(
        "demand_ramp_mwh", F.col("actual_demand_mwh") - before
    ).drop("_previous")


def zscores(df: DataFrame, by: str, named: dict[str, str]) -> DataFrame:
    """``df`` plus (x - mean) / population std over all rows of ``by``, per column.

    ``named`` maps result names to columns. The score is 0 where the std is 0 or
    null, and null where the value is null and the std is not 0.
    """
    stats = {}
    for column in named.values():
        stats[f"_avg_{column}"] = F.avg(column)
        stats[f"_std_{column}"] = F.stddev_pop(column)
    scored = with_group_stats(df, [by], **stats)
    for name, column in named.items():
        std = F.col(f"_std_{column}")
        score = (F.col(column) - F.col(f"_avg_{column}")) / std
        scored = scored.withColumn(name, F.when(std > 0, score).otherwise(0.0))
    return scored.drop(*stats)


def grid_measures(
    region: DataFrame, fuel: DataFrame, reach_days: int | None = None
) -> DataFrame:
    """Hourly ramp, generation by class, gap, coverage and shares per respondent."""
    mix = fuel_mix_hourly(fuel)
    joined = demand_ramp(region, reach_days).join(mix, ["period", "respondent"], "left")
    demand, total = F.col("actual_demand_mwh"), F.col("total_generation_mwh")
    return joined.withColumns(
        {
            "respondent_name": F.coalesce("respondent_name", "fuel_respondent_name", "respondent"),
            "generation_gap_mwh": total - demand,
            "coverage_ratio": ratio(total, demand),
            "renewable_share_pct": percent(F.col("renewable_generation_mwh"), total),
            "fossil_share_pct": percent(F.col("fossil_generation_mwh"), total),
            "gas_share_pct": percent(F.col("gas_generation_mwh"), total),
        }
    )


def grid_status(
    region: DataFrame,
    fuel: DataFrame,
    as_of: Instant = None,
    drop_unmeasured: bool = False,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Hourly operations per respondent: measures, z-scores and alert count.

    The marts' rules reject hours without an actual demand; ``drop_unmeasured``
    leaves those hours out instead. The z-scores read the measures twice, for the
    statistics and for the rows; ``keep`` may store them in between.
    """
    if drop_unmeasured:
        region = region.filter(F.col("actual_demand_mwh").isNotNull())
    measured = grid_measures(region, fuel)
    if keep:
        measured = keep(measured)
    return _status(zscores(measured, "respondent", GRID_SCORES), as_of)


GRID_SCORES = {
    "forecast_error_zscore": "forecast_error_mwh",
    "demand_ramp_zscore": "demand_ramp_mwh",
    "demand_zscore": "actual_demand_mwh",
}


def grid_status_by_day(
    region: DataFrame,
    fuel: DataFrame,
    days: int,
    keep: Callable[[DataFrame], DataFrame],
    as_of: Instant = None,
    scored_days: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``grid_status`` of measured hours, each day scored over the ``days`` that end with it.

    Unlike a window that moves with every run, a day's own window gives the same rows
    whenever it is computed. ``scored_days`` picks the rows wanted; rows up to 2 ``days`` before
    them are needed, ``days`` for the scores and as many for the first ramp. ``keep`` stores
    the measures and the moments of their days.
    """
    measured = keep(grid_measures(region.filter(F.col("actual_demand_mwh").isNotNull()), fuel, days))
    moments = keep(day_moments(measured, "respondent", list(GRID_SCORES.values())))
    wanted = scored_days(measured)
    return _status(zscores_from_moments(wanted, moments, "respondent", GRID_SCORES, days), as_of)


def _status(scored: DataFrame, as_of: Instant) -> DataFrame:
    raised = [F.abs(F.col(column)) >= Z_ALERT for _, column, _ in Z_ALERTS]
    raised.append(F.col("coverage_ratio") < COVERAGE_ALERT)
    count = F.lit(0)
    for condition in raised:
        count = count + F.when(condition, 1).otherwise(0)
    return scored.withColumns({"alert_count": count, "updated_at": now_or(as_of)}).select(
        *GRID_STATUS.names
    )


def _alert(kind: str, column: str, text: str, alert: Column, high: Column, limit: float) -> Column:
    """The alert as a struct, or null where it is not raised."""
    value = F.col(column)
    return F.when(
        alert,
        F.struct(
            F.lit(kind).alias("alert_type"),
            F.when(high, "high").otherwise("medium").alias("severity"),
            value.alias("metric_value"),
            F.lit(limit).alias("threshold_value"),
            F.concat(F.lit(text), F.round(value, 2).cast("string")).alias("message"),
        ),
    )


def _alerts() -> list[Column]:
    found = []
    for kind, column, text in Z_ALERTS:
        size = F.abs(F.col(column))
        found.append(_alert(kind, column, text, size >= Z_ALERT, size >= Z_HIGH, Z_ALERT))
    cover = F.col("coverage_ratio")
    found.append(
        _alert(
            COVERAGE_ALERT_TYPE,
            "coverage_ratio",
            COVERAGE_ALERT_TEXT,
            cover < COVERAGE_ALERT,
            cover < COVERAGE_HIGH,
            COVERAGE_ALERT,
        )
    )
    return found


def grid_alerts(status: DataFrame, as_of: Instant = None) -> DataFrame:
    """One row per raised alert, all four kinds in one pass over the status."""
    raised = F.filter(F.array(*_alerts()), lambda alert: alert.isNotNull())
    return (
        status.select("period", "respondent", "respondent_name", F.inline(raised))
        .withColumn("updated_at", now_or(as_of))
        .select(*GRID_ALERTS.names)
    )


def grid_alerts_union(status: DataFrame, as_of: Instant = None) -> DataFrame:
    """``grid_alerts`` as a union by name of one branch per kind, for separate sources."""
    branches = [
        status.select("period", "respondent", "respondent_name", alert.alias("alert"))
        .filter(F.col("alert").isNotNull())
        .select("period", "respondent", "respondent_name", "alert.*")
        for alert in _alerts()
    ]
    result = branches[0]
    for branch in branches[1:]:
        result = result.unionByName(branch)
    return result.withColumn("updated_at", now_or(as_of)).select(*GRID_ALERTS.names)


# --- resource planning --------------------------------------------------------


def demand_daily(region: DataFrame) -> DataFrame:
    """Demand, peak, forecast accuracy and peak hour per day and respondent.

    The peak hour is the earliest one with the day's largest demand.
    """
    demand = F.col("actual_demand_mwh")
    return (
        region.filter(demand.isNotNull())
        .groupBy(F.to_date("period").alias("date"), "respondent")
        .agg(
            F.max("respondent_name").alias("respondent_name"),
            F.sum(demand).alias("daily_demand_mwh"),
            F.max(demand).alias("peak_hourly_demand_mwh"),
            F.avg(F.abs("forecast_error_pct")).alias("avg_abs_forecast_error_pct"),
            F.min(F.struct((-demand).alias("least"), "period"))["period"].alias("peak_period"),
        )
    )


def generation_daily(fuel: DataFrame, dim_fuel: DataFrame) -> DataFrame:
    """Generation per day and respondent by class, its emissions and diversity.

    Fuels are summed once, to (day, respondent, fuel); totals, classes, emissions
    and the sum of squares behind the diversity index all follow from those sums.
    """
    per_fuel = fuel.groupBy(
        F.to_date("period").alias("date"), "respondent", "fueltype"
    ).agg(
        F.max("respondent_name").alias("fuel_respondent_name"),
        F.sum("generation_mwh").alias("mwh"),
    )
    factors = dim_fuel.select("fueltype", F.col("emissions_factor_kg_per_mwh").alias("factor"))
    weighted = per_fuel.join(factors, "fueltype", "left").withColumn(
        "kg", F.col("mwh") * F.coalesce("factor", F.lit(0.0))
    )
    total = F.col("total_generation_mwh")
    return (
        weighted.groupBy("date", "respondent")
        .agg(
            F.max("fuel_respondent_name").alias("fuel_respondent_name"),
            F.sum("mwh").alias("total_generation_mwh"),
            sum_for(RENEWABLE_FUELS, "fueltype", "mwh").alias("renewable_generation_mwh"),
            sum_for(FOSSIL_FUELS, "fueltype", "mwh").alias("fossil_generation_mwh"),
            sum_for([GAS], "fueltype", "mwh").alias("gas_generation_mwh"),
            F.sum("kg").alias("emissions_kg"),
            F.sum(F.col("mwh") * F.col("mwh")).alias("_squares"),
        )
        .withColumns(
            {
                "carbon_intensity_kg_per_mwh": ratio(F.col("emissions_kg"), total),
                "fuel_diversity_index": F.when(
                    total > 0, 1.0 - F.col("_squares") / (total * total)
                ).otherwise(1.0),
            }
        )
        .drop("_squares")
    )


def with_peak_hour_gas(demand: DataFrame, fuel: DataFrame) -> DataFrame:
    """``demand_daily`` rows plus the gas share of generation in their peak hour."""
    mix = fuel_mix_hourly(fuel).select(
        F.col("period").alias("peak_period"),
        "respondent",
        percent(F.col("gas_generation_mwh"), F.col("total_generation_mwh")).alias(
            "peak_hour_gas_share_pct"
        ),
    )
    return demand.join(mix, ["peak_period", "respondent"], "left")


def planning_daily(
    region: DataFrame, fuel: DataFrame, dim_fuel: DataFrame, as_of: Instant = None
) -> DataFrame:
    """Daily planning figures per respondent with a measured demand."""
    days = demand_daily(region).join(
        generation_daily(fuel, dim_fuel), ["date", "respondent"], "left"
    )
    joined = with_peak_hour_gas(days, fuel)
    total, renewable = F.col("total_generation_mwh"), F.col("renewable_generation_mwh")
    return joined.withColumns(
        {
            "respondent_name": F.coalesce("respondent_name", "fuel_respondent_name", "respondent"),
            "renewable_share_pct": percent(renewable, total),
            "fossil_share_pct": percent(F.col("fossil_generation_mwh"), total),
            "gas_share_pct": percent(F.col("gas_generation_mwh"), total),
            "clean_coverage_ratio": ratio(renewable, F.col("daily_demand_mwh")),
            "weekend_flag": F.weekday("date") >= 5,
            "updated_at": now_or(as_of),
        }
    ).select(*PLANNING_DAILY.names)


# --- monthly power ------------------------------------------------------------


def power_mart(
    power: DataFrame, start: Instant = None, end: Instant = None, as_of: Instant = None
) -> DataFrame:
    """Share of the month's generation at a location, heat input and heat rate.

    Heat input is consumption x heat content x 1000, so it is in MMBtu only where
    the heat content is given in MMBtu per unit.
    """
    generated = F.col("generation_mwh")
    shared = with_group_stats(
        power, ["period", "location"], _period_mwh=F.sum("generation_mwh")
    )
    heat = F.col("consumption_for_eg_thousand_units") * F.col("heat_content_btu_per_unit") * 1000.0
    return shared.withColumns(
        {
            "generation_share_pct": percent(generated, F.col("_period_mwh")),
            "fuel_heat_input_mmbtu": heat,
            "heat_rate_btu_per_kwh": F.when(generated > 0, heat * 1000.0 / generated),
            "source_window_start": as_instant(start),
            "source_window_end": as_instant(end),
            "updated_at": now_or(as_of),
        }
    ).select(*POWER_MONTHLY.names)


# --- rules --------------------------------------------------------------------


def _shares(*columns: str) -> list[Rule]:
    return [Bounds(c, 0.0, 100.0) for c in columns]


REGION_DAILY_RULES: list[Rule] = [
    NotNull(
        (
            "date",
            "respondent",
            "daily_demand_mwh",
            "avg_hourly_demand_mwh",
            "peak_hourly_demand_mwh",
            "loaded_at",
        )
    ),
    Unique(("date", "respondent")),
    NonNegative(("daily_demand_mwh", "avg_hourly_demand_mwh", "peak_hourly_demand_mwh")),
]
GRID_STATUS_RULES: list[Rule] = [
    NotNull(("period", "respondent", "respondent_name", "actual_demand_mwh")),
    Unique(("period", "respondent")),
    NonNegative(
        (
            "actual_demand_mwh",
            "day_ahead_forecast_mwh",
            "total_generation_mwh",
            "renewable_generation_mwh",
            "fossil_generation_mwh",
            "gas_generation_mwh",
            "alert_count",
        )
    ),
    *_shares("renewable_share_pct", "fossil_share_pct", "gas_share_pct"),
    Bounds("coverage_ratio", 0.0),
]
GRID_ALERT_RULES: list[Rule] = [Unique(("period", "respondent", "alert_type"))]
PLANNING_RULES: list[Rule] = [
    NotNull(("date", "respondent", "respondent_name", "daily_demand_mwh")),
    Unique(("date", "respondent")),
    NonNegative(
        (
            "daily_demand_mwh",
            "peak_hourly_demand_mwh",
            "avg_abs_forecast_error_pct",
            "carbon_intensity_kg_per_mwh",
            "fuel_diversity_index",
            "clean_coverage_ratio",
        )
    ),
    *_shares("renewable_share_pct", "fossil_share_pct", "gas_share_pct"),
    Bounds("fuel_diversity_index", 0.0, 1.0),
    *_shares("peak_hour_gas_share_pct"),
]
POWER_MART_RULES: list[Rule] = [
    NotNull(
        (
            "period",
            "location",
            "location_name",
            "sector_id",
            "sector_name",
            "fueltype_id",
            "fueltype_name",
            "loaded_at",
        )
    ),
    Unique(("period", "location", "sector_id", "fueltype_id")),
    NonNegative(
        (
            "generation_mwh",
            "generation_share_pct",
            "consumption_for_eg_thousand_units",
            "ash_content_pct",
            "heat_content_btu_per_unit",
            "fuel_heat_input_mmbtu",
            "heat_rate_btu_per_kwh",
        )
    ),
    *_shares("generation_share_pct"),
]


def recent(column: str, days: int, as_of: datetime) -> str:
    """SQL text: the column lies within ``days`` before ``as_of``."""
    return f"{column} >= TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}' - INTERVAL {days} DAYS"


def same_window(start: datetime | None, end: datetime | None) -> str:
    """SQL text: the row was built from exactly this source window."""

    def is_(column: str, value: datetime | None) -> str:
        return f"{column} IS NULL" if value is None else f"{column} = TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"

    return f"{is_('source_window_start', start)} AND {is_('source_window_end', end)}"


def _published(where: str, entity: str, *bounds: tuple[str, float, float | None]) -> list[Rule]:
    return [
        MinRows(1, where, allow_empty=True),
        MinDistinct(entity, 1, where, allow_empty=True),
        *[BoundsWhere(c, low, high, where) for c, low, high in bounds],
    ]


def grid_published_rules(as_of: datetime) -> list[Rule]:
    """What must hold of recent grid rows once a stage is merged."""
    return _published(
        recent("period", GRID_LOOKBACK_DAYS, as_of),
        "respondent",
        ("coverage_ratio", 0.0, None),
        ("renewable_share_pct", 0.0, 100.0),
    )


def planning_published_rules(as_of: datetime) -> list[Rule]:
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return _published(
        recent("date", PLANNING_LOOKBACK_DAYS, midnight),
        "respondent",
        ("renewable_share_pct", 0.0, 100.0),
        ("carbon_intensity_kg_per_mwh", 0.0, None),
    )


def region_daily_published_rules(start: datetime | None, end: datetime | None) -> list[Rule]:
    return _published(same_window(start, end), "respondent", ("daily_demand_mwh", 0.0, None))


def power_published_rules(start: datetime | None, end: datetime | None) -> list[Rule]:
    return _published(
        same_window(start, end), "fueltype_id", ("generation_share_pct", 0.0, 100.0)
    )
