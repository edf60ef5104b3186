"""The same results in ANSI SQL over the given tables, written independently of Spark.

``CTES`` holds the steps in order; ``sql`` prefixes a final select with the steps it
needs. Doubles are rounded to six places and dates cast to text, as the queries do.
"""

from __future__ import annotations

import re

from gridlake import schemas as S
from gridlake.operators.analytics import PLANNING_QUANTILES, SERIES_LABELS, STRATEGY_QUANTILES
from gridlake.operators.geo import COORDINATES
from gridlake.plans.queries import AS_OF, BOUNDARY, FOCUS, MID, RUNS_AS_OF, WINDOW
from gridlake.sources.feed import (
    FUEL_NAMES,
    FUEL_OF_EVENT,
    LOCATIONS,
    POWER_FUELS,
    RESPONDENTS,
    RUN_ID,
    WORKFLOWS,
)
from gridlake.sources.feed import WINDOW as FEED_WINDOW


def ts(value) -> str:
    return f"timestamp '{value:%Y-%m-%d %H:%M:%S}'"


def texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def case(mapping, on: str) -> str:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"case {on} {arms} end"


def six(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 as {name}"


DOUBLES = {
    f.name
    for table in (
        S.GOLD_REGION,
        S.GOLD_FUEL,
        S.GOLD_POWER,
        S.DIM_FUEL,
        S.REGION_DAILY,
        S.GRID_STATUS,
        S.GRID_ALERTS,
        S.PLANNING_DAILY,
        S.POWER_MONTHLY,
        *[spec.schema for spec in S.SPECS.values()],
    )
    for f in table
    if f.dataType.typeName() == "double"
}
DATES = {"date", "event_date", "first_seen_date", "last_seen_date"}


def shown(columns, prefix: str = "") -> str:
    """Column list in comparable form."""
    parts = []
    for c in columns:
        if c in ("updated_at", "verified_at"):
            continue
        if c in DOUBLES:
            parts.append(six(f"{prefix}{c}", c))
        elif c in DATES:
            parts.append(f"cast(cast({prefix}{c} as date) as varchar) as {c}")
        else:
            parts.append(f"{prefix}{c}")
    return ", ".join(parts)


RENEWABLE, FOSSIL = texts(S.RENEWABLE_FUELS), texts(S.FOSSIL_FUELS)
FACTORS = " ".join(f"when '{k}' then {v}" for k, v in S.EMISSIONS_KG_PER_MWH.items())
FUEL_COLS = [f.name for f in S.FUEL_SPEC.schema]
REGION_COLS = [f.name for f in S.REGION_SPEC.schema]
POWER_COLS = [f.name for f in S.POWER_SPEC.schema]
IN_WINDOW = f"period >= {ts(WINDOW[0])} and period < {ts(WINDOW[1])}"
RECENT = f"period >= {ts(AS_OF)} - interval 14 day"


# with microseconds where the instant has a part of a second
INGESTED = """(strftime(ingestion_ts, '%Y-%m-%dT%H:%M:%S') || case when
  date_trunc('second', ingestion_ts) = ingestion_ts then '' else strftime(ingestion_ts, '.%f') end
  || '+00:00')"""


def jtext(column: str) -> str:
    return f"coalesce('\"' || {column} || '\"', 'null')"


def region_json() -> str:
    keys = (
        ("period", "period_text"),
        ("respondent", "respondent_text"),
        ("respondent-name", "respondent_name"),
        ("type", "type"),
        ("type-name", "type_name"),
        ("value", "value_text"),
        ("value-units", "units_text"),
    )
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {jtext(c)}" for k, c in keys) + " || '}'"


def fuel_json() -> str:
    keys = (
        ("fueltype", "fueltype"),
        ("period", "period_text"),
        ("respondent", "respondent"),
        ("respondent-name", "respondent_name"),
        ("type-name", "fueltype_name"),
        ("value", "fuel_value_text"),
        ("value-units", "'megawatthours'"),
    )
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {jtext(c)}" for k, c in keys) + " || '}'"


def identity(spec, row: str) -> str:
    head = f'{{"dataset":"{spec.dataset}","route":"{spec.route}","row":'
    return f"sha256('{head}' || {row} || '}}')"


def newest(table: str, keys: str, order: str) -> str:
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {keys}"
        f" order by {order}) as rn from {table}) where rn = 1"
    )


CTES: dict[str, str] = {}

CTES["ev"] = f"""
select *,
  case when copy = 1 then ts + interval 5 minute else ts end as ingestion_ts,
  case when event_id % 41 = 0 then null else date_trunc('hour', ts) end as period,
  case when event_id % 41 = 0 then 'not-a-date' else strftime(ts, '%Y-%m-%dT%H') end as period_text,
  list_extract([{texts(RESPONDENTS)}], cast(user_id % 6 as int) + 1) as respondent,
  case when event_id % 11 = 0 then '  ' || respondent || ' ' else respondent end as respondent_text,
  case when event_id % 29 <> 0 then 'Balancing area ' || respondent
    || case when ts >= timestamp '2024-01-16 00:00:00' then ' (new)' else '' end end
    as respondent_name,
  case when event_id % 2 = 0 then 'D' else 'DF' end as type,
  case when event_id % 2 = 0 then 'Demand' else 'Day-ahead demand forecast' end as type_name,
  cast(cast(value as decimal(18,2)) as varchar) as plain_text,
  case when event_id % 37 = 0 then 'n/a' else plain_text end as value_text,
  case when event_id % 3 = 0 then ' MegaWattHours' else 'MWh' end as units_text,
  case when event_id % 53 = 0 then 'XX' else {case(FUEL_OF_EVENT, 'event_type')} end as fueltype,
  case when event_id % 19 <> 0 then {case(FUEL_NAMES, 'fueltype')} end as fueltype_name,
  case when event_id % 37 = 0 then 'n/a' when event_id % 31 = 0
    then cast(-cast(value as decimal(18,2)) as varchar) else plain_text end as fuel_value_text,
  cast(user_id % 4 as int) as kafka_partition,
  event_id * 2 + copy as kafka_offset
from (select *, unnest(range(0, case when event_id % 13 = 0 then 2 else 1 end)) as copy from events)
"""
CTES["extract_region"] = """
select cast(event_id as varchar) as event_id, period, respondent, respondent_name, type, type_name,
  try_cast(value_text as double) as value, lower(trim(units_text)) as value_units,
  ingestion_ts as loaded_at from ev
"""
CTES["extract_fuel"] = """
select cast(event_id as varchar) as event_id, period, respondent, respondent_name, fueltype,
  fueltype_name, try_cast(fuel_value_text as double) as value, 'megawatthours' as value_units,
  ingestion_ts as loaded_at from ev
"""
CTES["extract_power"] = f"""
select l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber || '-'
    || cast(l_extendedprice as decimal(18,2)) as event_id,
  date_trunc('month', l_shipdate) as period,
  list_extract([{texts(LOCATIONS)}], cast(l_suppkey % 3 as int) + 1) as location,
  {case(LOCATIONS, 'location')} as location_name,
  l_returnflag || l_linestatus as sector_id,
  case when l_orderkey % 47 <> 0 then 'Sector ' || l_returnflag || l_linestatus end as sector_name,
  list_extract([{texts(POWER_FUELS)}], cast(l_partkey % 5 as int) + 1) as fueltype_id,
  'Fuel ' || fueltype_id as fueltype_name,
  cast(cast(l_tax * 100 as decimal(18,2)) as double) as ash_content_pct,
  'percent' as ash_content_units,
  case when l_orderkey % 59 <> 0 then l_extendedprice
    end as consumption_for_eg_thousand_units,
  'thousand short tons' as consumption_for_eg_units,
  case when l_orderkey % 101 = 0 then -l_quantity else l_quantity end as generation_thousand_mwh,
  'thousand megawatthours' as generation_units,
  cast(cast(l_discount * 100 as decimal(18,2)) as double) as heat_content_btu_per_unit,
  'btu per short tons' as heat_content_units,
  l_shipdate + to_hours(l_linenumber) as loaded_at
from lineitem
"""
BY_EVENT = "loaded_at desc, period desc"
CTES["complete_region"] = """
select *, cast(period as date) as event_date from extract_region
where period is not null and value is not null and respondent_name is not null
"""
CTES["silver_region"] = newest("complete_region", "event_id", BY_EVENT)
CTES["complete_fuel"] = """
select *, cast(period as date) as event_date from extract_fuel
where period is not null and value is not null and respondent_name is not null
"""
CTES["silver_fuel"] = newest("complete_fuel", "event_id", BY_EVENT)
CTES["complete_power"] = """
select *, cast(period as date) as event_date from extract_power where sector_name is not null
"""
CTES["silver_power"] = newest("complete_power", "event_id", BY_EVENT)
VERSION = "loaded_at desc, event_id desc"
CTES["latest_region"] = newest("silver_region", "period, respondent, type", VERSION)


def region_fact(rows: str) -> str:
    """Demand and forecast joined side by side, from the newest row of each."""
    return f"""
select coalesce(d.period, f.period) as period, coalesce(d.event_date, f.event_date) as event_date,
  coalesce(d.respondent, f.respondent) as respondent,
  coalesce(d.respondent_name, f.respondent_name, d.respondent, f.respondent) as respondent_name,
  'MWh' as value_units, d.value as actual_demand_mwh, f.value as day_ahead_forecast_mwh,
  d.value - f.value as forecast_error_mwh,
  case when f.value <> 0 then (d.value - f.value) / f.value * 100.0 end as forecast_error_pct,
  greatest(d.loaded_at, f.loaded_at) as loaded_at
from (select * from ({rows}) where type = 'D') d
full join (select * from ({rows}) where type = 'DF') f
  on d.period = f.period and d.respondent = f.respondent
"""


CTES["gold_region"] = region_fact("select * from latest_region")
CTES["latest_fuel"] = newest("silver_fuel", "period, respondent, fueltype", VERSION)
CTES["gold_fuel"] = """
select period, event_date, respondent, respondent_name, fueltype, fueltype_name,
  'MWh' as value_units, greatest(value, 0.0) as generation_mwh, loaded_at from latest_fuel
"""
CTES["latest_power"] = newest(
    "silver_power", "period, location, sector_id, fueltype_id", VERSION
)
CTES["gold_power"] = """
select period, event_date, location, location_name, sector_id, sector_name, fueltype_id,
  fueltype_name, greatest(ash_content_pct, 0.0) as ash_content_pct,
  case when consumption_for_eg_thousand_units is not null
    then greatest(consumption_for_eg_thousand_units, 0.0) end as consumption_for_eg_thousand_units,
  greatest(generation_thousand_mwh, 0.0) * 1000.0 as generation_mwh,
  greatest(heat_content_btu_per_unit, 0.0) as heat_content_btu_per_unit, loaded_at
from latest_power
"""
CTES["dim_fuel"] = f"""
select fueltype, max_by(fueltype_name, (event_date, fueltype_name)) as fueltype_name,
  case when fueltype in ({RENEWABLE}) then 'renewable' when fueltype in ({FOSSIL}) then 'fossil'
    when fueltype = 'NUC' then 'nuclear' else 'other' end as fuel_category,
  coalesce(case fueltype {FACTORS} end, 0.0) as emissions_factor_kg_per_mwh
from silver_fuel group by fueltype
"""


def mix(by: str, amount: str = "generation_mwh") -> str:
    return f"""
  max(respondent_name) as fuel_respondent_name,
  sum({amount}) as total_generation_mwh,
  sum(case when fueltype in ({RENEWABLE}) then {amount} else 0.0 end) as renewable_generation_mwh,
  sum(case when fueltype in ({FOSSIL}) then {amount} else 0.0 end) as fossil_generation_mwh,
  sum(case when fueltype = 'NG' then {amount} else 0.0 end) as gas_generation_mwh
from {by}"""


CTES["fuel_mix"] = (
    "select period, respondent," + mix("gold_fuel") + " group by period, respondent"
)


def score(column: str) -> str:
    return (
        f"case when stddev_pop({column}) over (partition by respondent) > 0 then"
        f" ({column} - avg({column}) over (partition by respondent))"
        f" / stddev_pop({column}) over (partition by respondent) else 0.0 end"
    )


CTES["measured"] = """
select r.period, r.respondent,
  coalesce(r.respondent_name, f.fuel_respondent_name, r.respondent) as respondent_name,
  actual_demand_mwh, day_ahead_forecast_mwh, forecast_error_mwh, forecast_error_pct,
  actual_demand_mwh - lag(actual_demand_mwh) over (partition by r.respondent order by r.period)
    as demand_ramp_mwh,
  total_generation_mwh, renewable_generation_mwh, fossil_generation_mwh, gas_generation_mwh,
  case when total_generation_mwh > 0 then renewable_generation_mwh / total_generation_mwh * 100.0
    end as renewable_share_pct,
  case when total_generation_mwh > 0 then fossil_generation_mwh / total_generation_mwh * 100.0
    end as fossil_share_pct,
  case when total_generation_mwh > 0 then gas_generation_mwh / total_generation_mwh * 100.0
    end as gas_share_pct,
  total_generation_mwh - actual_demand_mwh as generation_gap_mwh,
  case when actual_demand_mwh > 0 then total_generation_mwh / actual_demand_mwh end
    as coverage_ratio
from (select * from gold_region where actual_demand_mwh is not null) r
left join fuel_mix f on r.period = f.period and r.respondent = f.respondent
"""
CTES["scored"] = f"""
select *, {score('forecast_error_mwh')} as forecast_error_zscore,
  {score('demand_ramp_mwh')} as demand_ramp_zscore, {score('actual_demand_mwh')} as demand_zscore
from measured
"""
CTES["status"] = """
select *, cast(case when abs(forecast_error_zscore) >= 2.5 then 1 else 0 end
  + case when abs(demand_ramp_zscore) >= 2.5 then 1 else 0 end
  + case when coverage_ratio < 0.9 then 1 else 0 end
  + case when abs(demand_zscore) >= 2.5 then 1 else 0 end as int) as alert_count from scored
"""


# the same, each day scored over the 14 days that end with it
_RESPONDENT = "partition by respondent)"
_TRAILING = (
    "partition by respondent order by cast(period as date)"
    " range between interval 13 days preceding and current row)"
)
_PREVIOUS = "lag({}) over (partition by r.respondent order by r.period)"
CTES["day_measured"] = CTES["measured"].replace(
    f"actual_demand_mwh - {_PREVIOUS.format('actual_demand_mwh')}",
    f"case when r.period - interval 14 days <= {_PREVIOUS.format('r.period')}"
    f" then actual_demand_mwh - {_PREVIOUS.format('actual_demand_mwh')} end",
)
CTES["day_scored"] = (
    CTES["scored"].replace(_RESPONDENT, _TRAILING).replace("from measured", "from day_measured")
)
CTES["day_status"] = CTES["status"].replace("from scored", "from day_scored")


def z_alert(kind: str, column: str, text: str) -> str:
    return f"""
select period, respondent, respondent_name, '{kind}' as alert_type,
  case when abs({column}) >= 3.5 then 'high' else 'medium' end as severity,
  {column} as metric_value, 2.5::double as threshold_value,
  '{text}' || cast(round({column}, 2) + 0.0 as varchar) as message
from status where abs({column}) >= 2.5"""


CTES["alerts"] = " union all ".join(
    [
        z_alert("forecast_error", "forecast_error_zscore", "Forecast error z-score reached "),
        z_alert("ramp_risk", "demand_ramp_zscore", "Demand ramp z-score reached "),
        z_alert("demand_anomaly", "demand_zscore", "Demand z-score reached "),
        """
select period, respondent, respondent_name, 'fuel_mix_support_gap',
  case when coverage_ratio < 0.8 then 'high' else 'medium' end, coverage_ratio, 0.9::double,
  'Generation coverage ratio dropped to ' || cast(round(coverage_ratio, 2) + 0.0 as varchar)
from status where coverage_ratio < 0.9""",
    ]
)
CTES["day_alerts"] = CTES["alerts"].replace("from status", "from day_status")
CTES["demand_days"] = """
select cast(period as date) as date, respondent, max(respondent_name) as respondent_name,
  sum(actual_demand_mwh) as daily_demand_mwh, max(actual_demand_mwh) as peak_hourly_demand_mwh,
  avg(abs(forecast_error_pct)) as avg_abs_forecast_error_pct
from gold_region where actual_demand_mwh is not null group by 1, 2
"""
CTES["fuel_days"] = """
select cast(period as date) as date, g.respondent,
  max(respondent_name) as fuel_respondent_name, sum(generation_mwh) as total_generation_mwh,
  sum(case when g.fueltype in (RENEWABLE_LIST) then generation_mwh else 0.0 end)
    as renewable_generation_mwh,
  sum(case when g.fueltype in (FOSSIL_LIST) then generation_mwh else 0.0 end)
    as fossil_generation_mwh,
  sum(case when g.fueltype = 'NG' then generation_mwh else 0.0 end) as gas_generation_mwh,
  sum(generation_mwh * coalesce(emissions_factor_kg_per_mwh, 0.0)) as emissions_kg
from gold_fuel g left join dim_fuel d on g.fueltype = d.fueltype group by 1, 2
""".replace("RENEWABLE_LIST", RENEWABLE).replace("FOSSIL_LIST", FOSSIL)
CTES["diversity"] = """
select date, respondent,
  1.0 - sum(case when total > 0 then (mwh / total) * (mwh / total) else 0.0 end)
    as fuel_diversity_index
from (select date, respondent, mwh, sum(mwh) over (partition by date, respondent) as total
  from (select cast(period as date) as date, respondent, fueltype, sum(generation_mwh) as mwh
    from gold_fuel group by 1, 2, 3))
group by date, respondent
"""
CTES["peaks"] = """
select date, p.respondent, p.period as peak_period,
  case when total_generation_mwh > 0 then gas_generation_mwh / total_generation_mwh * 100.0 end
    as peak_hour_gas_share_pct
from (select *, cast(period as date) as date,
    row_number() over (partition by respondent, cast(period as date)
      order by actual_demand_mwh desc, period) as rn
  from gold_region where actual_demand_mwh is not null) p
left join fuel_mix f on p.period = f.period and p.respondent = f.respondent where rn = 1
"""
CTES["planning"] = """
select d.date, d.respondent,
  coalesce(d.respondent_name, f.fuel_respondent_name, d.respondent) as respondent_name,
  daily_demand_mwh, peak_hourly_demand_mwh, avg_abs_forecast_error_pct,
  case when total_generation_mwh > 0 then renewable_generation_mwh / total_generation_mwh * 100.0
    end as renewable_share_pct,
  case when total_generation_mwh > 0 then fossil_generation_mwh / total_generation_mwh * 100.0
    end as fossil_share_pct,
  case when total_generation_mwh > 0 then gas_generation_mwh / total_generation_mwh * 100.0
    end as gas_share_pct,
  case when total_generation_mwh > 0 then emissions_kg / total_generation_mwh end
    as carbon_intensity_kg_per_mwh,
  fuel_diversity_index, peak_hour_gas_share_pct,
  case when daily_demand_mwh > 0 then renewable_generation_mwh / daily_demand_mwh end
    as clean_coverage_ratio,
  dayofweek(d.date) in (0, 6) as weekend_flag
from demand_days d
left join fuel_days f on d.date = f.date and d.respondent = f.respondent
left join diversity v on d.date = v.date and d.respondent = v.respondent
left join peaks p on d.date = p.date and d.respondent = p.respondent
"""
CTES["power_rows"] = f"""
select *, case when sum(generation_mwh) over (partition by period, location) > 0
    then generation_mwh / sum(generation_mwh) over (partition by period, location) * 100.0 end
    as generation_share_pct,
  consumption_for_eg_thousand_units * heat_content_btu_per_unit * 1000.0 as fuel_heat_input_mmbtu,
  case when generation_mwh > 0 then consumption_for_eg_thousand_units * heat_content_btu_per_unit
    * 1000.0 * 1000.0 / generation_mwh end as heat_rate_btu_per_kwh,
  timestamp '1996-01-01 00:00:00' as source_window_start,
  timestamp '1998-01-01 00:00:00' as source_window_end
from gold_power
"""


def daily(table: str) -> str:
    return f"""
select cast(period as date) as date, respondent, sum(actual_demand_mwh) as daily_demand_mwh,
  avg(actual_demand_mwh) as avg_hourly_demand_mwh, max(actual_demand_mwh) as peak_hourly_demand_mwh,
  max(loaded_at) as loaded_at, {ts(WINDOW[0])} as source_window_start,
  {ts(WINDOW[1])} as source_window_end
from ({table}) where actual_demand_mwh is not null group by 1, 2
"""


CTES["region_days"] = daily("select * from gold_region")
CTES["snapshot"] = "select * from planning where date = (select max(date) from planning)"


def quantiles(wanted, table: str) -> str:
    parts = [f"quantile_cont({c}, {p}) as {name}" for name, (c, p) in wanted.items()]
    return f"select {', '.join(parts)} from {table}"


CTES["snapshot_limits"] = quantiles(PLANNING_QUANTILES, "snapshot")
CTES["limits"] = quantiles(PLANNING_QUANTILES, "planning")
CTES["strategy_limits"] = quantiles(STRATEGY_QUANTILES, "planning")
CTES["snapshot_strategy_limits"] = quantiles(STRATEGY_QUANTILES, "snapshot")
CARBON, GAS, REN = "carbon_intensity_kg_per_mwh", "peak_hour_gas_share_pct", "renewable_share_pct"
CLEAN, DIV, FERR = "clean_coverage_ratio", "fuel_diversity_index", "avg_abs_forecast_error_pct"
WEAK_GAS = f"({GAS} >= gas_p90 and {REN} <= renewable_p10)"
PLANNING_LABEL = f"""case when {CARBON} >= carbon_p90 or {WEAK_GAS} then 'Critical'
  when {CARBON} >= carbon_p75 or {DIV} <= diversity_p25 or {FERR} >= forecast_p75 then 'Elevated'
  else 'Stable' end"""
DRIVER_LABEL = f"""case when {CARBON} >= carbon_p75 then 'High carbon intensity'
  when {WEAK_GAS} then 'Gas-dependent peak with weak renewables'
  when {DIV} <= diversity_p25 then 'Low fuel diversity'
  when {FERR} >= forecast_p75 then 'Forecast accuracy drift' else 'Within expected range' end"""
STRATEGY_LABEL = f"""case when {CARBON} >= carbon_p90 or {WEAK_GAS}
  or ({CLEAN} <= clean_p10 and {DIV} <= diversity_p10) then 'Critical'
  when {CARBON} >= carbon_p75 or {REN} <= renewable_p25 or {CLEAN} <= clean_p25
  or {DIV} <= diversity_p25 then 'Elevated' else 'Stable' end"""
CTES["labelled"] = f"""
select p.*, {PLANNING_LABEL} as planning_priority, {DRIVER_LABEL} as primary_driver
from planning p, snapshot_limits
"""
CTES["labelled_by_all"] = f"""
select p.*, {PLANNING_LABEL} as planning_priority from planning p, limits
"""


def half_even(expression: str) -> str:
    """One decimal, ties to even, judged on the tenfold as a double."""
    return f"round_even(cast({expression} as double) * 10.0::double, 0) / 10.0::double"


def minmax(column: str, larger: bool, table: str) -> str:
    low, high = f"(select min({column}) from {table})", f"(select max({column}) from {table})"
    position = half_even(f"({column} - {low}) / ({high} - {low}) * 100.0")
    if not larger:
        position = half_even(f"100.0 - {position}")
    return f"case when {high} > {low} then {position} else 50.0 end"


def scores(table: str) -> str:
    return f"""
select *, {minmax(CARBON, False, table)} as score_carbon,
  {minmax(REN, True, table)} as score_renewable, {minmax(GAS, False, table)} as score_gas,
  {minmax(CLEAN, True, table)} as score_clean, {minmax(DIV, True, table)} as score_diversity
from {table}"""


HEALTH = half_even(
    "score_carbon * 0.25 + score_renewable * 0.25 + score_gas * 0.20"
    " + score_clean * 0.20 + score_diversity * 0.10"
)
CTES["scores"] = scores("planning")
CTES["health"] = f"select *, {HEALTH} as strategic_health_score from scores"
CTES["snapshot_scores"] = scores("snapshot")
CTES["trend_rows"] = f"""
select * from (
  unpivot (select date, respondent, {CARBON}, {REN}, {GAS}, {CLEAN}, {FERR} from planning)
  on {CARBON}, {REN}, {GAS}, {CLEAN}, {FERR} into name metric value value)
"""
CTES["trends"] = """
select respondent, metric, min_by(value, date) as first, max_by(value, date) as last,
  avg(value) as mean, stddev_pop(value) as std, count(*) as n,
  max_by(value, date) - min_by(value, date) as delta
from trend_rows group by respondent, metric
"""
CTES["counts"] = """
select date_trunc('hour', ts) as hour_start_utc, count(*) as observed_row_count from ev group by 1
"""
CTES["usual"] = """
select cast(observed_row_count as int) as expected_row_count from (
  select observed_row_count, count(*) as hours from counts group by 1)
order by hours desc, observed_row_count desc limit 1
"""
CTES["spine"] = f"""
select expected_row_count, oldest_hour_utc, newest_hour_utc,
  unnest(generate_series(oldest_hour_utc, newest_hour_utc, interval 1 hour)) as hour_start_utc
from (select (select expected_row_count from usual) as expected_row_count,
  min(hour_start_utc) as oldest_hour_utc,
  greatest(min(hour_start_utc), {ts(BOUNDARY)} - interval 1 hour) as newest_hour_utc from counts)
"""
CTES["covered"] = f"""
select '{S.REGION}' as dataset_id, s.hour_start_utc,
  coalesce(c.observed_row_count, 0) as observed_row_count, expected_row_count,
  coalesce(c.observed_row_count, 0) - expected_row_count as row_count_delta,
  case when coalesce(c.observed_row_count, 0) = 0 then 'missing'
    when c.observed_row_count = expected_row_count then 'verified'
    when c.observed_row_count < expected_row_count then 'partial' else 'excess' end as status,
  oldest_hour_utc, newest_hour_utc, {ts(BOUNDARY)} as verification_boundary_hour_utc
from spine s left join counts c on s.hour_start_utc = c.hour_start_utc
"""
CTES["ids"] = f"""
select *, {identity(S.REGION_SPEC, region_json())} as sha from ev
"""
CTES["batch"] = f"""
select sha as event_id, '{S.REGION}' as dataset, 'eia_api_v2' as source,
  strftime(period, '%Y-%m-%dT%H:%M:%S+00:00') as event_timestamp,
  {INGESTED} as ingestion_timestamp,
  'feed_region_data' as kafka_topic, kafka_partition, kafka_offset,
  ingestion_ts as kafka_timestamp, period as event_ts,
  ingestion_ts, cast(period as date) as event_date,
  '{S.REGION}' as dataset_partition, cast(year(period) as int) as event_year,
  cast(month(period) as int) as event_month, cast(day(period) as int) as event_day,
  cast(hour(period) as int) as event_hour, respondent_text as respondent, type
from ids where event_id % 43 <> 0 and period is not null
"""
CTES["firsts"] = newest("batch", "event_id", "kafka_partition, kafka_offset")
CTES["fresh"] = f"""
select * from firsts where event_id not in
  (select event_id from batch where kafka_timestamp < timestamp '{MID} 00:00:00')
"""
CTES["watch_hours"] = """
select s.*, coalesce(n, 0) as active_alert_count, coalesce(high, false) as has_high_alert,
  coalesce(medium, false) as has_medium_alert
from status s left join (select period, respondent, count(*) as n,
    bool_or(severity = 'high') as high, bool_or(severity = 'medium') as medium
  from alerts group by 1, 2) a on s.period = a.period and s.respondent = a.respondent
"""
CTES["watch"] = "select * from watch_hours where period = (select max(period) from status)"
GRID_LABEL = """case when has_high_alert or coverage_ratio < 0.8 then 'Critical'
  when has_medium_alert or abs(forecast_error_zscore) >= 2.5 or abs(demand_ramp_zscore) >= 2.5
  then 'Elevated' else 'Stable' end"""
CTES["runs"] = f"""
select list_extract([{texts(WORKFLOWS)}], cast(o_custkey % {len(WORKFLOWS)} as int) + 1) as dag_id,
  o_orderpriority as task_id, 'run-' || lpad(cast(o_orderkey as varchar), 12, '0') as run_id,
  {case({'F': 'failed', 'O': 'success', 'P': 'running'}, 'o_orderstatus')} as state,
  o_orderdate as execution_date, o_orderdate + interval 1 minute as queued_at,
  case when o_orderkey % 17 <> 0 then o_orderdate + interval 2 minute end as start_date,
  case when o_orderstatus <> 'P' then o_orderdate + to_hours(cast(o_orderkey % 5 as int)) end
    as end_date
from orders
"""
OWN = "(dag_id like 'electricity_%' or dag_id like 'platinum_%')"


def grain(time: str, entity: str, dimension: str) -> str:
    return (
        f"strftime({time}, '%Y-%m-%dT%H:%M:%SZ') || '|' || {entity} || '|' || {dimension}"
        f" as grain_key, cast({time} as timestamp) as period_start_utc, {entity} as respondent,"
        f" {dimension} as dimension_value"
    )


FUEL_KEY = grain("period", "respondent", "fueltype")
CTES["expected_fuel"] = f"""
select {FUEL_KEY} from (select event_id, max(period) as period, max(respondent) as respondent,
  max(fueltype) as fueltype from extract_fuel where period is not null and value is not null
  group by event_id)
where period >= timestamp '2024-01-02 00:00:00' and period < timestamp '2024-01-29 00:00:00'
"""
CTES["actual_fuel"] = f"""
select {FUEL_KEY} from silver_fuel where period >= timestamp '2024-01-02 00:00:00'
"""


def matched(expected: str, actual: str) -> str:
    return f"""
select coalesce(e.grain_key, a.grain_key) as grain_key,
  coalesce(e.period_start_utc, a.period_start_utc) as period_start_utc,
  coalesce(e.respondent, a.respondent) as respondent,
  coalesce(e.dimension_value, a.dimension_value) as dimension_value,
  coalesce(e.n, 0) as expected_rows, coalesce(a.n, 0) as actual_rows
from (select *, count(*) as n from {expected} group by all) e
full join (select *, count(*) as n from {actual} group by all) a on e.grain_key = a.grain_key
"""


CTES["matched"] = matched("expected_fuel", "actual_fuel")
TOTALS = """cast(coalesce(sum(expected_rows), 0) as bigint) as expected_count,
  cast(coalesce(sum(actual_rows), 0) as bigint) as actual_count,
  cast(count(*) filter (where actual_rows = 0) as bigint) as missing_count,
  cast(count(*) filter (where expected_rows = 0) as bigint) as extra_count"""
STATUS = """case when expected_count = 0 and actual_count = 0 then 'not_populated'
  when missing_count = 0 and extra_count = 0 and expected_count = actual_count then 'ok'
  when missing_count = 0 and extra_count = 0 then 'count_mismatch' else 'mismatch' end as status"""


def compared(stage: str, dataset: str, expected: str, actual: str) -> str:
    return f"""select '{stage}' as stage, '{dataset}' as dataset_id, {STATUS}, expected_count,
  actual_count, missing_count, extra_count
from (select {TOTALS} from ({matched(f'({expected})', f'({actual})')}))"""


def sql(final: str) -> str:
    """The final select with the steps it uses, directly or through other steps."""
    needed: set[str] = set()
    open_texts = [final]
    while open_texts:
        text = open_texts.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(from|join|,)\s+\(?{name}\b", text):
                needed.add(name)
                open_texts.append(CTES[name])
    steps = [f"{name} as ({CTES[name].strip()})" for name in CTES if name in needed]
    prefix = "with " + ",\n".join(steps) + "\n" if steps else ""
    return prefix + final.strip()


def half(table: str, first: bool) -> str:
    return f"select * from {table} where minute(loaded_at) {'<' if first else '>='} 30"


def report(table: str, rule: str, violations: str, source: str) -> str:
    name = rule.replace("'", "''")
    return (
        f"select '{table}' as table_name, '{name}' as rule,"
        f" cast({violations} as bigint) as violations from {source}"
    )


def short_of(least: int, found: str, allow_empty: bool = False) -> str:
    """How many are missing to ``least``; none may be allowed to be there."""
    short = f"greatest({least} - {found}, 0)"
    return f"case when {found} = 0 then 0 else {short} end" if allow_empty else short


def repeats(keys: str) -> str:
    return f"count(*) - count(distinct ({keys}))"


def conflicts(table: str, keys: str, columns: str) -> str:
    return f"""(select count(*) from (select 1 from {table} group by {keys}
  having count(distinct ({columns})) > 1))"""


def violations_of(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def dimension(rows: str) -> str:
    """Respondent dimension from (respondent, respondent_name, event_date, source) rows."""
    return f"""
select respondent, max_by(respondent_name, (event_date, respondent_name)) as respondent_name,
  min(event_date) as first_seen_date, max(event_date) as last_seen_date,
  count(distinct source) as source_dataset_count
from ({rows}) group by respondent"""


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    region, fuel, power = S.REGION_SPEC, S.FUEL_SPEC, S.POWER_SPEC

    # envelopes
    q["normalize_period"] = """
select event_id, period_text,
  case when event_id % 41 < 4 then null
    when event_id % 41 = 4 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.250000+00:00'
    when event_id % 41 = 5 then strftime(ts - interval 2 hour, '%Y-%m-%dT%H:%M:%S+00:00')
    else strftime(date_trunc(case event_type when 'click' then 'year' when 'view' then 'month'
      when 'purchase' then 'hour' when 'signup' then 'minute' else 'second' end, ts),
      '%Y-%m-%dT%H:%M:%S+00:00') end as event_timestamp
from (select *, case when event_id % 41 = 0 then 'not-a-date'
  when event_id % 41 = 1 then strftime(ts, '%H:%M')
  when event_id % 41 = 2 then strftime(ts, '%Y') || '9'
  when event_id % 41 = 3 then strftime(ts, '%Y-%m-%dT%H:%M:%S PST')
  when event_id % 41 = 4 then strftime(ts, '%Y-%m-%dT%H:%M:%S.250Z')
  when event_id % 41 = 5 then strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00')
  when event_type = 'click' then strftime(ts, '%Y')
  when event_type = 'view' then strftime(ts, '%Y-%m')
  when event_type = 'purchase' then strftime(ts, '%Y-%m-%dT%H')
  when event_type = 'signup' then strftime(ts, '%Y-%m-%dT%H:%M')
  else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as period_text from events)"""
    q["event_ids"] = "select event_id as source_id, cast(copy as int) as copy, sha as event_id from ids"
    q["build_envelopes"] = f"""
select {identity(fuel, fuel_json())} as event_id, '{S.FUEL}' as dataset, 'eia_api_v2' as source,
  strftime(period, '%Y-%m-%dT%H:%M:%S+00:00') as event_timestamp,
  {INGESTED} as ingestion_timestamp,
  'hourly' as frequency, '{fuel.route}' as route, respondent,
  '{RUN_ID}' as ingestion_run_id, '{FEED_WINDOW[1]}' as source_window_end,
  fueltype, fueltype_name as type_name, fuel_value_text as value from ev"""
    q["quarantine_rows"] = f"""
select sha as event_id, {INGESTED} as ingestion_timestamp,
  value_text as value, 'Invalid period value: ' || period_text as error
from ids where period is null"""

    # bronze
    q["parse_envelope"] = """
select event_id, dataset, source, event_timestamp, ingestion_timestamp, kafka_topic,
  kafka_partition, kafka_offset, kafka_timestamp, event_ts, ingestion_ts,
  cast(event_date as varchar) as event_date, dataset_partition, event_year, event_month,
  event_day, event_hour, respondent from batch"""
    q["next_offsets"] = """
select 'feed_region_data' as topic, kafka_partition as partition,
  max(kafka_offset) + 1 as next_offset from ev group by kafka_partition"""
    q["duplicate_count"] = """
select count(*) - count(distinct event_id) as duplicate_count from batch"""
    place = "event_id, event_ts, kafka_partition, kafka_offset"
    parts = "dataset_partition, event_year, event_month, event_day, event_hour"
    q["dedupe_batch"] = f"select {place} from firsts"
    q["touched_partitions"] = f"select distinct {parts} from batch"
    q["replay_safe_batch"] = f"select {place} from fresh"
    q["write_plan"] = f"""
select (select count(*) from batch) as transformed_count,
  (select count(*) from batch) - (select count(*) from fresh) as duplicate_count,
  (select count(*) from fresh) as write_count,
  (select count(*) from (select distinct {parts} from firsts)) as touched_partition_count"""
    q["quarantined_messages"] = """
select 'feed_region_data' as kafka_topic, kafka_partition, kafka_offset from ev
where event_id % 43 = 0 or period is null"""

    # coverage
    q["hourly_counts"] = "select * from counts"
    q["modal_count"] = "select * from usual"
    q["hour_spine"] = "select * from spine"
    q["hourly_coverage"] = "select * from covered"
    q["coverage_from_state"] = "select * from covered"
    q["coverage_summary"] = """
select dataset_id, status, count(*) as hour_count, min(hour_start_utc) as min_hour_start_utc,
  max(hour_start_utc) as max_hour_start_utc from covered group by 1, 2"""
    q["repair_windows"] = f"""
select dataset_id, hour_start_utc, hour_start_utc + interval 1 hour as hour_end_utc,
  status as coverage_status
from (select * from covered where status in ('missing', 'partial')
  and hour_start_utc < {ts(BOUNDARY)} order by hour_start_utc limit 48)
where hour_start_utc not in (select date_trunc('hour', ts) from events
  where event_type = 'error' and event_id % 2 = 0)"""
    q["repair_windows_all"] = f"""
select dataset_id, hour_start_utc, hour_start_utc + interval 1 hour as hour_end_utc,
  status as coverage_status
from covered where status in ('missing', 'partial') and hour_start_utc < {ts(BOUNDARY)}
  and hour_start_utc not in (select date_trunc('hour', ts) from events
    where event_type = 'error' and event_id % 2 = 0)"""

    # silver
    q["clean_region"] = f"select {shown(REGION_COLS)} from silver_region"
    q["clean_fuel"] = f"select {shown(FUEL_COLS)} from silver_fuel"
    q["clean_power"] = f"select {shown(POWER_COLS)} from silver_power"
    q["latest_by_event"] = f"""
select {shown(c for c in FUEL_COLS if c != 'event_date')}
from ({newest('extract_fuel', 'event_id', BY_EVENT)})"""
    q["retention_ratio"] = " union all ".join(
        f"""
select '{spec.dataset}' as dataset, s as source_events, c as cleaned_rows,
  {six('c / s', 'retention_ratio')}, c / s >= 0.8 as ok
from (select (select count(distinct event_id) from extract_{name}) as s,
  (select count(*) from silver_{name}) as c)"""
        for name, spec in (("region", region), ("fuel", fuel), ("power", power))
    )

    # quality
    not_null_region = ",".join(("event_id", *region.required, "event_date"))
    not_null_power = ",".join(("event_id", *power.required, "event_date"))
    key_power = ",".join(power.business_key)
    bad_unit = "cast(event_id as bigint) % 71 = 0"
    versions = "period, respondent, respondent_name, type, type_name, value, value_units"
    q["quality_report"] = " union all ".join(
        [
            report(
                "region_raw",
                "non_empty",
                "case when count(*) = 0 then 1 else 0 end",
                "extract_region",
            ),
            report(
                "region_raw",
                "not_null(period,value)",
                violations_of("period is null or value is null"),
                "extract_region",
            ),
            report(
                "region_raw",
                "bounds(value >= 0.0 and <= 100.0)",
                violations_of("value < 0 or value > 100"),
                "extract_region",
            ),
            report(
                "region_raw",
                f"consistent(event_id: {versions.replace(' ', '')})",
                conflicts("extract_region", "event_id", versions),
                "(select 1)",
            ),
            report(
                "region",
                f"not_null({not_null_region})",
                violations_of(" or ".join(f"{c} is null" for c in not_null_region.split(","))),
                "silver_region",
            ),
            report(
                "region", "allowed(type)", violations_of("type not in ('D', 'DF')"), "silver_region"
            ),
            report("region", "allowed(value_units)", violations_of(bad_unit), "silver_region"),
            report("region", "unique(event_id)", repeats("event_id"), "silver_region"),
            report(
                "power",
                f"not_null({not_null_power})",
                violations_of(" or ".join(f"{c} is null" for c in not_null_power.split(","))),
                "silver_power",
            ),
            *[
                report(
                    "power",
                    f"allowed({f.column})",
                    violations_of(f"{f.column} not in ({texts(f.allowed)})"),
                    "silver_power",
                )
                for f in power.fields
                if f.allowed
            ],
            report("power", "unique(event_id)", repeats("event_id"), "silver_power"),
            report(
                "power",
                "non_negative(generation_thousand_mwh,ash_content_pct)",
                violations_of("generation_thousand_mwh < 0 or ash_content_pct < 0"),
                "silver_power",
            ),
            report(
                "power",
                f"unique({key_power})",
                f"(select count(*) from silver_power) - (select count(*) from"
                f" (select distinct {key_power} from silver_power))",
                "(select 1)",
            ),
        ]
    )
    q["duplicate_keys"] = """
select period, respondent, type, count(*) as rows from silver_region
group by 1, 2, 3 having count(*) > 1"""
    q["conflicting_keys"] = """
select period, respondent, type, count(*) as rows from silver_region
group by 1, 2, 3 having count(distinct (value, respondent_name)) > 1"""
    q["min_rows_check"] = f"""
select count(*) as row_count, 100 as min_rows, count(*) >= 100 as ok
from gold_region where {RECENT}"""
    q["distinct_check"] = f"""
select count(distinct respondent) as distinct_count, 7 as min_distinct,
  count(distinct respondent) >= 7 as ok from gold_region where {RECENT}"""
    q["bounds_check"] = f"""
select count(*) as row_count, {violations_of('forecast_error_pct < -50 or forecast_error_pct > 50')}
  as invalid_count,
  {violations_of('forecast_error_pct < -50 or forecast_error_pct > 50')} = 0 as ok
from gold_region where {RECENT}"""
    planning_days = "date >= timestamp '2024-01-31 00:00:00' - interval 35 day"

    def published(table: str, source: str, where: str, entity: str, *bounds) -> list[str]:
        """The rules on a published mart, named as the engine names them."""
        rows, entities = "count(*)", f"count(distinct {entity})"
        return [
            report(table, f"min_rows(1) where {where}", short_of(1, rows, True), source),
            report(
                table,
                f"min_distinct({entity} 1) where {where}",
                short_of(1, entities, True),
                source,
            ),
            *[
                report(
                    table,
                    f"bounds({column} >= 0.0{' and <= 100.0' if high else ''}) where {where}",
                    violations_of(f"{column} < 0{f' or {column} > 100' if high else ''}"),
                    source,
                )
                for column, high in bounds
            ],
        ]

    as_of = "TIMESTAMP '2024-01-31 00:00:00'"
    built = f"source_window_start = TIMESTAMP '2024-01-01 00:00:00' AND source_window_end = {as_of}"
    q["mart_checks"] = " union all ".join(
        published(
            "grid_operations_hourly",
            f"status where {RECENT}",
            f"period >= {as_of} - INTERVAL 14 DAYS",
            "respondent",
            ("coverage_ratio", False),
            ("renewable_share_pct", True),
        )
        + published(
            "resource_planning_daily",
            f"planning where {planning_days}",
            f"date >= {as_of} - INTERVAL 35 DAYS",
            "respondent",
            ("renewable_share_pct", True),
            ("carbon_intensity_kg_per_mwh", False),
        )
        + published(
            "region_demand_daily", "region_days", built, "respondent", ("daily_demand_mwh", False)
        )
        + published(
            "electric_power_operations_monthly",
            "power_rows",
            built,
            "fueltype_id",
            ("generation_share_pct", True),
        )
    )
    share = "renewable_share_pct"
    outside = f"({share} < 10 or {share} > 20)"
    grid, key = "grid_operations_hourly", "period, respondent, type"
    q["broken_rules"] = " union all ".join(
        [
            report(
                grid,
                "min_rows(1000000) where respondent = 'PJM'",
                short_of(1_000_000, "count(*) filter (where respondent = 'PJM')"),
                "status",
            ),
            report(
                grid,
                "min_rows(1000000) where respondent = 'none'",
                short_of(1_000_000, "count(*) filter (where respondent = 'none')", True),
                "status",
            ),
            report(
                grid, "min_distinct(respondent 99)", short_of(99, "count(distinct respondent)"), "status"
            ),
            report(
                grid,
                "min_distinct(respondent 99) where coverage_ratio < -1",
                short_of(99, "count(distinct respondent) filter (where coverage_ratio < -1)", True),
                "status",
            ),
            *[
                report(
                    grid,
                    f"bounds({share} >= 10.0 and <= 20.0) where respondent {sign} 'PJM'",
                    violations_of(f"respondent {sign} 'PJM' and {outside}"),
                    "status",
                )
                for sign in ("=", "<>")
            ],
            report(
                grid,
                f"bounds({share} <= 20.0) where respondent = 'PJM'",
                violations_of(f"respondent = 'PJM' and {share} > 20"),
                "status",
            ),
            report(
                grid,
                "non_negative(forecast_error_mwh)",
                violations_of("forecast_error_mwh < 0"),
                "status",
            ),
            report(grid, "unique(respondent)", repeats("respondent"), "status"),
            report("region", "not_null(event_id)", violations_of("event_id is null"), "silver_region"),
            report("region", "allowed(type)", violations_of("type <> 'D'"), "silver_region"),
            *[
                report(
                    "region",
                    f"consistent({key.replace(' ', '')}: {columns.replace(' ', '')})",
                    conflicts("silver_region", key, columns),
                    "(select 1)",
                )
                for columns in ("respondent_name", "value", "value, loaded_at")
            ],
            report("region", f"unique({key.replace(' ', '')})", repeats(key), "silver_region"),
            report(
                "nothing",
                "non_empty",
                "case when count(*) = 0 then 1 else 0 end",
                "silver_region where false",
            ),
        ]
    )

    # gold
    q["latest_by_key"] = f"select {shown(REGION_COLS)} from latest_region"
    q["region_hourly"] = f"select {shown(S.GOLD_REGION.names)} from gold_region"
    q["join_full_outer"] = q["region_hourly"]
    q["fuel_hourly"] = f"select {shown(S.GOLD_FUEL.names)} from gold_fuel"
    q["power_monthly"] = f"select {shown(S.GOLD_POWER.names)} from gold_power"
    old, new = f"event_date < date '{MID}'", f"event_date >= date '{MID}'"
    seen = "respondent, respondent_name, event_date"
    dim_cols = "respondent, respondent_name, first_seen_date, last_seen_date"
    all_region = (
        f"select {seen}, 'r' as source from silver_region"
    )
    prior_fuel = f"select {seen}, 'f' as source from silver_fuel where {old}"
    newer_fuel = f"select {seen}, 'f' as source from silver_fuel where {new}"
    q["dim_respondent"] = f"""
select {shown(dim_cols.split(', '))}, source_dataset_count
from ({dimension(f'{all_region} union all {prior_fuel}')})
union all
select 'fuel:' || respondent, {shown(dim_cols.split(', ')[1:])}, source_dataset_count
from ({dimension(newer_fuel)})"""
    q["dim_fuel_type"] = f"""
select fueltype,
  coalesce(max_by(fueltype_name, (event_date, fueltype_name)) filter (where {old}),
    max_by(fueltype_name, (event_date, fueltype_name))) as fueltype_name,
  max(fuel_category) as fuel_category,
  {six('max(emissions_factor_kg_per_mwh)', 'emissions_factor_kg_per_mwh')}
from (select s.*, d.fuel_category, d.emissions_factor_kg_per_mwh
  from silver_fuel s join dim_fuel d on s.fueltype = d.fueltype) group by fueltype"""

    # platinum
    q["region_daily"] = f"""
select {shown(S.REGION_DAILY.names)} from ({daily(f'select * from gold_region where {IN_WINDOW}')})"""
    mix_cols = ["total_generation_mwh", "renewable_generation_mwh", "fossil_generation_mwh"]
    q["fuel_mix_hourly"] = f"""
select period, respondent, fuel_respondent_name,
  {shown([*mix_cols, 'gas_generation_mwh'])} from fuel_mix"""
    q["demand_ramp"] = f"""
select {shown(['period', 'respondent', 'actual_demand_mwh', 'demand_ramp_mwh'])} from measured"""
    q["zscores"] = f"""
select period, respondent, {six(score('actual_demand_mwh'), 'demand_zscore')},
  {six(score('forecast_error_mwh'), 'forecast_error_zscore')} from gold_region"""
    q["grid_status"] = f"select {shown(S.GRID_STATUS.names)} from status"
    q["grid_alerts"] = f"select {shown(S.GRID_ALERTS.names)} from alerts"
    q["alerts_union"] = q["grid_alerts"]
    late = {
        "status": ("day_status", "period", ("demand_zscore", "forecast_error_zscore",
                   "demand_ramp_zscore", "coverage_ratio", "alert_count")),
        "planning": ("planning", "date", ("daily_demand_mwh", CARBON, GAS)),
        "daily": (f"({daily('gold_region')})", "date", ("daily_demand_mwh", "peak_hourly_demand_mwh")),
    }
    q["late_rows_propagated"] = " union all ".join(
        [
            f"select '{name}' as mart, cast({time} as varchar) as time, respondent,"
            f" '{metric}' as metric, {six(metric, 'value')} from {source}"
            for name, (source, time, metrics) in late.items()
            for metric in metrics
        ]
        + ["select 'alerts', cast(period as varchar), respondent, alert_type,"
           f" {six('metric_value', 'value')} from day_alerts"]
    )
    q["zscores_from_moments"] = f"""
select period, respondent, {six(score('actual_demand_mwh'), 'demand_zscore')},
  {six(score('forecast_error_mwh'), 'forecast_error_zscore')} from gold_region"""
    q["planning_daily"] = f"select {shown(S.PLANNING_DAILY.names)} from planning"
    q["fuel_diversity"] = f"select {shown(['date', 'respondent', DIV])} from diversity"
    q["carbon_intensity"] = f"""
select {shown(['date', 'respondent'])}, {six('emissions_kg', 'emissions_kg')},
  {six('case when total_generation_mwh > 0 then emissions_kg / total_generation_mwh end', CARBON)}
from fuel_days"""
    q["peak_hour_gas"] = f"select {shown(['date', 'respondent', 'peak_period', GAS])} from peaks"
    q["power_mart"] = f"""
select {shown(S.POWER_MONTHLY.names)} from power_rows
where period >= source_window_start and period < source_window_end"""
    q["lookback_window"] = f"""
select {shown(S.GOLD_REGION.names)} from gold_region where {RECENT} and period < {ts(AS_OF)}"""
    q["window_filter"] = f"select {shown(S.GOLD_FUEL.names)} from gold_fuel where {IN_WINDOW}"

    # serving
    inclusive = f"period >= {ts(WINDOW[0])} and period <= {ts(WINDOW[1])}"
    q["history_slice"] = f"""
select {shown(S.GRID_STATUS.names)} from status
where {inclusive} and respondent in ('PJM', 'MISO', 'NYIS')"""
    q["latest_snapshot"] = f"""
select {shown(S.GRID_STATUS.names)} from status
where period = (select max(period) from status where {inclusive})"""
    watch_cols = [
        "period",
        "respondent",
        "respondent_name",
        "actual_demand_mwh",
        "forecast_error_mwh",
        "forecast_error_zscore",
        "demand_ramp_zscore",
        "coverage_ratio",
        "active_alert_count",
        "has_high_alert",
        "has_medium_alert",
    ]
    q["grid_watchlist"] = f"select {shown(watch_cols)} from watch"
    q["table_coverage"] = """
select min(period) as min_period, max(period) as max_period, count(*) as row_count,
  count(distinct respondent) as respondent_count from status"""
    q["list_entities"] = "select distinct respondent from gold_region"
    jobs = case({"F": "failed", "O": "completed", "P": "pending"}, "o_orderstatus")
    q["status_rollup"] = f"""
select list_extract([{texts((S.REGION, S.FUEL, S.POWER))}], cast(o_custkey % 3 as int) + 1)
  as dataset_id, {jobs} as status, count(*) as job_count, min(o_orderdate) as min_chunk_start_utc,
  max(o_orderdate + interval 1 day) as max_chunk_end_utc,
  max(o_orderdate + to_hours(cast(o_orderkey % 24 as int))) as last_update
from orders group by 1, 2"""
    q["table_counts"] = """
select 'platinum.region_demand_daily' as target_name, count(*) as row_count from region_days
union all select 'platinum.grid_operations_hourly', count(*) from status
union all select 'platinum.resource_planning_daily', count(*) from planning
union all select 'platinum.electric_power_operations_monthly', count(*) from power_rows"""
    q["latest_run_health"] = f"""
select dag_id, dag_id like '%backfill' as is_paused, state as latest_run_state,
  start_date as latest_run_start, end_date as latest_run_end,
  not (dag_id like '%backfill') and (start_date is null
    or {ts(RUNS_AS_OF)} - start_date > case
      when dag_id = 'electricity_fuel_type_data_incremental' then interval 26 hour
      when ends_with(dag_id, '_backfill') then interval 20 minute
      when ends_with(dag_id, '_incremental') or ends_with(dag_id, '_bronze_hourly_verification')
        or ends_with(dag_id, '_bronze_hourly_repair') or starts_with(dag_id, 'platinum_')
        then interval 2 hour else interval 6 hour end) as is_overdue
from ({newest('runs', 'dag_id', 'coalesce(start_date, execution_date) desc, run_id desc')})
where {OWN}"""
    q["recent_runs"] = f"""
select dag_id, run_id, state, queued_at, start_date, end_date from runs where {OWN}
order by coalesce(start_date, queued_at, execution_date) desc, run_id desc limit 20"""
    q["recent_failures"] = f"""
select dag_id, task_id, run_id, state, start_date, end_date from runs
where state = 'failed' and {OWN}
order by coalesce(end_date, start_date) desc nulls last, run_id desc, task_id limit 20"""

    # analytics
    q["grid_priority"] = f"""
select period, respondent, active_alert_count, {GRID_LABEL} as priority_label from watch_hours"""
    q["priority_ranked"] = f"""
select *, case priority_label when 'Critical' then 0 when 'Elevated' then 1 else 2 end
  as priority_rank
from (select {shown(watch_cols)}, {GRID_LABEL} as priority_label from watch)"""
    q["kpi_strip"] = f"""
select count(distinct respondent) as respondents,
  count(*) filter (where active_alert_count > 0) as in_alert,
  count(*) filter (where {GRID_LABEL} = 'Critical') as critical,
  {six('min(coverage_ratio)', 'lowest_coverage')},
  (select count(*) from alerts where severity = 'high') as high_severity from watch_hours"""
    q["planning_kpis"] = f"""
select count(distinct respondent) as respondents,
  count(*) filter (where label = 'Critical') as critical,
  count(*) filter (where label = 'Elevated') as elevated,
  {six('max(' + CARBON + ')', 'highest_carbon')}, {six('min(' + REN + ')', 'lowest_renewable')}
from (select p.*, {PLANNING_LABEL} as label from planning p, snapshot_limits)"""

    def top(name: str, table: str, entity: str, column: str, order: str) -> str:
        return f"""
select * from (select '{name}' as ranking, {entity} as respondent, {six(column, 'value')}
  from {table} where {column} is not null order by {order}, 2 limit 10)"""

    hour = "respondent || ' ' || strftime(period, '%Y-%m-%d %H')"
    q["top_misses"] = " union all ".join(
        (
            top("forecast_miss", "status", hour, "forecast_error_mwh",
                "abs(forecast_error_mwh) desc"),
            top("lowest_coverage", "status", hour, "coverage_ratio", "coverage_ratio"),
        )
    )
    day = "respondent || ' ' || cast(date as varchar)"
    q["planning_rankings"] = " union all ".join(
        top(name, "planning", day, column, f"{column} {direction}")
        for name, column, direction in (
            ("highest_carbon", CARBON, "desc"),
            ("lowest_renewable", REN, "asc"),
            ("highest_peak_gas", GAS, "desc"),
            ("lowest_diversity", DIV, "asc"),
        )
    )
    q["alert_volume"] = """
select cast(cast((period at time zone 'UTC') at time zone 'America/New_York' as date) as varchar)
  as alert_day, severity, count(*) as count from alerts group by 1, 2"""
    q["series_long"] = " union all ".join(
        f"""select period, respondent, '{label}' as series, {six(column, 'value')}
from status where {column} is not null"""
        for column, label in SERIES_LABELS.items()
    )

    def limits(wanted, table: str) -> str:
        return f"select {', '.join(six(n, n) for n in wanted)} from {table}"

    q["planning_thresholds"] = limits(PLANNING_QUANTILES, "snapshot_limits")
    q["history_thresholds"] = limits(PLANNING_QUANTILES, "limits")
    q["planning_priority"] = """
select cast(date as varchar) as date, respondent, planning_priority from labelled"""
    q["planning_priority_all_days"] = """
select cast(date as varchar) as date, respondent, planning_priority from labelled_by_all"""
    q["planning_driver"] = """
select cast(date as varchar) as date, respondent, primary_driver from labelled"""
    q["planning_ranked"] = f"""
select {shown(S.PLANNING_DAILY.names)}, label as planning_priority, driver as primary_driver,
  case label when 'Critical' then 0 when 'Elevated' then 1 else 2 end as priority_rank
from (select p.*, {PLANNING_LABEL} as label, {DRIVER_LABEL} as driver
  from snapshot p, snapshot_limits)"""
    labels = texts(S.PRIORITIES)
    q["priority_history"] = f"""
select cast(d.date as varchar) as date, p.label as planning_priority,
  count(distinct l.respondent) as respondent_count
from (select distinct date from labelled) d cross join (select unnest([{labels}]) as label) p
left join labelled l on l.date = d.date and l.planning_priority = p.label group by 1, 2"""
    q["priority_distribution"] = f"""
select p.label as planning_priority, count(l.respondent) as count
from (select unnest([{labels}]) as label) p
left join labelled l on l.planning_priority = p.label group by 1"""
    q["strategy_priority"] = f"""
select cast(date as varchar) as date, respondent, {STRATEGY_LABEL} as strategy_priority
from snapshot, snapshot_strategy_limits"""
    q["strategy_priority_all_days"] = f"""
select cast(date as varchar) as date, respondent, {STRATEGY_LABEL} as strategy_priority
from planning, strategy_limits"""
    score_cols = ["carbon", "renewable", "gas", "clean", "diversity"]
    score_list = ", ".join(six(f"score_{c}", f"score_{c}") for c in score_cols)
    q["minmax_scores"] = f"""
select cast(date as varchar) as date, respondent, {score_list} from snapshot_scores"""
    q["minmax_scores_all_days"] = f"""
select cast(date as varchar) as date, respondent, {score_list} from scores"""
    q["health_score"] = f"""
select cast(date as varchar) as date, respondent,
  {six('strategic_health_score', 'strategic_health_score')} from health"""
    q["strategy_watchlist"] = f"""
select respondent, strategy_priority, case strategy_priority when 'Critical' then 0
  when 'Elevated' then 1 else 2 end as priority_rank, {six(HEALTH, 'strategic_health_score')},
  {score_list}
from (select s.*, {STRATEGY_LABEL} as strategy_priority
  from snapshot_scores s, snapshot_strategy_limits)"""
    q["strategy_kpis"] = f"""
select cast(max(date) as varchar) as latest_date, count(distinct respondent) as respondents,
  {six('max(' + CARBON + ')', 'highest_carbon')}, {six('min(' + REN + ')', 'lowest_renewable')},
  {six('avg(strategic_health_score)', 'average_health')} from health"""
    all_scores = " union all ".join(
        f"select score_{c} as v from scores where score_{c} is not null" for c in score_cols
    )
    flat = " || ".join(
        f"(case when (select count(distinct score_{c}) from scores) <= 1"
        f" then ',score_{c}' else '' end)"
        for c in score_cols
    )
    q["score_range"] = f"""
select {six('case when lo = hi then greatest(0.0, lo - 1.0) else lo end', 'zmin')},
  {six('case when lo = hi then least(100.0, hi + 1.0) else hi end', 'zmax')},
  ltrim({flat}, ',') as flat_scores,
  (select round(median({REN}), 6) + 0.0 from scores) as renewable_median,
  (select round(median({CARBON}), 6) + 0.0 from scores) as carbon_median
from (select quantile_cont(v, 0.05) as lo, quantile_cont(v, 0.95) as hi from ({all_scores}))"""
    delta_cols, dir_cols = texts((CARBON, REN, GAS, CLEAN)), texts((CARBON, REN, GAS, FERR))
    better = f"case when metric in ('{REN}', '{CLEAN}') then delta > 0 else delta < 0 end"
    q["trend_delta"] = f"""
select respondent, metric, case when n < 2 then 'Insufficient trend history'
  when abs(delta) <= greatest(abs(mean) * 0.01, 0.01) then 'Stable'
  when {better} then 'Improving' else 'Worsening' end as trend,
  {six('case when n >= 2 then delta end', 'delta')}
from trends where metric in ({delta_cols})"""
    q["trend_direction"] = f"""
select respondent, metric, case when n < 2 then 'Not enough history in the selected window.'
  when abs(delta) <= greatest(std * 0.25, abs(first) * 0.03, 0.5)
    then 'Flat across the selected window.'
  when {better} then 'Improving across the selected window.'
  else 'Worsening across the selected window.' end as trend
from trends where metric in ({dir_cols})"""
    q["weekday_drift"] = f"""
select respondent, case when weekend_flag then 'Weekend' else 'Weekday' end as day_type,
  {six('avg(daily_demand_mwh)', 'avg_daily_demand_mwh')} from planning group by 1, 2"""
    places = ", ".join(f"('{c}', {lat}, {lon}, '{name}')" for c, lat, lon, name in COORDINATES)
    q["geo_enriched"] = f"""
select period, s.respondent, location_label, {six('cast(lat as double)', 'lat')},
  {six('cast(lon as double)', 'lon')}, {shown(['actual_demand_mwh', 'coverage_ratio'])}
from status s join (values {places}) g(respondent, lat, lon, location_label)
  on s.respondent = g.respondent where actual_demand_mwh is not null"""
    q["default_range"] = """
select cast(greatest(cast(max(event_date) - interval 14 day as date), min(event_date)) as varchar)
  as start_date, cast(max(event_date) as varchar) as end_date from gold_region"""
    q["latest_non_null"] = """
select max(period) as period from gold_region
where forecast_error_mwh is not null or forecast_error_pct is not null"""

    # reconciliation
    region_key = grain("period", "respondent", "type")
    hour_key = grain("period", "respondent", "''")
    power_key = grain("period", "location", "sector_id || '|' || fueltype_id")
    daily_mart, power_name = (
        "platinum.region_demand_daily",
        "platinum.electric_power_operations_monthly",
    )
    q["grain_keys"] = f"""
select 'bronze region' as stage, {grain('event_ts', 'respondent', 'type')} from batch
union all select 'silver power', {power_key} from silver_power
union all select 'gold region', {hour_key} from gold_region
union all select 'gold fuel', {FUEL_KEY} from gold_fuel"""
    usable = "extract_region where period is not null and value is not null"
    events = (
        f"(select event_id, max(period) as period, max(respondent) as respondent,"
        f" max(type) as type from {usable} group by event_id)"
    )
    region_silver = f"select {region_key} from {events}"
    region_gold = f"select {hour_key} from (select distinct period, respondent from {usable})"
    region_daily_keys = f"""select {hour_key} from (
  select distinct date_trunc('day', period) as period, respondent from {usable} and type = 'D')"""
    power_keys = "period, location, sector_id, fueltype_id"
    power_gold = f"""select {power_key} from (
  select distinct {power_keys} from extract_power where sector_name is not null)"""
    q["expected_keys"] = f"""
select 'bronze' as stage, {grain('period', 'respondent_text', 'type')}
from ev where period is not null
union all select 'silver' as stage, * from ({region_silver})
union all select 'gold' as stage, * from ({region_gold})
union all select '{daily_mart}' as stage, * from ({region_daily_keys})
union all select '{power_name}' as stage, * from ({power_gold})"""
    q["reconcile_diff"] = """
select grain_key, period_start_utc, respondent, dimension_value,
  case when actual_rows = 0 then 'missing' else 'extra' end as reason
from matched where actual_rows = 0 or expected_rows = 0"""
    q["reconcile_digests"] = q["reconcile_diff"]
    q["reconcile_by_period"] = f"select period_start_utc, {TOTALS} from matched group by 1"
    q["reconcile_summary"] = f"""
select 'silver' as stage, '{S.FUEL}' as dataset_id, {STATUS}, expected_count, actual_count,
  missing_count, extra_count from (select {TOTALS} from matched)"""
    fuel_usable = "extract_fuel where period is not null and value is not null"
    fuel_silver = f"""select {FUEL_KEY} from (select event_id, max(period) as period,
  max(respondent) as respondent, max(fueltype) as fueltype from {fuel_usable} group by event_id)"""
    fuel_gold = f"""select {FUEL_KEY} from (
  select distinct period, respondent, fueltype from {fuel_usable})"""
    q["reconcile_snapshot"] = " union all ".join(
        (
            compared("silver", S.REGION, region_silver, f"select {region_key} from silver_region"),
            compared("gold", S.REGION, region_gold, f"select {hour_key} from gold_region"),
            compared("silver", S.FUEL, fuel_silver, f"select {FUEL_KEY} from silver_fuel"),
            compared("gold", S.FUEL, fuel_gold, f"select {FUEL_KEY} from gold_fuel"),
            compared(
                "silver",
                S.POWER,
                f"""select {power_key} from (select event_id, max(period) as period,
  max(location) as location, max(sector_id) as sector_id, max(fueltype_id) as fueltype_id
  from extract_power where period is not null and location is not null and sector_id is not null
  and fueltype_id is not null and sector_name is not null and fueltype_name is not null
  and location_name is not null group by event_id)""",
                f"select {power_key} from silver_power",
            ),
            compared("gold", S.POWER, power_gold, f"select {power_key} from gold_power"),
            compared(
                "platinum",
                daily_mart,
                region_daily_keys,
                f"select {grain('date', 'respondent', chr(39) * 2)} from region_days",
            ),
            compared("platinum", power_name, power_gold, f"select {power_key} from power_rows"),
        )
    )

    # tables and streams
    q["ingest_available_now"] = """
select distinct event_id, event_ts, event_year, event_hour from batch"""
    q["ingest_replay_window"] = q["ingest_available_now"]
    q["bronze_append"] = f"select {parts}, count(*) as rows from firsts group by all"
    q["read_window"] = q["window_filter"]
    first_half = newest(
        f"({half('silver_region', True)})", "period, respondent, type", VERSION
    )
    second_half = newest(
        f"({half('silver_region', False)})", "period, respondent, type", VERSION
    )
    q["overwrite_partitions"] = f"""
select {shown(S.GOLD_REGION.names)} from ({region_fact(first_half)}) where {old}
union all select {shown(S.GOLD_REGION.names)} from gold_region where {new}"""
    q["merge_partitions"] = q["latest_by_key"]
    region_cols = shown(S.REGION_SPEC.schema.names)
    q["read_version"] = f"""
select {region_cols}, 'opened' as state from ({first_half})
union all select {region_cols}, 'first' from ({first_half})
union all select *, 'second' from ({q["latest_by_key"]})"""
    q["merge_latest"] = f"select {shown(FUEL_COLS)} from latest_fuel"
    early = "minute(loaded_at) < 30"
    shown_fuel = shown(FUEL_COLS).replace(
        "respondent_name,", f"case when not ({early}) then respondent_name end as respondent_name,"
    ).replace(
        "fueltype_name,", f"case when not ({early}) then fueltype_name end as fueltype_name,"
    )
    q["union_missing_columns"] = f"select {shown_fuel} from latest_fuel"
    q["write_dimension"] = f"""
select {shown(dim_cols.split(', '))}, source_dataset_count from ({dimension(all_region)})"""
    target = f"({daily(f'select * from ({region_fact(first_half)}) where {IN_WINDOW}')})"
    late = f"{new} and {IN_WINDOW}"
    stage = f"({daily(f'select * from ({region_fact(second_half)}) where {late}')})"
    both = f"{target} t full join {stage} s on t.date = s.date and t.respondent = s.respondent"

    def upserted(peak: str) -> str:
        picked = {
            "date": "coalesce(s.date, t.date)",
            "respondent": "coalesce(s.respondent, t.respondent)",
            "peak_hourly_demand_mwh": peak,
            "source_window_start": ts(WINDOW[0]),
            "source_window_end": ts(WINDOW[1]),
        }
        inner = ", ".join(
            f"{picked.get(c, f'case when s.date is not null then s.{c} else t.{c} end')} as {c}"
            for c in S.REGION_DAILY.names
            if c != "updated_at"
        )
        return f"select {shown(S.REGION_DAILY.names)} from (select {inner} from {both})"

    q["upsert_stage"] = upserted("coalesce(t.peak_hourly_demand_mwh, s.peak_hourly_demand_mwh)")
    q["upsert_table"] = upserted("coalesce(s.peak_hourly_demand_mwh, t.peak_hourly_demand_mwh)")
    meta = (
        f'"metadata":{{"frequency":"hourly","route":"{region.route}","respondent":',
        f',"ingestion_run_id":"{RUN_ID}","source_window_start":"{FEED_WINDOW[0]}",'
        f'"source_window_end":"{FEED_WINDOW[1]}"}},"payload":',
    )
    q["publish_records"] = f"""
select sha as key, '{{"event_id":"' || sha || '","dataset":"{S.REGION}","source":"eia_api_v2",'
  || '"event_timestamp":"' || strftime(period, '%Y-%m-%dT%H:%M:%S+00:00')
  || '","ingestion_timestamp":"' || {INGESTED} || '",'
  || '{meta[0]}' || {jtext('respondent_text')} || '{meta[1]}' || {region_json()} || '}}' as value
from ids where period is not null"""
    extract = [
        "date",
        "respondent",
        "respondent_name",
        "daily_demand_mwh",
        REN,
        CARBON,
        DIV,
        GAS,
        FERR,
        CLEAN,
    ]
    q["export_csv"] = f"select {shown(extract)} from planning where respondent = '{FOCUS}'"
    q["discrepancy_export"] = q["reconcile_diff"]
    kinds = ("click", "error", "purchase", "signup", "view")
    q["event_quantiles"] = "select " + ", ".join(
        six(f"quantile_cont(value, {p / 100}) filter (where event_type = '{kind}')", f"{kind}_p{p}")
        for kind in kinds
        for p in (25, 50, 99)
    ) + " from events"
    q["merge_null_partition"] = f"""
select event_id, case when respondent <> '{FOCUS}' then cast(event_date as varchar) end as event_date
from silver_region"""
    q["read_absent"] = """
select 0 as rows, 'absent' as state union all select count(*), 'present' from gold_region"""
    q["read_merged_schema"] = """
select event_id, case when minute(loaded_at) >= 30 then fueltype_name end as fueltype_name,
  case when minute(loaded_at) < 30 then 1 else 2 end as half from silver_fuel"""
    q["table_has_rows"] = """
select 'absent' as name, false as has_rows
union all select 'empty', count(*) > 0 from gold_region where respondent = 'none'
union all select 'full', count(*) > 0 from gold_region"""
    # messages of every 43rd event are broken
    q["validate_only"] = """
select count(*) as checked, 0 as published from silver_fuel where cast(event_id as bigint) % 43 <> 0"""
    several = "respondent in ('PJM', 'MISO', 'NYIS')"
    q["alert_history"] = f"""
select {shown(S.GRID_ALERTS.names)} from alerts where {inclusive} and {several}"""
    q["planning_history"] = f"""
select {shown(S.PLANNING_DAILY.names)} from planning
where date >= date '2024-01-05' and date <= date '2024-01-20' and {several}"""
    return q


def oracle_sql() -> dict[str, str]:
    return {name: sql(text) for name, text in _queries().items()}
