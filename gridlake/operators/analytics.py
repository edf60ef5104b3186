"""Decision analytics: thresholds, priorities, scores, trends and rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.operators.stats import (
    exact_quantiles,
    scalar_struct,
    unpivot_values,
    with_scalars,
)
from gridlake.schemas import COVERAGE_HIGH, PRIORITIES, Z_ALERT

# --- fixed values: columns, quantiles, labels, weights and tolerances ----------

CARBON = "carbon_intensity_kg_per_mwh"
GAS_PEAK = "peak_hour_gas_share_pct"
RENEWABLE = "renewable_share_pct"
CLEAN = "clean_coverage_ratio"
DIVERSITY = "fuel_diversity_index"
FORECAST_ERROR = "avg_abs_forecast_error_pct"

PLANNING_QUANTILES = {
    "carbon_p90": (CARBON, 0.9),
    "gas_p90": (GAS_PEAK, 0.9),
    "renewable_p10": (RENEWABLE, 0.1),
    "carbon_p75": (CARBON, 0.75),
    "diversity_p25": (DIVERSITY, 0.25),
    "forecast_p75": (FORECAST_ERROR, 0.75),
}
STRATEGY_QUANTILES = {
    "carbon_p90": (CARBON, 0.9),
    "gas_p90": (GAS_PEAK, 0.9),
    "renewable_p10": (RENEWABLE, 0.1),
    "carbon_p75": (CARBON, 0.75),
    "renewable_p25": (RENEWABLE, 0.25),
    "clean_p25": (CLEAN, 0.25),
    "clean_p10": (CLEAN, 0.1),
    "diversity_p10": (DIVERSITY, 0.1),
    "diversity_p25": (DIVERSITY, 0.25),
}
DRIVERS = (
    "High carbon intensity",
    "Gas-dependent peak with weak renewables",
    "Low fuel diversity",
    "Forecast accuracy drift",
    "Within expected range",
)
# score name: (column, larger is better, weight in the health score)
SCORES = {
    "score_carbon": (CARBON, False, 0.25),
    "score_renewable": (RENEWABLE, True, 0.25),
    "score_gas": (GAS_PEAK, False, 0.20),
    "score_clean": (CLEAN, True, 0.20),
    "score_diversity": (DIVERSITY, True, 0.10),
}
FLAT_SCORE = 50.0
# metric: larger is better
STRATEGY_TRENDS = {CARBON: False, RENEWABLE: True, GAS_PEAK: False, CLEAN: True}
PLANNING_TRENDS = {CARBON: False, RENEWABLE: True, GAS_PEAK: False, FORECAST_ERROR: False}
NO_DELTA_HISTORY = "Insufficient trend history"
NO_TREND_HISTORY = "Not enough history in the selected window."
TREND_TEXT = {
    "flat": "Flat across the selected window.",
    "better": "Improving across the selected window.",
    "worse": "Worsening across the selected window.",
}
SERIES_LABELS = {
    "actual_demand_mwh": "Actual demand",
    "day_ahead_forecast_mwh": "Day-ahead forecast",
    "renewable_share_pct": "Renewable %",
    "fossil_share_pct": "Fossil %",
    "gas_share_pct": "Gas %",
}
TOP = 10

# --- priorities ---------------------------------------------------------------


def _first_of(*cases: tuple[str, Column], otherwise: str) -> Column:
    """The label of the first true condition. A null comparison counts as false."""
    chain = F
    for label, condition in cases:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def _any(*conditions: Column) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result


def grid_priority(watchlist: DataFrame) -> DataFrame:
    """Watchlist rows with their priority label."""

    def far(column: str) -> Column:
        return F.abs(F.col(column)) >= Z_ALERT

    critical = _any(F.col("has_high_alert"), F.col("coverage_ratio") < COVERAGE_HIGH)
    elevated = _any(
        F.col("has_medium_alert"), far("forecast_error_zscore"), far("demand_ramp_zscore")
    )
    return watchlist.withColumn(
        "priority_label",
        _first_of(
            (PRIORITIES[0], critical), (PRIORITIES[1], elevated), otherwise=PRIORITIES[2]
        ),
    )


def priority_rank(label: str) -> Column:
    """0, 1, 2 in order of urgency, 99 for anything else."""
    rank = F.lit(99)
    for position, name in enumerate(PRIORITIES):
        rank = F.when(F.col(label) == name, position).otherwise(rank)
    return rank


def ranked(df: DataFrame, label: str, *then: Column) -> DataFrame:
    """Most urgent first, then by ``then``, then by respondent."""
    return df.withColumn("priority_rank", priority_rank(label)).orderBy(
        "priority_rank", *then, "respondent"
    )


def ranked_grid(watchlist: DataFrame) -> DataFrame:
    return ranked(
        grid_priority(watchlist),
        "priority_label",
        F.col("has_high_alert").desc(),
        F.col("active_alert_count").desc(),
        F.col("coverage_ratio").asc_nulls_last(),
    )


def planning_thresholds(snapshot: DataFrame) -> DataFrame:
    """One row of quantiles of the latest snapshot; null where a column has no value."""
    return exact_quantiles(snapshot, PLANNING_QUANTILES)


def _weak_gas_peak(limit: Column) -> Column:
    return (F.col(GAS_PEAK) >= limit["gas_p90"]) & (F.col(RENEWABLE) <= limit["renewable_p10"])


def planning_priority(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    limit = F.col("_limit")
    critical = _any(F.col(CARBON) >= limit["carbon_p90"], _weak_gas_peak(limit))
    elevated = _any(
        F.col(CARBON) >= limit["carbon_p75"],
        F.col(DIVERSITY) <= limit["diversity_p25"],
        F.col(FORECAST_ERROR) >= limit["forecast_p75"],
    )
    label = _first_of(
        (PRIORITIES[0], critical), (PRIORITIES[1], elevated), otherwise=PRIORITIES[2]
    )
    return (
        with_scalars(df, "_limit", thresholds)
        .withColumn("planning_priority", label)
        .drop("_limit")
    )


def planning_driver(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The first reason that applies, in fixed precedence."""
    limit = F.col("_limit")
    reasons = (
        F.col(CARBON) >= limit["carbon_p75"],
        _weak_gas_peak(limit),
        F.col(DIVERSITY) <= limit["diversity_p25"],
        F.col(FORECAST_ERROR) >= limit["forecast_p75"],
    )
    label = _first_of(*zip(DRIVERS, reasons), otherwise=DRIVERS[-1])
    return with_scalars(df, "_limit", thresholds).withColumn("primary_driver", label).drop("_limit")


def ranked_planning(snapshot: DataFrame, thresholds: DataFrame) -> DataFrame:
    labelled = planning_driver(planning_priority(snapshot, thresholds), thresholds)
    return ranked(
        labelled,
        "planning_priority",
        F.col(CARBON).desc_nulls_last(),
        F.col(GAS_PEAK).desc_nulls_last(),
        F.col(RENEWABLE).asc_nulls_last(),
    )


def _per_label(one_per_group: DataFrame, keep: Sequence[str], label: str, count: str) -> DataFrame:
    """Wide counts, one column per priority, to one row per (group, priority)."""
    pairs = [F.struct(F.lit(p).alias(label), F.col(p).alias(count)) for p in PRIORITIES]
    return one_per_group.select(*keep, F.inline(F.array(*pairs)))


def priority_history(planning: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Respondents per date and priority; every date has all three priorities."""
    labelled = planning_priority(planning, thresholds)
    once = labelled.groupBy("date", "respondent").agg(
        *[F.max((F.col("planning_priority") == p).cast("int")).alias(p) for p in PRIORITIES]
    )
    named = F.col("respondent").isNotNull()
    per_date = once.groupBy("date").agg(
        *[F.sum(F.when(named, F.col(p)).otherwise(0)).alias(p) for p in PRIORITIES]
    )
    return _per_label(
        per_date.filter(F.col("date").isNotNull()),
        ["date"],
        "planning_priority",
        "respondent_count",
    )


def strategy_thresholds(snapshot: DataFrame) -> DataFrame:
    return exact_quantiles(snapshot, STRATEGY_QUANTILES)


def strategy_priority(snapshot: DataFrame, thresholds: DataFrame) -> DataFrame:
    limit = F.col("_limit")
    critical = _any(
        F.col(CARBON) >= limit["carbon_p90"],
        _weak_gas_peak(limit),
        (F.col(CLEAN) <= limit["clean_p10"]) & (F.col(DIVERSITY) <= limit["diversity_p10"]),
    )
    elevated = _any(
        F.col(CARBON) >= limit["carbon_p75"],
        F.col(RENEWABLE) <= limit["renewable_p25"],
        F.col(CLEAN) <= limit["clean_p25"],
        F.col(DIVERSITY) <= limit["diversity_p25"],
    )
    label = _first_of(
        (PRIORITIES[0], critical), (PRIORITIES[1], elevated), otherwise=PRIORITIES[2]
    )
    return (
        with_scalars(snapshot, "_limit", thresholds)
        .withColumn("strategy_priority", label)
        .drop("_limit")
    )


def priority_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per priority, all three present."""
    counts = df.agg(*[F.count_if(F.col(label) == p).alias(p) for p in PRIORITIES])
    return _per_label(counts, [], label, "count")


# --- scores -------------------------------------------------------------------


def one_decimal(value: Column) -> Column:
    """To one decimal, ties to the even tenth, judged on the tenfold as a double."""
    return F.rint(value * 10.0) / 10.0


def minmax_scores(snapshot: DataFrame) -> DataFrame:
    """0 to 100 per metric over the snapshot, 100 best; 50 where the metric is flat."""
    ends = snapshot.agg(
        *[
            end(F.col(column)).alias(f"{name}_{suffix}")
            for name, (column, _, _) in SCORES.items()
            for suffix, end in (("lo", F.min), ("hi", F.max))
        ]
    )
    scored = with_scalars(snapshot, "_ends", ends)
    for name, (column, larger_is_better, _) in SCORES.items():
        low, high = F.col(f"_ends.{name}_lo"), F.col(f"_ends.{name}_hi")
        position = one_decimal((F.col(column) - low) / (high - low) * 100.0)
        if not larger_is_better:
            position = one_decimal(100.0 - position)
        scored = scored.withColumn(name, F.when(high > low, position).otherwise(FLAT_SCORE))
    return scored.drop("_ends")


def health_score(scored: DataFrame) -> DataFrame:
    """Weighted mean of the five scores; null if one is null."""
    total = F.lit(0.0)
    for name, (_, _, weight) in SCORES.items():
        total = total + F.col(name) * weight
    return scored.withColumn("strategic_health_score", one_decimal(total))


def strategy_watchlist(snapshot: DataFrame) -> DataFrame:
    """Snapshot with priority, scores and health, weakest first."""
    labelled = strategy_priority(snapshot, strategy_thresholds(snapshot))
    return ranked(
        health_score(minmax_scores(labelled)),
        "strategy_priority",
        F.col("strategic_health_score").asc_nulls_last(),
        F.col(CARBON).desc_nulls_last(),
    )


def score_range(scored: DataFrame) -> DataFrame:
    """One row: colour range of all scores, flat metrics, reference medians.

    Scores have one decimal between 0 and 100, so the exact percentile keeps at
    most 1001 distinct values.
    """
    ends = unpivot_values(scored, list(SCORES)).agg(
        F.percentile("value", F.lit(0.05)).alias("low"),
        F.percentile("value", F.lit(0.95)).alias("high"),
    )
    flat = scored.agg(
        *[(F.min(name).eqNullSafe(F.max(name))).alias(name) for name in SCORES]
    )
    medians = exact_quantiles(
        scored, {"renewable_median": (RENEWABLE, 0.5), "carbon_median": (CARBON, 0.5)}
    )
    same = F.col("low") == F.col("high")
    names = F.array(*[F.when(F.col("_flat")[name], F.lit(name)) for name in SCORES])
    return (
        ends.withColumn("_flat", scalar_struct(flat))
        .withColumn("_medians", scalar_struct(medians))
        .select(
            F.when(same, F.greatest(F.lit(0.0), F.col("low") - 1.0))
            .otherwise(F.col("low"))
            .alias("zmin"),
            F.when(same, F.least(F.lit(100.0), F.col("high") + 1.0))
            .otherwise(F.col("high"))
            .alias("zmax"),
            F.array_join(F.array_compact(names), ",").alias("flat_scores"),
            F.col("_medians.renewable_median").alias("renewable_median"),
            F.col("_medians.carbon_median").alias("carbon_median"),
        )
    )


# --- rankings and figures -----------------------------------------------------


def _top(
    df: DataFrame, ranking: str, column: str, order: Column, shown: Column, top: int
) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .orderBy(order, "respondent")
        .limit(top)
        .select(F.lit(ranking).alias("ranking"), "respondent", shown.alias("value"))
    )


def grid_rankings(snapshot: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` largest forecast misses and lowest coverages."""
    miss, cover = F.col("forecast_error_mwh"), F.col("coverage_ratio")
    return _top(
        snapshot, "forecast_miss", "forecast_error_mwh", F.abs(miss).desc(), miss, top
    ).unionByName(_top(snapshot, "lowest_coverage", "coverage_ratio", cover.asc(), cover, top))


def planning_rankings(snapshot: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` highest carbon and peak gas, lowest renewable share and diversity."""
    rankings = (
        ("highest_carbon", CARBON, F.col(CARBON).desc()),
        ("lowest_renewable", RENEWABLE, F.col(RENEWABLE).asc()),
        ("highest_peak_gas", GAS_PEAK, F.col(GAS_PEAK).desc()),
        ("lowest_diversity", DIVERSITY, F.col(DIVERSITY).asc()),
    )
    parts = [_top(snapshot, name, c, order, F.col(c), top) for name, c, order in rankings]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def grid_kpis(watchlist: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row of headline figures; ``alerts`` are those of the snapshot hour."""
    high = alerts.agg(F.count_if(F.lower("severity") == "high")).scalar()
    return (
        grid_priority(watchlist)
        .agg(
            F.count_distinct("respondent").alias("respondents"),
            F.count_if(F.col("active_alert_count") > 0).alias("in_alert"),
            F.count_if(F.col("priority_label") == PRIORITIES[0]).alias("critical"),
            F.min("coverage_ratio").alias("lowest_coverage"),
        )
        .withColumn("high_severity", high)
    )


def planning_kpis(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count_distinct("respondent").alias("respondents"),
        F.count_if(F.col("planning_priority") == PRIORITIES[0]).alias("critical"),
        F.count_if(F.col("planning_priority") == PRIORITIES[1]).alias("elevated"),
        F.max(CARBON).alias("highest_carbon"),
        F.min(RENEWABLE).alias("lowest_renewable"),
    )


def strategy_kpis(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.max("date").alias("latest_date"),
        F.count_distinct("respondent").alias("respondents"),
        F.max(CARBON).alias("highest_carbon"),
        F.min(RENEWABLE).alias("lowest_renewable"),
        F.avg("strategic_health_score").alias("average_health"),
    )


def zone_or_utc(zone: str) -> str:
    """The zone if it is known, else UTC. Checked once, on the driver."""
    try:
        ZoneInfo(zone)
    except (ZoneInfoNotFoundError, ValueError):
        return "UTC"
    return zone


def alert_volume(alerts: DataFrame, zone: str = "America/New_York") -> DataFrame:
    """Alerts per local day and severity."""
    local = F.from_utc_timestamp("period", zone_or_utc(zone))
    return alerts.groupBy(F.to_date(local).alias("alert_day"), "severity").agg(
        F.count("*").alias("count")
    )


def series_long(df: DataFrame, keep: Sequence[str], labels: Mapping[str, str]) -> DataFrame:
    """Wide measures to labelled long series, nulls left out."""
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return unpivot_values(df, list(labels), keep).select(
        *keep, names[F.col("metric")].alias("series"), "value"
    )


def weekday_drift(planning: DataFrame) -> DataFrame:
    """Mean daily demand per respondent on weekdays and on weekends."""
    day = F.when(F.col("weekend_flag"), "Weekend").otherwise("Weekday")
    return (
        planning.filter(F.col("daily_demand_mwh").isNotNull())
        .groupBy("respondent", day.alias("day_type"))
        .agg(F.avg("daily_demand_mwh").alias("avg_daily_demand_mwh"))
    )


# --- trends -------------------------------------------------------------------


def _trend_ends(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per respondent and metric: first, last, mean, population std, number of values."""
    return (
        unpivot_values(df, metrics, ["respondent", "date"])
        .groupBy("respondent", "metric")
        .agg(
            F.min_by("value", "date").alias("first"),
            F.max_by("value", "date").alias("last"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.count("*").alias("n"),
        )
        .withColumn("delta", F.col("last") - F.col("first"))
    )


def _good_when_larger(metrics: Mapping[str, bool]) -> Column:
    larger = [m for m, good in metrics.items() if good]
    return F.col("metric").isin(*larger)


def trend_delta(df: DataFrame, metrics: Mapping[str, bool] = STRATEGY_TRENDS) -> DataFrame:
    """Direction of each metric, flat within max(1 % of |mean|, 0.01)."""
    ends = _trend_ends(df, list(metrics))
    tolerance = F.greatest(F.abs("mean") * 0.01, F.lit(0.01))
    better = F.when(_good_when_larger(metrics), F.col("delta") > 0).otherwise(F.col("delta") < 0)
    return ends.select(
        "respondent",
        "metric",
        F.when(F.col("n") < 2, NO_DELTA_HISTORY)
        .when(F.abs("delta") <= tolerance, "Stable")
        .when(better, "Improving")
        .otherwise("Worsening")
        .alias("trend"),
        F.when(F.col("n") >= 2, F.col("delta")).alias("delta"),
    )


def trend_direction(df: DataFrame, metrics: Mapping[str, bool] = PLANNING_TRENDS) -> DataFrame:
    """Direction of each metric, flat within max(0.25 std, 3 % of |first|, 0.5)."""
    ends = _trend_ends(df, list(metrics))
    tolerance = F.greatest(F.col("std") * 0.25, F.abs("first") * 0.03, F.lit(0.5))
    better = F.when(_good_when_larger(metrics), F.col("delta") > 0).otherwise(F.col("delta") < 0)
    return ends.select(
        "respondent",
        "metric",
        F.when(F.col("n") < 2, NO_TREND_HISTORY)
        .when(F.abs("delta") <= tolerance, TREND_TEXT["flat"])
        .when(better, TREND_TEXT["better"])
        .otherwise(TREND_TEXT["worse"])
        .alias("trend"),
    )


# --- ranges -------------------------------------------------------------------


def default_range(df: DataFrame, day: str, lookback_days: int) -> DataFrame:
    """One row: the last day and the day ``lookback_days`` before it, not before the first."""
    return df.agg(F.min(day).alias("_first"), F.max(day).alias("end_date")).select(
        F.greatest(F.date_sub("end_date", lookback_days), F.col("_first")).alias("start_date"),
        "end_date",
    )


def latest_non_null(df: DataFrame, time: str, columns: Sequence[str]) -> DataFrame:
    """One row: the latest time at which any of ``columns`` has a value."""
    present = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
    return df.agg(F.max(F.when(present, F.col(time))).alias(time))
