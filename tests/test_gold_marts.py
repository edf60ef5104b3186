from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake.operators import gold, marts
from gridlake.operators.quality import QualityError, check
from gridlake.operators.rank import at_newest, latest_by_key, latest_of_few
from gridlake.operators.stats import with_group_stats, with_previous
from gridlake.schemas import FUEL_SPEC, GOLD_FUEL, GOLD_POWER, GOLD_REGION, POWER_SPEC, REGION_SPEC

SILVER_REGION = (
    "event_id string, period timestamp, respondent string, respondent_name string, type string,"
    " value double, loaded_at timestamp"
)


def silver_region(spark, *rows):
    df = spark.createDataFrame(list(rows), SILVER_REGION)
    return df.withColumn("event_date", F.to_date("period"))


def gold_region(spark, *rows):
    """Gold rows from (period, respondent, actual, forecast, error %)."""
    data = [
        (p, p.date(), r, r, "MWh", a, f, a - f if a is not None and f is not None else None, e, p)
        for p, r, a, f, e in rows
    ]
    return spark.createDataFrame(data, GOLD_REGION)


def gold_fuel(spark, *rows):
    """Gold rows from (period, respondent, fuel, MWh)."""
    data = [(p, p.date(), r, r, f, f, "MWh", m, p) for p, r, f, m in rows]
    return spark.createDataFrame(data, GOLD_FUEL)


@pytest.fixture(params=[gold.region_hourly, gold.region_hourly_joined])
def region_hourly(request):
    return request.param


def test_region_puts_demand_and_forecast_side_by_side(spark, at, region_hourly):
    df = silver_region(
        spark,
        ("e1", at(1), "PJM", "PJM", "D", 100.0, at(1, 1)),
        ("e2", at(1), "PJM", "PJM", "DF", 125.0, at(1, 1, 10)),
    )
    built = region_hourly(df)
    row = built.collect()
    assert len(row) == 1
    assert (row[0]["actual_demand_mwh"], row[0]["day_ahead_forecast_mwh"]) == (100.0, 125.0)
    assert (row[0]["forecast_error_mwh"], row[0]["forecast_error_pct"]) == (-25.0, -20.0)
    assert row[0]["loaded_at"] == at(1, 1, 10)
    check(built, gold.REGION_RULES, "gold")


def test_region_takes_the_latest_revision_and_keeps_one_sided_hours(spark, at, region_hourly):
    df = silver_region(
        spark,
        ("e1", at(1), "PJM", "old", "D", 100.0, at(1, 1)),
        ("e2", at(1), "PJM", "new", "D", 120.0, at(1, 1, 5)),
        ("e3", at(1), "PJM", "tie", "D", 130.0, at(1, 1, 5)),
        ("e4", at(1, 1), "PJM", "fc", "DF", 0.0, at(1, 2)),
    )
    rows = {r["period"]: r for r in region_hourly(df).collect()}
    assert rows[at(1)]["actual_demand_mwh"] == 130.0
    assert rows[at(1)]["respondent_name"] == "tie"
    assert rows[at(1, 1)]["actual_demand_mwh"] is None
    assert rows[at(1, 1)]["forecast_error_pct"] is None
    assert rows[at(1, 1)]["respondent_name"] == "fc"


def test_latest_by_key_ignores_row_order(spark, at):
    rows = [
        (f"e{i:02d}", at(1, i % 5), "R", "R", "D", float(i), at(2, i % 7)) for i in range(40)
    ]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = silver_region(spark, *rows).repartition(seed + 1)
        kept = latest_by_key(df, REGION_SPEC.business_key, gold.NEWEST)
        seen.add(tuple(sorted(r["event_id"] for r in kept.collect())))
    assert len(seen) == 1 and len(seen.pop()) == 5


def test_latest_by_key_limits_groups_before_the_shuffle(spark, at):
    df = silver_region(spark, ("e", at(1), "R", "R", "D", 1.0, at(1)))
    kept = latest_by_key(df, REGION_SPEC.business_key, gold.NEWEST)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_of_few_and_rows_at_the_newest_time_give_the_same_rows(spark, at):
    rows = [
        (f"e{i:02d}", at(1, i % 5), None if i % 4 else "R", "R", "D", float(i), None if i % 5 == 3 else at(2, i % 3))
        for i in range(40)
    ]
    df = silver_region(spark, *rows).repartition(3)
    keys = REGION_SPEC.business_key
    wanted = sorted(r["event_id"] for r in latest_by_key(df, keys, gold.NEWEST).collect())
    few = latest_of_few(df, keys, gold.NEWEST)
    thinned = at_newest(df, keys, "loaded_at", keep=lambda newest: newest)
    assert sorted(r["event_id"] for r in few.collect()) == wanted
    assert sorted(r["event_id"] for r in latest_by_key(thinned, keys, gold.NEWEST).collect()) == wanted
    assert len(wanted) < thinned.count() < 40


def test_fuel_clips_negative_readings(spark, at):
    rows = [
        ("e1", at(1), "PJM", "PJM", "NG", "Gas", -10.0, "mwh", at(1)),
        ("e2", at(1), "PJM", "PJM", "SUN", None, 5.0, "mwh", at(1)),
        ("e3", at(1), "PJM", "PJM", "SUN", "Solar", 7.0, "mwh", at(2)),
    ]
    df = spark.createDataFrame(
        [(*r, r[1].date()) for r in rows], FUEL_SPEC.schema
    )
    built = gold.fuel_hourly(df)
    assert {r["fueltype"]: r["generation_mwh"] for r in built.collect()} == {"NG": 0.0, "SUN": 7.0}
    check(built, gold.FUEL_RULES, "gold")


def silver_power(spark, *rows):
    names = POWER_SPEC.schema.names
    base = {
        "location": "US",
        "location_name": "U.S.",
        "sector_id": "1",
        "sector_name": "Utility",
        "fueltype_id": "COL",
        "fueltype_name": "coal",
    }
    data = [tuple({**base, **r}.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, POWER_SPEC.schema)


def test_power_takes_the_latest_and_changes_units(spark, at):
    month = {"period": at(1), "event_date": date(2026, 1, 1)}
    df = silver_power(
        spark,
        {**month, "event_id": "e1", "generation_thousand_mwh": 20.0, "loaded_at": at(1)},
        {
            **month,
            "event_id": "e2",
            "generation_thousand_mwh": 30.0,
            "ash_content_pct": 12.0,
            "consumption_for_eg_thousand_units": 6.0,
            "loaded_at": at(1, 1),
        },
        {
            **month,
            "event_id": "e3",
            "fueltype_id": "NG",
            "generation_thousand_mwh": -1.0,
            "ash_content_pct": -2.0,
            "consumption_for_eg_thousand_units": -3.0,
            "heat_content_btu_per_unit": -4.0,
            "loaded_at": at(1),
        },
    )
    built = gold.power_monthly(df)
    rows = {r["fueltype_id"]: r for r in built.collect()}
    coal, gas = rows["COL"], rows["NG"]
    assert (coal["generation_mwh"], coal["ash_content_pct"]) == (30000.0, 12.0)
    assert coal["consumption_for_eg_thousand_units"] == 6.0
    assert coal["heat_content_btu_per_unit"] is None
    assert [
        gas["generation_mwh"],
        gas["ash_content_pct"],
        gas["consumption_for_eg_thousand_units"],
        gas["heat_content_btu_per_unit"],
    ] == [0.0] * 4
    check(built, gold.POWER_RULES, "gold")


SEEN = "respondent string, respondent_name string, event_date date"


def test_respondent_dimension_with_prior(spark):
    region = spark.createDataFrame([("PJM", "PJM Updated", date(2026, 1, 1))], SEEN)
    prior = spark.createDataFrame(
        [("PJM", "PJM Interconnection", date(2025, 12, 31), date(2025, 12, 31), 2)],
        "respondent string, respondent_name string, first_seen_date date, last_seen_date date,"
        " source_dataset_count bigint",
    )
    built = gold.dim_respondent(region, None, prior)
    row = built.first()
    assert row["respondent_name"] == "PJM Updated"
    assert (row["first_seen_date"], row["last_seen_date"]) == (
        date(2025, 12, 31),
        date(2026, 1, 1),
    )
    assert row["source_dataset_count"] == 2
    assert gold.dim_respondent(region, None).first()["source_dataset_count"] == 1
    assert gold.dim_respondent(region, region).first()["source_dataset_count"] == 2
    check(built, gold.DIM_RESPONDENT_RULES, "gold.dim_respondent")
    with pytest.raises(ValueError, match="region or a fuel"):
        gold.dim_respondent(None, None)


def test_fuel_dimension(spark, at):
    fuel = spark.createDataFrame(
        [
            ("NG", "Gas", date(2026, 1, 1)),
            ("NG", "Natural gas", date(2026, 1, 2)),
            ("SUN", "Solar", date(2026, 1, 1)),
            ("NUC", "Nuclear", date(2026, 1, 1)),
            ("XX", None, date(2026, 1, 1)),
            (None, "lost", date(2026, 1, 1)),
        ],
        "fueltype string, fueltype_name string, event_date date",
    )
    built = gold.dim_fuel_type(fuel)
    rows = {r["fueltype"]: r for r in built.collect()}
    assert {k: (r["fuel_category"], r["emissions_factor_kg_per_mwh"]) for k, r in rows.items()} == {
        "NG": ("fossil", 490.0),
        "SUN": ("renewable", 35.0),
        "NUC": ("nuclear", 12.0),
        "XX": ("other", 0.0),
    }
    assert rows["NG"]["fueltype_name"] == "Natural gas"
    with pytest.raises(QualityError, match="null values"):
        check(built, gold.DIM_FUEL_RULES, "gold.dim_fuel_type")
    prior = built.filter("fueltype = 'NG'").withColumn("fueltype_name", F.lit("Methane"))
    assert {
        wins: gold.dim_fuel_type(fuel, prior, at(5), prior_wins=wins)
        .filter("fueltype = 'NG'")
        .first()["fueltype_name"]
        for wins in (True, False)
    } == {True: "Methane", False: "Natural gas"}


# --- marts ----------------------------------------------------------------------


def test_region_daily(spark, at):
    df = gold_region(
        spark,
        (at(1), "PJM", 100.0, None, None),
        (at(1, 1), "PJM", 200.0, None, None),
        (at(1, 2), "PJM", None, 5.0, None),
    )
    built = marts.region_daily(df, at(1), at(2))
    row = built.collect()
    assert len(row) == 1
    assert (
        row[0]["daily_demand_mwh"],
        row[0]["avg_hourly_demand_mwh"],
        row[0]["peak_hourly_demand_mwh"],
    ) == (300.0, 150.0, 200.0)
    assert (row[0]["source_window_start"], row[0]["source_window_end"]) == (at(1), at(2))
    check(built, marts.REGION_DAILY_RULES, "daily")
    check(built, marts.region_daily_published_rules(at(1), at(2)), "daily")


def test_planning_golden_case(spark, at):
    region = gold_region(
        spark, (at(3), "PJM", 100.0, 90.0, 11.111111), (at(3, 1), "PJM", 200.0, 190.0, -5.263158)
    )
    fuel = gold_fuel(
        spark,
        (at(3), "PJM", "SUN", 80.0),
        (at(3, 1), "PJM", "SUN", 50.0),
        (at(3), "PJM", "NG", 20.0),
        (at(3, 1), "PJM", "NG", 150.0),
    )
    dim = spark.createDataFrame(
        [("SUN", 35.0), ("NG", 490.0)], "fueltype string, emissions_factor_kg_per_mwh double"
    )
    built = marts.planning_daily(region, fuel, dim)
    row = built.first()
    assert row["daily_demand_mwh"] == 300.0 and row["peak_hourly_demand_mwh"] == 200.0
    assert row["renewable_share_pct"] == pytest.approx(43.333333333333336)
    assert row["gas_share_pct"] == row["fossil_share_pct"] == pytest.approx(56.666666666666664)
    assert row["weekend_flag"] is True
    assert row["carbon_intensity_kg_per_mwh"] == pytest.approx(292.8333333)
    assert row["fuel_diversity_index"] == pytest.approx(0.4911111)
    assert row["peak_hour_gas_share_pct"] == pytest.approx(75.0)
    assert row["clean_coverage_ratio"] == pytest.approx(0.4333333)
    assert row["avg_abs_forecast_error_pct"] == pytest.approx(8.1871345)
    check(built, marts.PLANNING_RULES, "planning")


def test_planning_edges(spark, at):
    region = gold_region(
        spark,
        (at(1, 5), "A", 10.0, None, None),
        (at(1, 3), "A", 10.0, None, None),
        (at(1), "B", 10.0, None, None),
        (at(1), "C", None, 10.0, None),
    )
    fuel = gold_fuel(
        spark, (at(1, 3), "A", "NG", 0.0), (at(1, 5), "A", "NG", 0.0), (at(1), "Z", "NG", 1.0)
    )
    dim = spark.createDataFrame([], "fueltype string, emissions_factor_kg_per_mwh double")
    assert marts.demand_daily(region).filter("respondent = 'A'").first()["peak_period"] == at(1, 3)
    rows = {r["respondent"]: r for r in marts.planning_daily(region, fuel, dim).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["fuel_diversity_index"] == 1.0
    assert rows["A"]["carbon_intensity_kg_per_mwh"] is None
    assert rows["A"]["peak_hour_gas_share_pct"] is None
    assert rows["B"]["fuel_diversity_index"] is None and rows["B"]["weekend_flag"] is False


def test_power_mart_golden_case(spark, at):
    def row(fuel, mwh, consumption, heat):
        day = date(2026, 1, 1)
        head = (at(1), day, "US", "U.S.", "1", "Utility", fuel, fuel)
        return (*head, None, consumption, mwh, heat, at(2))

    power = spark.createDataFrame(
        [row("COL", 60000.0, 10.0, 20.0), row("NG", 40000.0, 20.0, 1.0), row("X", 0.0, 1.0, None)],
        GOLD_POWER,
    )
    built = marts.power_mart(power, at(1), at(2))
    rows = {r["fueltype_id"]: r for r in built.collect()}
    got = {
        k: (r["generation_share_pct"], r["fuel_heat_input_mmbtu"], r["heat_rate_btu_per_kwh"])
        for k, r in rows.items()
    }
    assert got["COL"] == (60.0, 200000.0, pytest.approx(3333.3333333333335))
    assert got["NG"] == (40.0, 20000.0, 500.0)
    assert got["X"] == (0.0, None, None)
    check(built, marts.POWER_MART_RULES, "power")


def hours(spark, values, respondent="A", start=datetime(2026, 1, 1)):
    return [
        (start + timedelta(hours=i), respondent, v, None, None) for i, v in enumerate(values)
    ]


def test_grid_status_first_row_flat_series_and_missing_fuel(spark, at):
    region = gold_region(spark, *hours(spark, [10.0, 10.0, 10.0]))
    fuel = gold_fuel(spark, (at(1), "A", "NG", 9.0), (at(1, 1), "A", "SUN", 8.0))
    status = marts.grid_status(region, fuel, at(9))
    rows = {r["period"]: r for r in status.collect()}
    first, second, third = rows[at(1)], rows[at(1, 1)], rows[at(1, 2)]
    assert first["demand_ramp_mwh"] is None and second["demand_ramp_mwh"] == 0.0
    # no spread: every score is 0, also where the ramp itself is missing
    assert {r["demand_ramp_zscore"] for r in rows.values()} == {0.0}
    assert {r["forecast_error_zscore"] for r in rows.values()} == {0.0}
    assert (first["coverage_ratio"], first["alert_count"]) == (0.9, 0)
    assert (second["coverage_ratio"], second["alert_count"]) == (0.8, 1)
    assert (second["renewable_share_pct"], second["gas_share_pct"]) == (100.0, 0.0)
    assert third["coverage_ratio"] is None and third["total_generation_mwh"] is None
    assert third["generation_gap_mwh"] is None and third["alert_count"] == 0
    check(status, marts.GRID_STATUS_RULES, "grid")
    alerts = marts.grid_alerts(status, at(9)).collect()
    assert [(a["alert_type"], a["severity"], a["message"]) for a in alerts] == [
        ("fuel_mix_support_gap", "medium", "Generation coverage ratio dropped to 0.8")
    ]


def test_grid_alerts_at_the_thresholds(spark, at):
    columns = (
        "period timestamp, respondent string, respondent_name string,"
        " forecast_error_zscore double, demand_ramp_zscore double, demand_zscore double,"
        " coverage_ratio double"
    )
    status = spark.createDataFrame(
        [
            (at(1), "A", "A", 2.5, -3.5, 2.4999, 0.9),
            (at(1, 1), "A", "A", None, None, -2.5, 0.7999),
        ],
        columns,
    )
    expected = {
        (at(1), "forecast_error", "medium", 2.5, 2.5, "Forecast error z-score reached 2.5"),
        (at(1), "ramp_risk", "high", -3.5, 2.5, "Demand ramp z-score reached -3.5"),
        (at(1, 1), "demand_anomaly", "medium", -2.5, 2.5, "Demand z-score reached -2.5"),
        (
            at(1, 1),
            "fuel_mix_support_gap",
            "high",
            0.7999,
            0.9,
            "Generation coverage ratio dropped to 0.8",
        ),
    }
    names = ("period", "alert_type", "severity", "metric_value", "threshold_value", "message")
    for build in (marts.grid_alerts, marts.grid_alerts_union):
        got = build(status, at(9))
        assert {tuple(r[n] for n in names) for r in got.collect()} == expected
        check(got, marts.GRID_ALERT_RULES, "alerts")


def test_hours_without_demand_are_refused_or_left_out(spark, at):
    region = gold_region(spark, (at(1), "A", 1.0, None, None), (at(1, 1), "A", None, 2.0, None))
    fuel = gold_fuel(spark, (at(1), "A", "NG", 1.0))
    with pytest.raises(QualityError, match="null values"):
        check(marts.grid_status(region, fuel), marts.GRID_STATUS_RULES, "grid")
    kept = marts.grid_status(region, fuel, drop_unmeasured=True)
    assert kept.count() == 1
    check(kept, marts.GRID_STATUS_RULES, "grid")


def test_ramp_follows_rows_across_months_and_gaps(spark):
    start = datetime(2025, 12, 30)
    rng = random.Random(3)
    stamps = sorted(rng.sample(range(24 * 100), 400))
    data = [
        (start + timedelta(hours=h), r, round(rng.uniform(1, 9), 2), None, None)
        for h in stamps
        for r in ("A", "B")
        if rng.random() < 0.7
    ]
    region = gold_region(spark, *data)
    got = {
        (r["period"], r["respondent"]): r["demand_ramp_mwh"]
        for r in marts.demand_ramp(region).collect()
    }
    expected = {}
    for respondent in ("A", "B"):
        previous = None
        for period, _, value, _, _ in sorted(d for d in data if d[1] == respondent):
            expected[period, respondent] = None if previous is None else value - previous
            previous = value
    assert got.keys() == expected.keys()
    assert all(
        got[k] == pytest.approx(v) if v is not None else got[k] is None
        for k, v in expected.items()
    )


def test_previous_value_may_be_null(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, None), ("a", 11, 3.0), ("a", 12, 4.0)], "k string, t int, v double"
    )
    got = with_previous(df, "v", "k", "t", (F.col("t") / 10).cast("int"), "p")
    assert {r["t"]: r["p"] for r in got.collect()} == {1: None, 2: 1.0, 11: None, 12: 3.0}


def test_zscores_match_their_definition(spark, at):
    values = [1.0, 2.0, 4.0, 9.0]
    region = gold_region(spark, *hours(spark, values), *hours(spark, [5.0], "B"))
    got = marts.zscores(region, "respondent", {"z": "actual_demand_mwh"})
    mean = sum(values) / 4
    std = (sum((v - mean) ** 2 for v in values) / 4) ** 0.5
    rows = {(r["respondent"], r["actual_demand_mwh"]): r["z"] for r in got.collect()}
    assert rows.pop(("B", 5.0)) == 0.0
    assert rows == {("A", v): pytest.approx((v - mean) / std) for v in values}


def test_group_stats_keep_every_row_of_a_hot_group(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) as k", "double(id) as v")
    got = with_group_stats(df, ["k"], total=F.sum("v"), n=F.count("*"))
    assert got.count() == 30_000
    assert got.filter("k = 0").select("n").distinct().first()[0] == 10_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning(k" not in plan
