from __future__ import annotations

import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.operators import analytics, geo, stats
from gridlake.operators.analytics import (
    CARBON,
    CLEAN,
    DIVERSITY,
    FORECAST_ERROR,
    GAS_PEAK,
    RENEWABLE,
)

PLAN = (
    f"date date, respondent string, {CARBON} double, {GAS_PEAK} double, {RENEWABLE} double,"
    f" {CLEAN} double, {DIVERSITY} double, {FORECAST_ERROR} double"
)
DAY = date(2026, 1, 1)


def plan(spark, *rows):
    """Planning rows from (date, respondent, carbon, gas, renewable, clean, diversity, error)."""
    return spark.createDataFrame(list(rows), PLAN)


def limits(spark, **values):
    names = analytics.PLANNING_QUANTILES if "renewable_p25" not in values else (
        analytics.STRATEGY_QUANTILES
    )
    schema = ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([tuple(values.get(n) for n in names)], schema)


def test_thresholds_golden_case(spark):
    rows = [
        (DAY, f"R{i}", 100.0 * i, 10.0 * i, 70.0 - 10 * i, 0.0, 0.9 - 0.1 * i, float(i))
        for i in range(1, 5)
    ]
    got = analytics.planning_thresholds(plan(spark, *rows)).first().asDict()
    assert got == {
        "carbon_p90": pytest.approx(370.0),
        "gas_p90": pytest.approx(37.0),
        "renewable_p10": pytest.approx(33.0),
        "carbon_p75": pytest.approx(325.0),
        "diversity_p25": pytest.approx(0.575),
        "forecast_p75": pytest.approx(3.25),
    }
    empty = analytics.planning_thresholds(plan(spark)).first().asDict()
    assert set(empty.values()) == {None} and len(empty) == 6


def test_quantiles_are_exact(spark):
    rng = random.Random(5)
    values = [round(rng.gauss(0, 1), 2) for _ in range(3000)] + [0.0] * 1500
    values += [None] * 10 + [float("nan")] * 10
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    df = df.withColumn("y", F.col("x") * F.col("x")).withColumn("z", F.lit(None).cast("double"))
    points = [0.0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    wanted = {f"x{i}": ("x", p) for i, p in enumerate(points)}
    wanted |= {"y": ("y", 0.3), "z": ("z", 0.5)}
    got = stats.exact_quantiles(df, wanted).first().asDict()
    clean = np.array([v for v in values if v is not None and v == v])
    for i, p in enumerate(points):
        assert got[f"x{i}"] == pytest.approx(np.quantile(clean, p)), p
    assert got["y"] == pytest.approx(np.quantile(clean * clean, 0.3))
    assert got["z"] is None


def test_quantiles_of_many_values(spark):
    """300,000 values, a third of them equal, equal Spark's own exact percentile."""
    value = F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.rand(3) * 100 - 20)
    df = spark.range(300_000).select(value.alias("x"), F.randn(4).alias("y"))
    df = df.cache()
    points = [0.0, 0.0001, 0.25, 0.5, 0.75, 0.9, 0.9999, 1.0]
    wanted = {f"{c}{i}": (c, p) for c in ("x", "y") for i, p in enumerate(points)}
    got = stats.exact_quantiles(df, wanted).first().asDict()
    expected = df.agg(*[F.percentile(c, p).alias(n) for n, (c, p) in wanted.items()]).first().asDict()
    assert got == {name: pytest.approx(value) for name, value in expected.items()}


def test_ranges_narrow_whatever_the_partitions(spark, monkeypatch):
    """5 million distinct, very uneven values: under 1 % of them are put in order."""
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    df = spark.range(5_000_000).select(F.exp(F.rand(3) * 600 - 300).alias("x"))
    seen = []
    narrow = stats._narrowed
    monkeypatch.setattr(stats, "_narrowed", lambda *args: seen.append(narrow(*args)) or seen[-1])
    wanted = {"median": ("x", 0.5), "low": ("x", 0.001), "top": ("x", 1.0)}
    got = stats.exact_quantiles(df, wanted).first().asDict()
    exact = df.agg(*[F.percentile("x", p).alias(n) for n, (_, p) in wanted.items()]).first().asDict()
    assert got == {name: pytest.approx(value, rel=1e-12) for name, value in exact.items()}
    assert 2 <= len(seen) <= 4
    assert all(r.distinct <= stats.ORDERED for r in seen[-1]) and stats.ORDERED < 0.01 * 5_000_000


def test_group_statistics_do_not_move_the_rows(spark):
    df = spark.range(1000).select((F.col("id") % 6).alias("k"), F.col("id").alias("x"))
    joined = stats.with_group_stats(df, ["k"], total=F.sum("x"))
    joined.count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(k" not in plan
    assert joined.agg(F.sum("total")).first()[0] == sum(
        sum(range(k, 1000, 6)) * len(range(k, 1000, 6)) for k in range(6)
    )


def test_rankings_take_their_size(spark):
    rows = [(DAY, f"R{i}", 100.0 * i, 10.0 * i, 50.0, 0.0, 0.5, float(i)) for i in range(1, 5)]
    got = analytics.planning_rankings(plan(spark, *rows), top=2)
    assert got.count() == 8


def test_planning_priority_and_driver(spark):
    thresholds = limits(
        spark,
        carbon_p90=400.0,
        gas_p90=40.0,
        renewable_p10=10.0,
        carbon_p75=300.0,
        diversity_p25=0.3,
        forecast_p75=5.0,
    )
    nan = float("nan")
    cases = {
        "carbon": (400.0, 0.0, 50.0, 0.0, 0.9, 0.0),
        "gas": (0.0, 40.0, 10.0, 0.0, 0.9, 0.0),
        "gas only": (0.0, 40.0, 50.0, 0.0, 0.9, 0.0),
        "warm": (300.0, 40.0, 10.1, 0.0, 0.9, 0.0),
        "narrow": (0.0, 0.0, 50.0, 0.0, 0.3, 9.0),
        "drift": (0.0, 0.0, 50.0, 0.0, 0.9, 5.0),
        "nulls": (None, None, None, None, None, None),
    }
    df = plan(spark, *[(DAY, k, *v) for k, v in cases.items()])
    got = analytics.planning_driver(analytics.planning_priority(df, thresholds), thresholds)
    assert {r["respondent"]: (r["planning_priority"], r["primary_driver"]) for r in got.collect()} == {
        "carbon": ("Critical", "High carbon intensity"),
        "gas": ("Critical", "Gas-dependent peak with weak renewables"),
        "gas only": ("Stable", "Within expected range"),
        "warm": ("Elevated", "High carbon intensity"),
        "narrow": ("Elevated", "Low fuel diversity"),
        "drift": ("Elevated", "Forecast accuracy drift"),
        "nulls": ("Stable", "Within expected range"),
    }
    unknown = analytics.planning_priority(df, limits(spark))
    assert {r["planning_priority"] for r in unknown.collect()} == {"Stable"}
    assert nan != nan


def test_priority_history_has_every_label(spark):
    thresholds = limits(spark, carbon_p90=400.0, carbon_p75=300.0)
    days = (date(2026, 1, 1), date(2026, 1, 2))
    carbon = {("A", 0): 500.0, ("B", 0): 400.0, ("C", 0): 300.0}
    carbon |= {("A", 1): 500.0, ("B", 1): 350.0, ("C", 1): 1.0}
    df = plan(spark, *[(days[d], r, c, *[None] * 5) for (r, d), c in carbon.items()])
    got = analytics.priority_history(df.union(df), thresholds).collect()
    counts = {(r["date"].day, r["planning_priority"]): r["respondent_count"] for r in got}
    assert counts == {
        (1, "Critical"): 2,
        (1, "Elevated"): 1,
        (1, "Stable"): 0,
        (2, "Critical"): 1,
        (2, "Elevated"): 1,
        (2, "Stable"): 1,
    }
    labelled = analytics.planning_priority(df.filter("respondent = 'A'"), thresholds)
    shares = analytics.priority_distribution(labelled, "planning_priority").collect()
    assert {r["planning_priority"]: r["count"] for r in shares} == {
        "Critical": 2,
        "Elevated": 0,
        "Stable": 0,
    }


def test_strategy_priority_arms(spark):
    thresholds = limits(
        spark,
        carbon_p90=400.0,
        gas_p90=40.0,
        renewable_p10=10.0,
        carbon_p75=300.0,
        renewable_p25=20.0,
        clean_p25=0.4,
        clean_p10=0.2,
        diversity_p10=0.1,
        diversity_p25=0.3,
    )
    cases = {
        "carbon": ((400.0, 0.0, 50.0, 0.9, 0.9), "Critical"),
        "gas": ((0.0, 40.0, 10.0, 0.9, 0.9), "Critical"),
        "unclean": ((0.0, 0.0, 50.0, 0.2, 0.1), "Critical"),
        "warm": ((300.0, 0.0, 50.0, 0.9, 0.9), "Elevated"),
        "weak": ((0.0, 0.0, 20.0, 0.9, 0.9), "Elevated"),
        "thin": ((0.0, 0.0, 50.0, 0.4, 0.9), "Elevated"),
        "narrow": ((0.0, 0.0, 50.0, 0.9, 0.3), "Elevated"),
        "fine": ((0.0, 0.0, 50.0, 0.9, 0.9), "Stable"),
    }
    df = plan(spark, *[(DAY, k, *v, 0.0) for k, (v, _) in cases.items()])
    got = analytics.strategy_priority(df, thresholds).collect()
    assert {r["respondent"]: r["strategy_priority"] for r in got} == {
        k: label for k, (_, label) in cases.items()
    }


def test_scores_and_health(spark):
    rng = random.Random(7)
    rows = [
        (DAY, f"R{i}", *[round(rng.uniform(0, 100), 3) for _ in range(3)], 0.5, rng.random(), 0.0)
        for i in range(25)
    ]
    got = {
        r["respondent"]: r
        for r in analytics.health_score(analytics.minmax_scores(plan(spark, *rows))).collect()
    }

    def direct(column):
        v = np.array([r[column] for r in rows])
        return np.round((v - v.min()) / (v.max() - v.min()) * 100, 1)

    carbon, gas = np.round(100 - direct(2), 1), np.round(100 - direct(3), 1)
    renewable, diversity = direct(4), direct(6)
    health = np.round(
        carbon * 0.25 + renewable * 0.25 + gas * 0.20 + 50.0 * 0.20 + diversity * 0.10, 1
    )
    for i in range(25):
        row = got[f"R{i}"]
        assert row["score_carbon"] == carbon[i] and row["score_gas"] == gas[i]
        assert row["score_renewable"] == renewable[i] and row["score_clean"] == 50.0
        assert row["strategic_health_score"] == health[i]


def test_score_range(spark):
    rows = [(DAY, f"R{i}", float(i), 1.0, float(i * i), 1.0, 1.0, 0.0) for i in range(11)]
    scored = analytics.minmax_scores(plan(spark, *rows))
    row = analytics.score_range(scored).first()
    every = [r[f"score_{c}"] for r in scored.collect() for c in
             ("carbon", "renewable", "gas", "clean", "diversity")]
    assert row["zmin"] == pytest.approx(np.percentile(every, 5))
    assert row["zmax"] == pytest.approx(np.percentile(every, 95))
    assert row["flat_scores"] == "score_gas,score_clean,score_diversity"
    assert (row["renewable_median"], row["carbon_median"]) == (25.0, 5.0)
    flat = analytics.score_range(analytics.minmax_scores(plan(spark, rows[0]))).first()
    assert (flat["zmin"], flat["zmax"]) == (49.0, 51.0)


def test_grid_priority_and_order(spark):
    columns = (
        "respondent string, has_high_alert boolean, has_medium_alert boolean,"
        " active_alert_count bigint, coverage_ratio double, forecast_error_zscore double,"
        " demand_ramp_zscore double"
    )
    df = spark.createDataFrame(
        [
            ("high", True, False, 1, 1.0, 0.0, 0.0),
            ("thin", False, False, 0, 0.79, 0.0, 0.0),
            ("edge", False, False, 0, 0.8, None, None),
            ("medium", False, True, 2, None, 0.0, 0.0),
            ("z", False, False, 0, 1.0, -2.5, None),
            ("ramp", False, False, 0, 0.9, None, 2.5),
        ],
        columns,
    )
    got = analytics.ranked_grid(df).collect()
    assert [(r["respondent"], r["priority_label"]) for r in got] == [
        ("high", "Critical"),
        ("thin", "Critical"),
        ("medium", "Elevated"),
        ("ramp", "Elevated"),
        ("z", "Elevated"),
        ("edge", "Stable"),
    ]
    alerts = spark.createDataFrame([("high",), ("HIGH",), ("low",)], "severity string")
    kpis = analytics.grid_kpis(df, alerts).first().asDict()
    assert kpis == {
        "respondents": 6,
        "in_alert": 2,
        "critical": 2,
        "lowest_coverage": 0.79,
        "high_severity": 2,
    }


def trend(spark, build, values, metric=CARBON):
    rows = [
        (date(2026, 1, 1 + i), "A", v, *[None] * 5) for i, v in enumerate(values)
    ]
    df = plan(spark, *rows[::-1])
    return {r["metric"]: r for r in build(df, {metric: False}).collect()}.get(metric)


@pytest.mark.parametrize(
    "values, label, delta",
    [
        ([100.0, 90.0], "Improving", -10.0),
        ([100.0, None, 110.0], "Worsening", 10.0),
        ([100.0, 100.9], "Stable", 0.9),
        ([0.0, 0.01], "Stable", 0.01),
        ([5.0, None], "Insufficient trend history", None),
    ],
)
def test_trend_delta(spark, values, label, delta):
    row = trend(spark, analytics.trend_delta, values)
    assert row["trend"] == label
    assert row["delta"] == (delta if delta is None else pytest.approx(delta))


@pytest.mark.parametrize(
    "values, label",
    [
        ([10.0, 9.4], "Improving across the selected window."),
        ([10.0, 10.5], "Flat across the selected window."),
        ([100.0, 104.0], "Worsening across the selected window."),
        ([10.0, 40.0, 12.0], "Flat across the selected window."),
        ([10.0], "Not enough history in the selected window."),
    ],
)
def test_trend_direction(spark, values, label):
    assert trend(spark, analytics.trend_direction, values)["trend"] == label


def test_alert_volume_uses_local_days(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 2, 4, 59), "high"), (datetime(2026, 1, 2, 5), "high")],
        "period timestamp, severity string",
    )
    local = {r["alert_day"].day: r["count"] for r in analytics.alert_volume(df).collect()}
    assert local == {1: 1, 2: 1}
    assert analytics.zone_or_utc("Nowhere/Atall") == "UTC"
    utc = analytics.alert_volume(df, "Nowhere/Atall").collect()
    assert [(r["alert_day"].day, r["count"]) for r in utc] == [(2, 2)]


def test_series_ranges_and_coordinates(spark):
    df = spark.createDataFrame(
        [("PJM", DAY, 1.0, None), ("???", date(2026, 1, 9), None, 2.0)],
        "respondent string, d date, actual_demand_mwh double, day_ahead_forecast_mwh double",
    )
    labels = {k: analytics.SERIES_LABELS[k] for k in df.columns[2:]}
    got = analytics.series_long(df, ["respondent"], labels).collect()
    assert {tuple(r) for r in got} == {
        ("PJM", "Actual demand", 1.0),
        ("???", "Day-ahead forecast", 2.0),
    }
    assert tuple(analytics.default_range(df, "d", 3).first()) == (date(2026, 1, 6), date(2026, 1, 9))
    assert analytics.default_range(df, "d", 30).first()["start_date"] == DAY
    assert analytics.latest_non_null(df, "d", ["actual_demand_mwh"]).first()[0] == DAY
    assert analytics.latest_non_null(df, "d", df.columns[2:]).first()[0] == date(2026, 1, 9)
    placed = geo.with_coordinates(df, "actual_demand_mwh").collect()
    assert [(r["respondent"], r["lat"], r["location_label"]) for r in placed] == [
        ("PJM", 39.9526, "PJM")
    ]


def test_weekday_drift_and_rankings(spark):
    df = spark.createDataFrame(
        [("A", 1.0, False), ("A", 3.0, False), ("A", 9.0, True), ("A", None, True)],
        "respondent string, daily_demand_mwh double, weekend_flag boolean",
    )
    got = analytics.weekday_drift(df).collect()
    assert {(r["day_type"], r["avg_daily_demand_mwh"]) for r in got} == {
        ("Weekday", 2.0),
        ("Weekend", 9.0),
    }
    rows = [(DAY, f"R{i:02d}", float(i), 1.0, float(i), 1.0, None, 0.0) for i in range(15)]
    ranked = analytics.planning_rankings(plan(spark, *rows)).collect()
    top = [r["respondent"] for r in ranked if r["ranking"] == "highest_carbon"]
    assert top == [f"R{i:02d}" for i in range(14, 4, -1)]
    assert not [r for r in ranked if r["ranking"] == "lowest_diversity"]
    assert [r["respondent"] for r in ranked if r["ranking"] == "highest_peak_gas"][:2] == [
        "R00",
        "R01",
    ]
