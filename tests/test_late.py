"""Late rows reach the marts; untouched partitions stay as they are."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake import schemas as S
from gridlake.__main__ import parser
from gridlake.operators import marts, moments
from gridlake.plans import jobs, late
from gridlake.sources import tables, versions

BASE = datetime(2026, 1, 1)
DAYS = 4  # the lookback


def region(spark, rows):
    data = [(BASE + timedelta(hours=h), who, who, v, v * 0.9, v * 0.1, 10.0, BASE + timedelta(days=at)) for h, who, v, at in rows]
    names = ("period", "respondent", "respondent_name", "actual_demand_mwh", "day_ahead_forecast_mwh",
             "forecast_error_mwh", "forecast_error_pct", "loaded_at")
    kinds = "period timestamp, respondent string, respondent_name string, " + ", ".join(f"{n} double" for n in names[3:7])
    df = spark.createDataFrame(data, f"{kinds}, loaded_at timestamp").withColumn("event_date", F.to_date("period"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.GOLD_REGION if f.name not in df.columns]
    return df.select("*", *missing).select(*S.GOLD_REGION.names)


def put(spark, lake, rows):
    return tables.merge_partitions(region(spark, rows), lake.fact(jobs.REGION_FACT), ["period", "respondent"], ["loaded_at"])


def first_rows():
    return [
        (24 * day + hour, who, 100.0 + 7 * day + hour * (3 if who == "A" else 5), 0)
        for day in range(14)
        for hour in (0, 9, 17)
        for who in ("A", "B")
    ]


LATE = [(24 * 3 + 9, "A", 500.0, 30), (24 * 3 + 11, "A", 90.0, 30), (24 * 3 + 9, "B", 100.0 + 21 + 45, 30)]


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """(marts followed through, marts built at once, versions before and after)."""
    one, other = (jobs.Lake(str(tmp_path_factory.mktemp(name))) for name in ("followed", "whole"))
    put(spark, one, first_rows())
    late.propagate(spark, one, days=DAYS, as_of=BASE)
    before = {m.name: versions.version(spark, one.mart(m.name)) for m in MARTS}
    put(spark, one, LATE)
    written = late.propagate(spark, one, days=DAYS, as_of=BASE)
    put(spark, other, first_rows() + [])
    put(spark, other, LATE)
    late.propagate(spark, other, days=DAYS, as_of=BASE)
    return one, other, before, written


MARTS = (jobs.REGION_DAILY, jobs.GRID_STATUS, jobs.GRID_ALERTS, jobs.PLANNING)


def rows_of(spark, lake, mart):
    return sorted(map(str, jobs.read_mart(spark, lake, mart).drop("updated_at").collect()))


def test_the_marts_are_those_of_a_full_rebuild(spark, lakes):
    one, other, _, _ = lakes
    for mart in MARTS:
        got = rows_of(spark, one, mart)
        assert got == rows_of(spark, other, mart)
        assert got or mart is jobs.GRID_ALERTS


def test_only_fed_partitions_are_written(spark, lakes):
    one, _, before, written = lakes
    # the late day and, by its scores, three days after it
    days = {f"day=2026-01-{d:02d}" for d in (4, 5, 6, 7)}
    assert set(written["grid_operations_hourly"].changed) == days
    old, new = before["grid_operations_hourly"].places, written["grid_operations_hourly"].places
    assert {name for name in new if new[name] != old[name]} == days and len(new) == 14
    assert written["region_demand_daily"].changed == ("month=2026-01",)


def test_rows_of_others_keep_their_values(spark, lakes):
    """B's late row differs in its load time only."""
    one = lakes[0]
    old = versions.read(spark, one.mart("grid_operations_hourly"), S.GRID_STATUS, 1)
    new = jobs.read_mart(spark, one, jobs.GRID_STATUS)
    b = [sorted(map(str, rows.filter("respondent = 'B'").collect())) for rows in (old, new)]
    assert b[0] == b[1]
    raised = jobs.read_mart(spark, one, jobs.GRID_STATUS).filter("actual_demand_mwh = 500").first()
    assert raised["demand_ramp_mwh"] > 300 and raised["demand_zscore"] > 2


def test_scores_are_those_of_each_days_own_window(spark, lakes):
    """Against the mart's own operator over the days up to a day."""
    one = lakes[0]
    facts = tables.read_table(spark, one.fact(jobs.REGION_FACT), S.GOLD_REGION)
    fuel = spark.createDataFrame([], S.GOLD_FUEL)
    ramps = marts.grid_measures(facts, fuel)
    for day in (3, 5, 9):
        start, end = BASE + timedelta(days=day - DAYS + 1), BASE + timedelta(days=day + 1)
        window = ramps.filter(F.col("period").between(start, end - timedelta(seconds=1)))
        expected = marts.zscores(window, "respondent", marts.GRID_SCORES).filter(F.col("period") >= end - timedelta(days=1))
        got = jobs.read_mart(spark, one, jobs.GRID_STATUS).filter(F.to_date("period") == (end - timedelta(days=1)).date())
        for name in marts.GRID_SCORES:
            pairs = [{(r["period"], r["respondent"]): r[name] for r in df.collect()} for df in (expected, got)]
            assert pairs[0].keys() == pairs[1].keys() and len(pairs[0]) >= 6
            assert all(abs(pairs[0][k] - pairs[1][k]) < 1e-9 for k in pairs[0])


def test_nothing_new_writes_nothing(spark, lakes):
    one = lakes[0]
    put(spark, one, LATE)
    assert late.propagate(spark, one, days=DAYS, as_of=BASE) == {}


def test_a_removed_alert_and_an_empty_scope(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    assert late.propagate(spark, lake, as_of=BASE) == {}
    schema = S.GRID_ALERTS
    kinds = [f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in schema]
    row = spark.range(1).selectExpr(*kinds).withColumns(
        {"period": F.lit(BASE), "respondent": F.lit("A"), "alert_type": F.lit("ramp_risk")}
    )
    tables.upsert_table(row, lake.mart(jobs.GRID_ALERTS.name), schema, jobs.GRID_ALERTS.key, by=jobs.GRID_ALERTS.placed())
    scope = spark.createDataFrame([(BASE.date(), "A")], "day date, respondent string")
    made = late.replace_rows(lake, jobs.GRID_ALERTS, row.limit(0), scope)
    assert made.places == {} and jobs.read_mart(spark, lake, jobs.GRID_ALERTS).count() == 0


def test_moments_combine(spark):
    values = [("A", d, v) for d, v in ((0, 1e9), (0, 1e9 + 1), (1, 1e9 + 7), (3, 1e9 - 2), (3, None))] + [("B", 2, None), ("C", 1, 5.0), ("C", 9, 5.0)]
    df = spark.createDataFrame([(w, BASE + timedelta(days=d), v) for w, d, v in values], "w string, period timestamp, v double")
    daily = moments.day_moments(df, "w", ["v"])
    exact = {r["w"]: (r["n"], r["m"], r["s"]) for r in df.groupBy("w").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()}
    for row in moments.over_all_days(daily, "w", ["v"]).collect():
        n, mean, std = exact[row["w"]]
        assert row["v"]["n"] == n
        if n:
            assert abs(row["v"]["mean"] - mean) < 1e-6 and abs((row["v"]["m2"] / n) ** 0.5 - std) < 1e-6
    trailing = {(r["w"], str(r[moments.DAY])): r["v"]["n"] for r in moments.over_trailing_days(daily, "w", ["v"], 3).collect()}
    assert trailing == {
        ("A", "2026-01-01"): 2, ("A", "2026-01-02"): 3, ("A", "2026-01-04"): 2, ("B", "2026-01-03"): 0,
        ("C", "2026-01-02"): 1, ("C", "2026-01-10"): 1,
    }
    scored = moments.zscores_from_moments(df, daily, "w", {"z": "v"})
    plain = marts.zscores(df, "w", {"z": "v"})
    key = lambda r: (r["w"], r["period"], r["v"] or 0)
    for a, b in zip(sorted(scored.collect(), key=key), sorted(plain.collect(), key=key), strict=True):
        assert a["z"] == b["z"] or abs(a["z"] - b["z"]) < 1e-6


def test_a_days_change_reads_one_day(spark, tmp_path):
    path = f"{tmp_path}/facts"
    tables.overwrite_partitions(region(spark, first_rows()), path)
    state, schema = f"{tmp_path}/moments", None
    daily = moments.day_moments(tables.read_table(spark, path, S.GOLD_REGION), "respondent", ["actual_demand_mwh"])
    schema = daily.schema
    tables.overwrite_partitions(daily, state, moments.DAY)
    made = tables.merge_partitions(region(spark, LATE), path, ["period", "respondent"], ["loaded_at"])
    day = versions.read(spark, path, S.GOLD_REGION, made, set(made.changed).__contains__)
    assert {name.split("event_date=")[1][:10] for name in day.inputFiles()} == {"2026-01-04"}
    changed = moments.day_moments(day, "respondent", ["actual_demand_mwh"])
    tables.overwrite_partitions(changed, state, moments.DAY)
    whole = moments.day_moments(tables.read_table(spark, path, S.GOLD_REGION), "respondent", ["actual_demand_mwh"])
    stored = tables.read_table(spark, state, schema)
    assert sorted(map(str, stored.collect())) == sorted(map(str, whole.collect()))


def test_commands():
    args = parser().parse_args(["run-window", "--root", "/x", "--start", "2026-01-01", "--end", "2026-01-02", "--dataset", S.POWER])
    assert args.dataset == [S.POWER]
    assert parser().parse_args(["late-rows", "--root", "/x"]).lookback_days == S.GRID_LOOKBACK_DAYS
    assert parser().parse_args(["expire-versions", "--root", "/x", "--table", "gold"]).keep == 10
