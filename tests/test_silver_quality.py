from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridlake.operators import quality, reconcile, silver
from gridlake.operators.quality import (
    Allowed,
    Bounds,
    BoundsWhere,
    Consistent,
    MinDistinct,
    MinRows,
    NonEmpty,
    NonNegative,
    NotNull,
    QualityError,
    Unique,
    check,
)
from gridlake.operators.windowing import in_window, lookback
from gridlake.plans import queries
from gridlake.plans.queries import QUERIES
from gridlake.schemas import FUEL, FUEL_SPEC, POWER, POWER_SPEC, REGION, REGION_SPEC
from gridlake.sources.tables import materialized

BRONZE = "event_id string, dataset string, payload map<string,string>, ingestion_ts timestamp"


def region(**changes):
    payload = {
        "period": "2026-01-01T00",
        "respondent": "PJM",
        "respondent-name": "PJM",
        "type": "D",
        "value": "100",
        "value-units": "MWh",
    }
    payload.update({k.replace("_", "-"): v for k, v in changes.items()})
    return payload


def bronze(spark, *events):
    return spark.createDataFrame(list(events), BRONZE)


def test_region_keeps_one_row_per_event(spark, at):
    df = bronze(
        spark,
        ("evt-1", REGION, region(), at(1, 1)),
        ("evt-1", REGION, region(), at(1, 1, 5)),
        ("evt-2", FUEL, region(), at(1, 1)),
    )
    cleaned = silver.clean_region(df)
    row = cleaned.collect()
    assert len(row) == 1
    assert (row[0]["respondent"], row[0]["value"], row[0]["value_units"]) == ("PJM", 100.0, "mwh")
    assert row[0]["loaded_at"] == at(1, 1, 5)
    check(cleaned, silver.clean_rules(REGION_SPEC), "silver.region_data")
    silver.check_retention(df, cleaned, REGION_SPEC)
    assert cleaned.columns == REGION_SPEC.schema.names


def test_region_trims_text_and_drops_incomplete_rows(spark, at):
    good = region(respondent="  PJM ", value_units=" MegaWattHours ")
    bad = [
        region(period="nope"),
        region(value="n/a"),
        region(value=None),
        region(value="NaN"),
        region(respondent=None),
        region(type=None),
        region(value_units=None),
        region(respondent_name=None),
    ]
    df = bronze(spark, *[(f"e{i}", REGION, p, at(1)) for i, p in enumerate([good, *bad])])
    row = silver.clean_region(df).collect()
    assert [(r["event_id"], r["respondent"], r["value_units"]) for r in row] == [
        ("e0", "PJM", "megawatthours")
    ]
    with pytest.raises(QualityError, match="only 1 of 9 source rows"):
        silver.check_retention(df, silver.clean_region(df), REGION_SPEC)


def test_retention_without_valid_and_without_source_rows(spark, at):
    df = bronze(spark, ("e", REGION, region(value="x"), at(1)))
    with pytest.raises(QualityError, match="no valid rows"):
        silver.check_retention(df, silver.clean_region(df), REGION_SPEC)
    silver.check_retention(df, silver.clean_fuel(df), FUEL_SPEC)


def test_bad_unit_and_bad_type_are_refused(spark, at):
    for payload in (region(value_units="GW"), region(type="X")):
        cleaned = silver.clean_region(bronze(spark, ("e", REGION, payload, at(1))))
        with pytest.raises(QualityError, match="unsupported values"):
            check(cleaned, silver.clean_rules(REGION_SPEC), "silver.region_data")


def test_conflicting_copies_are_refused(spark, at):
    df = bronze(
        spark,
        ("e", REGION, region(), at(1)),
        ("e", REGION, region(respondent_name=None), at(1, 1)),
    )
    with pytest.raises(QualityError, match="conflicting records"):
        check(silver.extract(df, REGION_SPEC), silver.extract_rules(REGION_SPEC), "silver")


def test_fuel(spark, at):
    payload = {
        "period": "2026-01-01T03",
        "respondent": "PJM",
        "respondent-name": "PJM",
        "fueltype": " NG ",
        "type-name": None,
        "value": "-3.5",
        "value-units": "megawatthours",
    }
    cleaned = silver.clean_fuel(bronze(spark, ("e", FUEL, payload, None)), at(2))
    row = cleaned.first()
    assert (row["fueltype"], row["fueltype_name"], row["value"]) == ("NG", None, -3.5)
    assert row["loaded_at"] == at(2) and row["period"] == at(1, 3)
    check(cleaned, silver.clean_rules(FUEL_SPEC), "silver.fuel_type_data")


def test_power(spark, at):
    payload = {
        "period": "2026-01",
        "location": "US",
        "stateDescription": "U.S. Total",
        "sectorid": "1",
        "sectorDescription": "Electric Utility",
        "fueltypeid": "COL",
        "fuelTypeDescription": "coal",
        "ash-content": "12.0",
        "ash-content-units": "percent",
        "consumption-for-eg": "5",
        "consumption-for-eg-units": "Thousand Short Tons",
        "generation": "20.0",
        "generation-units": "thousand MegaWattHours",
        "heat-content": "n/a",
        "heat-content-units": "BTU per short tons",
    }
    cleaned = silver.clean_power(bronze(spark, ("e", POWER, payload, at(1))))
    row = cleaned.first()
    assert (row["location"], row["sector_id"], row["fueltype_id"]) == ("US", "1", "COL")
    assert row["period"] == at(1) and row["generation_thousand_mwh"] == 20.0
    assert row["heat_content_btu_per_unit"] is None
    check(cleaned, silver.clean_rules(POWER_SPEC), "silver.power")


@pytest.mark.parametrize(
    "rule, message",
    [
        (NotNull(("id", "value")), "null values"),
        (Unique(("id",)), "duplicate keys"),
        (Allowed("category", ("A",)), "unsupported values"),
        (Consistent(("id",), ("value",)), "conflicting records"),
        (NonNegative(("value",)), "negative values"),
        (Bounds("value", 0.0), "outside bounds >= 0.0"),
        (Bounds("value", -5.0, 0.5), "outside bounds >= -5.0 and <= 0.5"),
        (BoundsWhere("value", None, 0.0, "category = 'B'"), "outside bounds <= 0.0"),
        (MinRows(4), "at least 4 row"),
        (MinRows(2, "category = 'B'"), "at least 2 row"),
        (MinDistinct("category", 3), "at least 3 distinct"),
    ],
)
def test_rules_refuse(spark, rule, message):
    df = spark.createDataFrame(
        [(1, -1.0, "A"), (1, 1.0, "B"), (None, None, None)], "id int, value double, category string"
    )
    with pytest.raises(QualityError, match=message):
        check(df, [rule], "table")


def test_rules_accept_and_nulls_pass(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "A"), (2, 20.0, None), (3, None, "B")], "id int, value double, category string"
    )
    check(
        df,
        [
            NonEmpty(),
            NotNull(("id",)),
            Unique(("id",)),
            Allowed("category", ("A", "B")),
            Consistent(("id",), ("value", "category")),
            NonNegative(("value",)),
            Bounds("value", 0.0, 20.0),
            MinRows(3),
            MinDistinct("category", 2),
            MinRows(1, "id > 99", allow_empty=True),
            MinDistinct("category", 1, "id > 99", allow_empty=True),
        ],
        "table",
    )
    with pytest.raises(QualityError, match="produced no rows"):
        check(df.limit(0), [NonEmpty()], "table")


def test_conflicts_see_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (2, None), (2, None)], "id int, v double")
    assert [r["id"] for r in quality.conflicting_keys(df, ["id"], ["v"]).collect()] == [1]


def test_all_rules_of_a_table_are_one_report(spark):
    df = spark.createDataFrame([(1, -1.0), (1, -2.0)], "id int, v double")
    with pytest.raises(QualityError) as broken:
        check(df, [Unique(("id",)), NonNegative(("v",)), NotNull(("id",))], "t")
    assert "duplicate keys" in str(broken.value) and "(2 found)" in str(broken.value)
    assert "null values" not in str(broken.value)


def test_window_is_half_open(spark, at):
    df = spark.createDataFrame([(at(1, h), h) for h in range(4)], "period timestamp, v int")
    df = df.withColumn("event_date", F.to_date("period"))
    got = in_window(df, "period", "2026-01-01T01:00:00+00:00", at(1, 3), day="event_date")
    assert sorted(r["v"] for r in got.collect()) == [1, 2]
    assert in_window(df, "period").count() == 4


def test_lookback(at):
    assert lookback(at(20, 5), 14) == (at(6, 5), at(20, 5))
    assert lookback(at(20, 5), 14, whole_days=True) == (at(6), at(20, 5))


def test_rules_that_differ_in_one_part_only(spark):
    df = spark.createDataFrame(
        [(1, "x", "p", 5.0), (1, "x", "q", 5.0), (2, "y", "p", 50.0)], "k int, a string, b string, v double"
    )
    first = quality.BoundsWhere("v", 0.0, 10.0, "k = 2")
    second = quality.BoundsWhere("v", 0.0, 10.0, "k = 1")
    third = quality.Consistent(("k",), ("a",))
    fourth = quality.Consistent(("k",), ("b",))
    found = [tuple(r) for r in quality.report(df, [first, second, third, fourth]).collect()]
    assert found == [
        ("bounds(v >= 0.0 and <= 10.0) where k = 2", 1),
        ("bounds(v >= 0.0 and <= 10.0) where k = 1", 0),
        ("consistent(k: a)", 0),
        ("consistent(k: b)", 1),
    ]
    check(df, [second, third], "t")
    for rules in ([first, second], [second, first], [third, fourth], [fourth, third], [first, first]):
        with pytest.raises(QualityError):
            check(df, rules, "t")


WATCHED = [
    quality.NonEmpty(),
    NonNegative(("v",)),
    quality.MinDistinct("v", 200),
    quality.MinRows(200, "v > 0"),
    Unique(("id",)),
]


@pytest.mark.parametrize("where", ["true", "false", "id % 3 = 0"])
def test_counts_of_a_write_equal_a_scan(spark, where):
    source = spark.range(100).selectExpr("id % 90 as id", "cast(id - 5 as double) as v")
    df = source.filter(where).repartition(5, "id")
    watched, counts = quality.counting(df, WATCHED)
    stage = materialized(watched, "watched")
    known = counts.known()
    assert set(known) == {0, 1, 3}  # distinct values and keys are left for the scan
    expected = [tuple(r) for r in quality.report(df, WATCHED).collect()]
    found = [tuple(r) for r in quality.report(stage, WATCHED, known).collect()]
    assert sorted(found) == sorted(expected)
    # the stage is scanned once, for the distinct values, and once per set of keys
    scans = [
        quality.report(stage, WATCHED, k)._jdf.queryExecution().executedPlan().toString().count("FileScan")
        for k in ({}, known)
    ]
    assert scans == [2, 2]
    rows_only = [WATCHED[i] for i in (0, 1, 3)]
    plan = quality.report(stage, rows_only, {0: 0, 1: 0, 2: 0})._jdf.queryExecution().executedPlan()
    assert "FileScan" not in plan.toString()


def test_known_counts_break_rules_without_a_job(spark):
    df = spark.createDataFrame([(1, 1.0)], "id int, v double")
    check(df, [NonNegative(("v",))], "t", {0: 0})
    with pytest.raises(QualityError, match=r"t contains negative values in columns: v \(3 found\)"):
        check(df, [NonNegative(("v",))], "t", {0: 3})


def test_cleaning_sorts_only_what_the_shuffle_dealt(spark, at):
    df = bronze(spark, ("e", REGION, region(), at(1, 1)))
    typed = silver.extract(df, REGION_SPEC)
    expected = reconcile.expected_of_typed(typed, REGION_SPEC, "silver")
    for frame in (silver.clean_region(df), silver.newest_complete(typed, REGION_SPEC), expected):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        above, below = plan.split("Exchange", 1)
        assert "Sort" in above and "WindowGroupLimit" in above
        assert "Exchange" not in below
        assert "Sort" not in below and "WindowGroupLimit" not in below


def test_power_rows_are_not_sorted_where_they_are_read(spark):
    plan = QUERIES["clean_power"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    above, below = plan.executedPlan().toString().split("Exchange", 1)
    assert "Sort" in above and "Sort" not in below


def test_a_report_of_rows_that_nothing_else_reads_stores_keys_only(spark, monkeypatch):
    written, store = [], queries.tables.materialized
    monkeypatch.setattr(queries.tables, "materialized", lambda df, name: written.append(df.columns) or store(df, name))
    rows = [(1, "a", 1.0, "x"), (1, "a", -1.0, "y"), (2, None, None, "z"), (2, "b", 2.0, None)]
    df = spark.createDataFrame(rows, "id int, k string, v double, w string").repartition(3)
    rules = [Unique(("id",)), NotNull(("k", "w")), Consistent(("k",), ("id",)), NonNegative(("v",)), Unique(("id", "k"))]
    for own, columns in ((rules, ["id", "k"]), (rules[1:2], ["id"]), ([*rules, quality.MinDistinct("w", 9, "v > 0")], df.columns)):
        found = [tuple(r) for r in queries.only_report(df, own, "r").collect()]
        assert sorted(found) == sorted(tuple(r) for r in quality.report(df, own).collect())
        assert written.pop() == columns
