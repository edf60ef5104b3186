from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.rank import merge_latest, upsert
from gridlake.schemas import GOLD_REGION, table
from gridlake.session import scratch_path, shared_dir
from gridlake.sources import tables

ROW = table("event_id string, value double, loaded_at timestamp, event_date date")


def rows(spark, *data):
    df = spark.createDataFrame(list(data), "event_id string, value double, loaded_at timestamp")
    return df.withColumn("event_date", F.to_date("loaded_at"))


def content(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_missing_table_is_typed_and_empty(spark, tmp_path):
    df = tables.read_table(spark, f"{tmp_path}/none", GOLD_REGION)
    assert df.schema == GOLD_REGION and df.count() == 0
    assert not tables.has_rows(spark, f"{tmp_path}/none", GOLD_REGION)


def test_window_prunes_partitions(spark, tmp_path, at):
    path = f"{tmp_path}/t"
    tables.overwrite_partitions(
        rows(spark, *[(f"e{d}", float(d), at(d, 5)) for d in range(1, 9)]), path
    )
    got = tables.read_window(spark, path, ROW, at(3), at(5), time="loaded_at")
    assert content(got, "event_id") == [("e3",), ("e4",)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "event_date" in filters and "2026-01-03" in filters or "20456" in filters


def test_overwrite_replaces_only_touched_partitions(spark, tmp_path, at):
    path = f"{tmp_path}/t"
    tables.overwrite_partitions(rows(spark, ("a", 1.0, at(1)), ("b", 2.0, at(2))), path)
    tables.overwrite_partitions(rows(spark, ("c", 3.0, at(2))), path)
    assert content(tables.read_table(spark, path, ROW), "event_id") == [("a",), ("c",)]
    tables.overwrite_partitions(rows(spark, ("x", 1.0, at(1))).limit(0), path)
    assert tables.read_table(spark, path, ROW).count() == 2


def merge(df, path):
    tables.merge_partitions(df, path, ["event_id"], ["loaded_at"])


def test_merge_adds_replaces_and_repeats(spark, tmp_path, at):
    path = f"{tmp_path}/t"
    merge(rows(spark, ("evt-1", 100.0, at(1, 0, 10)), ("old", 1.0, at(5))), path)
    merge(rows(spark, ("evt-2", 110.0, at(1, 1))), path)
    assert content(tables.read_table(spark, path, ROW), "event_id", "value") == [
        ("evt-1", 100.0),
        ("evt-2", 110.0),
        ("old", 1.0),
    ]
    later = rows(spark, ("evt-1", 120.0, at(1, 0, 20)))
    for _ in range(2):
        merge(later, path)
        got = content(tables.read_table(spark, path, ROW), "event_id", "value")
        assert got == [("evt-1", 120.0), ("evt-2", 110.0), ("old", 1.0)]
    merge(rows(spark, ("evt-1", 90.0, at(1, 0, 15))), path)
    assert ("evt-1", 120.0) in content(tables.read_table(spark, path, ROW), "event_id", "value")
    merge(later.limit(0), path)
    assert tables.read_table(spark, path, ROW).count() == 3


def test_merge_latest_prefers_incoming_on_a_tie_and_fills_columns(spark, at):
    old = rows(spark, ("a", 1.0, at(1)), ("b", 1.0, at(1)), ("n", 1.0, None)).drop("event_date")
    new = rows(spark, ("a", 2.0, at(1)), ("n", 2.0, at(1))).withColumn("extra", F.lit("x"))
    got = merge_latest(old, new, ["event_id"], ["loaded_at"])
    assert content(got.fillna("-", ["extra"]), "event_id", "value", "extra") == [
        ("a", 2.0, "x"),
        ("b", 1.0, "-"),
        ("n", 2.0, "x"),
    ]


TARGET = "k int, a string, b string, c string"


def test_upsert_inserts_updates_and_keeps(spark):
    target = spark.createDataFrame([(1, "a1", "b1", "c1"), (2, "a2", "b2", "c2")], TARGET)
    stage = spark.createDataFrame([(2, "A2", None, "C2"), (3, "A3", "B3", "C3")], TARGET)
    got = upsert(target, stage, ["k"])
    assert content(got.fillna("-"), *target.columns) == [
        (1, "a1", "b1", "c1"),
        (2, "A2", "-", "C2"),
        (3, "A3", "B3", "C3"),
    ]
    partial = upsert(target, stage, ["k"], insert_cols=["k", "a", "b"], update_cols=["a"])
    assert content(partial.fillna("-"), *target.columns) == [
        (1, "a1", "b1", "c1"),
        (2, "A2", "b2", "c2"),
        (3, "A3", "B3", "-"),
    ]
    twice = upsert(got, stage, ["k"])
    assert content(twice.fillna("-"), *target.columns) == content(got.fillna("-"), *target.columns)
    same = upsert(target, stage.limit(0), ["k"])
    assert content(same, *target.columns) == content(target, *target.columns)


SCHEMA = T.StructType([f for f in table("day date, k string, v double, w double").fields])


@pytest.mark.parametrize("by", [None, ("month", F)])
def test_upsert_table(spark, tmp_path, by):
    path = f"{tmp_path}/mart"
    place = None if by is None else ("month", F.date_format("day", "yyyy-MM"))

    def stage(*data):
        df = spark.createDataFrame(list(data), "day string, k string, v double, w double")
        return df.withColumn("day", F.to_date("day"))

    def put(df, **options):
        tables.upsert_table(df, path, SCHEMA, ["day", "k"], by=place, **options)
        read = tables.read_table(spark, path, SCHEMA)
        return content(read.withColumn("day", F.col("day").cast("string")), *SCHEMA.names)

    first = put(stage(("2026-01-01", "a", 1.0, 1.0), ("2026-02-01", "a", 2.0, 2.0)))
    assert len(first) == 2
    second = stage(("2026-02-01", "a", 9.0, 9.0), ("2026-02-02", "b", 3.0, 3.0))
    expected = [
        ("2026-01-01", "a", 1.0, 1.0),
        ("2026-02-01", "a", 9.0, 2.0),
        ("2026-02-02", "b", 3.0, 3.0),
    ]
    assert put(second, update_cols=["v"]) == expected
    assert put(second, update_cols=["v"]) == expected
    assert put(second.limit(0)) == expected


def test_plain_files_are_rebuilt_from_themselves(spark, tmp_path):
    path = f"{tmp_path}/dim"
    df = spark.range(5).withColumn("n", F.lit(1))
    tables.replace_table(df, path)
    for expected in (2, 3):
        current = spark.read.parquet(path)
        tables.replace_table(current.withColumn("n", F.col("n") + 1), path)
        assert spark.read.parquet(path).agg(F.min("n"), F.count("*")).first() == (expected, 5)
    tables.replace_table(df.limit(0), path)
    assert spark.read.parquet(path).count() == 5
    assert not tables.exists(spark, f"{path}.old")


def test_an_interrupted_swap_leaves_the_old_files_readable(spark, tmp_path):
    path, schema = f"{tmp_path}/dim", table("id bigint")
    tables.replace_table(spark.range(3), path)
    (tmp_path / "dim").rename(tmp_path / "dim.old")
    assert tables.read_table(spark, path, schema).count() == 3
    tables.replace_table(tables.read_table(spark, path, schema).union(spark.range(1)), path)
    assert tables.read_table(spark, path, schema).count() == 4
    assert not tables.exists(spark, f"{path}.old")


def test_merged_schema(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(1).write.parquet(f"{path}/p=1")
    spark.range(1).withColumn("x", F.lit("y")).write.parquet(f"{path}/p=2")
    assert set(tables.read_merged_schema(spark, path).columns) == {"id", "x", "p"}


def test_csv_and_publish(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1.5, None)], "t string, v double, n string")
    tables.export_csv(df, f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).first().asDict() == {
        "t": "a,b",
        "v": "1.5",
        "n": None,
    }


def test_null_partitions_are_merged_and_upserted(spark, tmp_path, at):
    """Rows without a partition value are stored, found again and replaced like others."""
    path = f"{tmp_path}/t"

    def hidden(*found):
        df = rows(spark, *found)
        return df.withColumn("event_date", F.lit(None).cast("date"))

    merge(hidden(("a", 1.0, at(1)), ("b", 2.0, at(2))), path)
    merge(rows(spark, ("c", 3.0, at(3))).unionByName(hidden(("b", 9.0, at(4)))), path)
    stored = tables.read_table(spark, path, ROW)
    assert content(stored, "event_id", "value") == [("a", 1.0), ("b", 9.0), ("c", 3.0)]

    mart = f"{tmp_path}/mart"
    schema = T.StructType.fromDDL("k int, day date, v int")
    by = ("month", F.date_format("day", "yyyy-MM"))
    for batch in ([(1, None, 1), (2, None, 2)], [(2, None, 5), (3, at(1).date(), 3)]):
        tables.upsert_table(spark.createDataFrame(batch, schema), mart, schema, ["k"], by=by)
    assert content(tables.read_table(spark, mart, schema), "k", "v") == [(1, 1), (2, 5), (3, 3)]


def test_stages_are_deleted(spark):
    with tables.stages(spark):
        stage = tables.materialized(spark.range(3), "gone")
        place = stage.inputFiles()[0].rsplit("/", 1)[0]
        assert tables.exists(spark, place)
    assert not tables.exists(spark, place)
