"""Reading and writing layer tables, stages, topics and extracts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.envelope import to_messages
from gridlake.operators.rank import merge_latest, upsert
from gridlake.operators.windowing import Bound, in_window
from gridlake.schemas import BRONZE, BRONZE_PARTITIONS
from gridlake.session import scratch_path
from gridlake.sources import versions

DAY = "event_date"


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = versions.hadoop(spark, path)
    return fs.exists(target)


def _old(path: str) -> str:
    """Where ``replace_table`` keeps the old version while it puts the new one in place."""
    return f"{path.rstrip('/')}.old"


def has_rows(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Whether the table exists and holds at least one row."""
    return not read_table(spark, path, schema).isEmpty()


# --- reading ------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A layer table; empty but typed where the path does not exist.

    The explicit schema saves the job that infers one, gives old files without a
    newer column nulls in it, and keeps partition columns typed. Of a table with
    versions the newest is read, and stays what it is while later ones are written.
    Where replacing a plain table was interrupted, its old files are read.
    """
    if versions.numbers(spark, path):
        return versions.read(spark, path, schema)
    for place in (path, _old(path)):
        if exists(spark, place):
            return spark.read.schema(schema).parquet(place).select(*schema.names)
    return spark.createDataFrame([], schema)


def read_window(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: Bound = None,
    end: Bound = None,
    time: str = "period",
    day: str | None = DAY,
) -> DataFrame:
    """Rows of a half-open window; whole days outside of it are never opened."""
    return in_window(read_table(spark, path, schema), time, start, end, day)


def read_bronze(
    spark: SparkSession, path: str, dataset: str, start: Bound = None, end: Bound = None
) -> DataFrame:
    """Events of one dataset in a window.

    Bronze is partitioned by year, month, day and hour as numbers, so the window is
    also put as a range of dates made from those columns. Spark evaluates it
    while listing files.
    """
    events = read_table(spark, path, BRONZE).filter(F.col("dataset_partition") == dataset)
    day = F.make_date("event_year", "event_month", "event_day")
    stored = in_window(events, "event_ts", start, end)
    if start is not None:
        stored = stored.filter(day >= F.to_date(F.lit(start).cast("timestamp")))
    if end is not None:
        stored = stored.filter(day <= F.to_date(F.lit(end).cast("timestamp")))
    return stored


def day_place(spark: SparkSession, path: str, values: Mapping[str, object]) -> str:
    """The folder below ``path`` of the given partition values, escaped as Spark does."""
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path, *(named.getPartitionPathString(c, str(v)) for c, v in values.items())])


def read_bronze_days(spark: SparkSession, path: str, days: Sequence[Row]) -> DataFrame:
    """Events of the given day folders; no other folder is listed.

    ``days`` are rows of the partition columns of Bronze without the hour. Folders that do
    not exist are skipped.
    """
    places = [day_place(spark, path, day.asDict()) for day in days]
    present = [place for place in places if exists(spark, place)]
    if not present:
        return spark.createDataFrame([], BRONZE)
    return spark.read.schema(BRONZE).option("basePath", path).parquet(*present)


def read_merged_schema(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files differ in columns, with all of them."""
    return spark.read.option("mergeSchema", True).parquet(path)


# --- writing ------------------------------------------------------------------


def append_partitioned(df: DataFrame, path: str, by: Sequence[str] = BRONZE_PARTITIONS) -> None:
    """Add rows to the partitions they belong to, as few files each."""
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, by: str = DAY, base: versions.Version | None = None
) -> versions.Version | None:
    """Replace the partitions that ``df`` has rows for. An empty ``df`` changes nothing.

    A new version of the table; the others stay readable. Rebalancing by the partition
    column gives each partition few files; adaptive execution splits a partition that is
    larger than others over several tasks.
    """
    return versions.commit(df, path, by, base)


def touched(df: DataFrame, by: str) -> Column | None:
    """The partitions of ``df`` as a predicate on ``by``; None if ``df`` has no rows.

    A literal list, so that Spark skips all other partitions: at most one value per day
    or month of the data. Rows whose partition value is null have a partition too.
    """
    values: list[date | str | None] = [row[0] for row in df.select(by).distinct().collect()]
    if not values:
        return None
    known = F.col(by).isin([value for value in values if value is not None])
    return F.col(by).isNull() | known if None in values else known


_OPENED: list[list[str]] = []


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Delete what ``materialized`` writes inside of the block when the block ends.

    For jobs that have published their results by then; frames read from such a
    stage cannot be used afterwards.
    """
    _OPENED.append([])
    try:
        yield
    finally:
        for path in _OPENED.pop():
            fs, target = versions.hadoop(spark, path)
            fs.delete(target, True)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    What follows reads files instead of computing the plan again, and losing an
    executor loses none of it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _OPENED:
        _OPENED[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merge_partitions(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    newest: Sequence[str],
    by: str = DAY,
    stored: bool = False,
) -> versions.Version | None:
    """Merge rows into the partitions they touch, keeping the newest row per key.

    Only touched partitions are read and rewritten, all of them in one new version. A
    writer that has changed one of them in the meantime makes this a conflict.
    ``stored`` says that ``df`` reads a stage, which then isn't written again.
    """
    spark = df.sparkSession
    incoming = df if stored else materialized(df, "merge")
    base = versions.version(spark, path)
    changed = touched(incoming, by)
    if changed is None:
        return None
    current = versions.read(spark, path, df.schema, base).filter(changed)
    return overwrite_partitions(merge_latest(current, incoming, keys, newest), path, by, base)


def upsert_table(
    stage: DataFrame,
    path: str,
    schema: T.StructType,
    conflict_cols: Sequence[str],
    by: tuple[str, Column] | None = None,
    insert_cols: Sequence[str] | None = None,
    update_cols: Sequence[str] | None = None,
    stored: bool = False,
) -> versions.Version | None:
    """Upsert a stage into a keyed mart; an empty stage changes nothing.

    ``stored`` says that ``stage`` reads a stage, which then isn't written again.
    ``by`` names the mart's partition column and how it follows from the key, for
    instance the month of the period. Then only the touched partitions are read and
    rewritten; without it the whole mart is.
    """
    spark = stage.sparkSession
    base = versions.version(spark, path)
    if by is None:
        current = versions.read(spark, path, schema, base)
        merged = upsert(current, stage, conflict_cols, insert_cols, update_cols)
        return None if stage.isEmpty() else versions.commit(merged, path, base=base)
    name, expression = by
    placed = stage if stored else materialized(stage, "upsert")
    placed = placed.withColumn(name, expression)
    changed = touched(placed, name)
    if changed is None:
        return None
    fields = T.StructType([*schema.fields, placed.schema[name]])
    current = versions.read(spark, path, fields, base).filter(changed)
    columns = [*(insert_cols or [c for c in stage.columns if c in schema.names]), name]
    merged = upsert(current, placed, [*conflict_cols, name], columns, update_cols)
    return overwrite_partitions(merged, path, name, base)


def write_dimension(
    df: DataFrame, path: str, base: versions.Version | None = None
) -> versions.Version | None:
    """A new version of an unpartitioned table. No rows, no change.

    ``base`` is the version ``df`` was built from, which must still be the newest.
    """
    return versions.commit(df, path, base=base)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a plain folder of files that ``df`` may itself have been read from.

    For extracts that others read by their path; tables of the lake have versions instead.
    The new files are complete beside the old ones before those are moved away,
    so a failure leaves one of the two readable. No rows, no change.
    """
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}.new"
    df.write.mode("overwrite").parquet(fresh)
    if spark.read.schema(df.schema).parquet(fresh).isEmpty():
        return
    fs, target = versions.hadoop(spark, path)
    _, fresh_path = versions.hadoop(spark, fresh)
    _, old_path = versions.hadoop(spark, _old(path))
    if fs.exists(target):
        fs.delete(old_path, True)
        if not fs.rename(target, old_path):
            raise OSError(f"could not move {path} to {_old(path)}")
    fs.mkdirs(target.getParent())
    if not fs.rename(fresh_path, target):
        fs.rename(old_path, target)
        raise OSError(f"could not move {fresh} to {path}")
    fs.delete(old_path, True)


def write_stage(df: DataFrame, name: str, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """Write a per-run stage and return it as read back.

    With ``jdbc`` (``url``, ``user``, ``password``, ``driver``) the stage is a table
    of that database, otherwise a table in the shared folder.
    """
    spark = df.sparkSession
    if jdbc:
        options = dict(jdbc)
        url = options.pop("url")
        df.write.mode("overwrite").jdbc(url, name, properties=options)
        return spark.read.jdbc(url, name, properties=options)
    return materialized(df, name)


def publish(envelopes: DataFrame, sink: str = "kafka", **options: str) -> None:
    """Send envelopes as keyed messages; any batch sink that takes key and value will do."""
    to_messages(envelopes).write.format(sink).mode("append").options(**options).save()


def export_csv(df: DataFrame, path: str) -> None:
    """Write rows as CSV files with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
