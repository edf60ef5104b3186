"""Which days of Bronze have got rows since they were last counted.

Whoever appends to Bronze leaves a note afterwards: a small file per dataset with the days
it has touched. A reader takes the notes that are there, works on those days and deletes
these notes only when its own result is stored. So a day is seen at least once after each
append, whichever of the two fails, and working on a day again has to be harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession

from gridlake.schemas import BRONZE, BRONZE_PARTITIONS
from gridlake.sources.tables import append_partitioned, day_place
from gridlake.sources.versions import hadoop

DATASET, *DAY_COLUMNS = BRONZE_PARTITIONS[:-1]


def folder(bronze_path: str) -> str:
    """Beside Bronze, so that reading Bronze never meets it."""
    return f"{bronze_path.rstrip('/')}.touched"


def leave(events: DataFrame, bronze_path: str) -> None:
    """Note the days of ``events``, which have been appended to Bronze."""
    days = events.select(DATASET, *DAY_COLUMNS).distinct()
    append_partitioned(days, folder(bronze_path), [DATASET])


def pending(spark: SparkSession, bronze_path: str, dataset: str) -> list[str]:
    """The notes on a dataset, as paths of files."""
    fs, target = hadoop(spark, day_place(spark, folder(bronze_path), {DATASET: dataset}))
    if not fs.exists(target):
        return []
    files = [entry.getPath() for entry in fs.listStatus(target)]
    return [str(file) for file in files if not file.getName().startswith(("_", "."))]


def days(spark: SparkSession, found: Sequence[str], dataset: str) -> list[Row]:
    """The days of the given notes: at most one row per day of the dataset."""
    if not found:
        return []
    columns = [BRONZE[c] for c in DAY_COLUMNS]
    rows = spark.read.schema(type(BRONZE)(columns)).parquet(*found).select(*DAY_COLUMNS)
    return [Row(**{DATASET: dataset}, **day.asDict()) for day in rows.distinct().collect()]


def settle(spark: SparkSession, found: Sequence[str]) -> None:
    """Delete notes that have been dealt with."""
    for path in found:
        fs, target = hadoop(spark, path)
        fs.delete(target, False)
