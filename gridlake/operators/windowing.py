"""Half-open time windows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import as_instant

Bound = datetime | str | Column | None


def in_window(
    df: DataFrame, column: str, start: Bound = None, end: Bound = None, day: str | None = None
) -> DataFrame:
    """Rows with ``start <= column < end``; either bound may be absent.

    ``day`` names a date column derived from ``column``. When it is the partition
    column of the table, its predicate lets Spark skip whole partitions, which a
    predicate on ``column`` alone cannot do.
    """
    if start is not None:
        df = df.filter(F.col(column) >= as_instant(start))
        if day:
            df = df.filter(F.col(day) >= F.to_date(as_instant(start)))
    if end is not None:
        df = df.filter(F.col(column) < as_instant(end))
        if day:
            df = df.filter(F.col(day) <= F.to_date(as_instant(end)))
    return df


def lookback(end: datetime, days: int, whole_days: bool = False) -> tuple[datetime, datetime]:
    """The window of ``days`` before ``end``; ``whole_days`` floors its start."""
    start = end - timedelta(days=days)
    if whole_days:
        start = start.replace(hour=0, minute=0, second=0, microsecond=0)
    return start, end
