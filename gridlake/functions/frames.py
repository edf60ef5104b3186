"""Frame-level helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, *columns: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` plus computed columns, each computed one time per row.

    Spark pushes a filter below a projection together with copies of the projected
    expressions, so three conditions on parsed JSON would parse it three times more.
    A filter on what a generator puts out stays above it. Worth it for costly
    expressions only: unused columns are computed as well.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))
