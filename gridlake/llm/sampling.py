"""A bounded sample of rows, the same for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash digits counted at once: so many counts come back per step.
_DIGIT_BITS = 10
_MARK_BITS = 63


def mark(key: Column) -> Column:
    """A hash of ``key`` without sign, by which rows are sampled."""
    return F.shiftrightunsigned(F.xxhash64(key), 1)


def hash_bound(keys: DataFrame, size: int) -> int:
    """The bound below which at most ``size`` rows of ``keys`` have their ``mark``.

    ``keys`` has one column; repeated keys count as often as they occur. Rows are counted per
    leading digit of the mark, then per next digit within the one that is too full, until
    the bound is within a tenth of ``size``. 2 ** 10 counts come back per step, and what
    a filter by the bound yields is never more than ``size`` rows, at any size of the table.
    A single key with more rows than are left to take ends the sample.
    """
    (name,) = keys.columns
    marks = keys.select(mark(F.col(name)).alias("mark"))
    taken = bound = 0
    shift = _MARK_BITS
    while shift > 0:
        above, shift = shift, max(0, shift - _DIGIT_BITS)
        digits = 1 << (above - shift)
        end = bound + (digits << shift)
        inside = marks.filter((F.col("mark") >= F.lit(bound)) & (F.col("mark") <= F.lit(end - 1)))
        digit = F.shiftright(F.col("mark") - F.lit(bound), shift).alias("digit")
        counts = {row["digit"]: row["count"] for row in inside.groupBy(digit).count().collect()}
        for i in range(digits):
            if taken + counts.get(i, 0) > size:
                break
            taken += counts.get(i, 0)
            bound += 1 << shift
        else:
            return bound
        if taken >= 0.9 * size:
            break
    return bound


def sampled(rows: DataFrame, key: str, size: int) -> DataFrame:
    """At most ``size`` of the rows, those with the least marks; nearly ``size`` if there are more."""
    bound = hash_bound(rows.select(key), size)
    return rows.filter(mark(F.col(key)) <= F.lit(bound - 1))
