"""Column expressions used across layers. Everything here stays JVM-side."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_WITH_OFFSET = "yyyy-MM-dd'T'HH[X]"
ISO_UTC_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
GRAIN_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"


# A four-digit year, then month, day, time and offset as far as they are given.
PERIOD = (
    r"^(?!0000)\d{4}(-\d{2}(-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.]\d{1,9})?)?)?"
    r"(Z|[+-]\d{2}(:?\d{2})?)?)?)?)?$"
)


def parse_ts(text: Column) -> Column:
    """Text period to UTC instant, null when it does not parse.

    Only the notations of ``PERIOD`` are periods. Spark's own parser also takes a bare
    time as one of today, years of more digits and names of zones. Of the notations only the
    hour followed by an offset needs a pattern of its own.
    """
    parsed = F.coalesce(
        F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit(HOUR_WITH_OFFSET))
    )
    # the length first: most text that is no period is told apart without the pattern
    return F.when(F.length(text).between(4, 36) & text.rlike(PERIOD), parsed)


def iso_utc(instant: Column) -> Column:
    """ISO-8601 UTC text; with microseconds where the instant has a part of a second.

    Formatted once, so ``instant``, which may be a parsed text, occurs once.
    """
    return F.replace(F.date_format(instant, ISO_UTC_MICROS), F.lit(".000000"), F.lit(""))


def normalize_period(text: Column) -> Column:
    """Text period to ISO-8601 UTC text, null when it does not parse."""
    return iso_utc(parse_ts(text))


def to_number(value: Column) -> Column:
    """Text to double; bad text and NaN become null, so comparisons stay false."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def clean_text(value: Column) -> Column:
    return F.trim(value)


def clean_unit(value: Column) -> Column:
    return F.lower(F.trim(value))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else null."""
    return F.when(denominator > 0, numerator / denominator)


def percent(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator * 100.0)


def at_least_zero(value: Column) -> Column:
    """Negative to 0.0; null stays null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def sum_for(codes: Iterable[str], code: str, amount: str) -> Column:
    """Sum of ``amount`` over rows whose ``code`` is listed, 0.0 for the others."""
    listed = F.col(code).isin(*codes)
    return F.sum(F.when(listed, F.col(amount)).otherwise(0.0))


def as_instant(value: datetime | str | Column | None) -> Column:
    """Literal UTC instant from a datetime, ISO text or column."""
    if value is None:
        return F.lit(None).cast("timestamp")
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat() if isinstance(value, datetime) else value).cast("timestamp")


def now_or(as_of: datetime | str | Column | None) -> Column:
    """The given instant, or the query's current timestamp."""
    return F.current_timestamp() if as_of is None else as_instant(as_of)


def event_id(dataset: Column, route: Column, row: Column) -> Column:
    """SHA-256 over dataset, route and the row's entries in key order.

    Neither the order of the row's entries nor anything about the run takes part,
    so fetching the same row again gives the same id.
    """
    ordered = F.map_from_entries(F.array_sort(F.map_entries(row)))
    document = F.struct(dataset.alias("dataset"), route.alias("route"), ordered.alias("row"))
    return F.sha2(F.to_json(document, {"ignoreNullFields": "false"}), 256)


def grain_key(period: Column, entity: Column, dimension: Column) -> Column:
    """Text identity of a row: instant, entity and dimension."""
    return F.concat_ws(
        "|",
        F.date_format(period, GRAIN_TIME),
        F.coalesce(entity, F.lit("")),
        F.coalesce(dimension, F.lit("")),
    )
