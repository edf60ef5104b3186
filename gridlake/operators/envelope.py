"""Raw feed rows to event envelopes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import event_id, iso_utc, normalize_period, now_or
from gridlake.schemas import ENVELOPE, ENVELOPE_SOURCE, DatasetSpec

SAMPLE_ERRORS = 5


class InvalidRows(ValueError):
    """The feed held rows whose period does not parse."""


def envelope(
    spec: DatasetSpec,
    row: Column,
    run_id: str,
    window_start: str,
    window_end: str,
    ingested_at: datetime | str | Column | None = None,
) -> Column:
    """The envelope of a feed row, given as a map of text to text.

    A period that does not parse leaves ``event_timestamp`` null; ``split_invalid``
    separates those.
    """
    metadata = {
        "frequency": F.lit(spec.frequency),
        "route": F.lit(spec.route),
        "respondent": row["respondent"],
        "ingestion_run_id": F.lit(run_id),
        "source_window_start": F.lit(window_start),
        "source_window_end": F.lit(window_end),
    }
    return F.struct(
        event_id(F.lit(spec.dataset), F.lit(spec.route), row).alias("event_id"),
        F.lit(spec.dataset).alias("dataset"),
        F.lit(ENVELOPE_SOURCE).alias("source"),
        normalize_period(row["period"]).alias("event_timestamp"),
        iso_utc(now_or(ingested_at)).alias("ingestion_timestamp"),
        F.create_map(*[x for k, v in metadata.items() for x in (F.lit(k), v)]).alias("metadata"),
        row.alias("payload"),
    )


def build_envelopes(
    rows: DataFrame,
    spec: DatasetSpec,
    run_id: str,
    window_start: str,
    window_end: str,
    ingested_at: datetime | str | Column | None = None,
) -> DataFrame:
    """One envelope per feed row; ``rows`` has a map column ``row``."""
    built = envelope(spec, F.col("row"), run_id, window_start, window_end, ingested_at)
    return rows.select(built.alias("envelope")).select("envelope.*")


def envelope_json(value: Column) -> Column:
    """Compact JSON of an envelope, nulls written out."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def split_invalid(envelopes: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) envelopes; ``strict`` raises with a few samples if any is invalid."""
    valid = envelopes.filter(F.col("event_timestamp").isNotNull())
    invalid = envelopes.filter(F.col("event_timestamp").isNull()).select(
        "*",
        F.concat(
            F.lit("Invalid period value: "),
            F.coalesce(F.col("payload")["period"], F.lit("null")),
        ).alias("error"),
    )
    if strict:
        samples = invalid.limit(SAMPLE_ERRORS).select("error").collect()
        if samples:
            listed = "; ".join(row["error"] for row in samples)
            raise InvalidRows(f"Validation failed for {invalid.count()} rows. Samples: {listed}")
    return valid, invalid


def to_messages(envelopes: DataFrame) -> DataFrame:
    """Keyed messages: event id as key, compact JSON as value."""
    return envelopes.select(
        F.col("event_id").alias("key"),
        envelope_json(F.struct(*ENVELOPE.names)).alias("value"),
    )
