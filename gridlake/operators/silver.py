"""Bronze payloads to typed, de-duplicated Silver rows. One operator, a spec per dataset."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import clean_text, clean_unit, now_or, parse_ts, to_number
from gridlake.functions.frames import evaluated_once
from gridlake.operators.quality import Allowed, Consistent, NotNull, QualityError, Rule, Unique
from gridlake.operators.rank import latest_of_few
from gridlake.schemas import FUEL_SPEC, MIN_RETENTION, POWER_SPEC, REGION_SPEC, DatasetSpec

_CONVERT = {"text": clean_text, "unit": clean_unit, "number": to_number}


def extract(
    bronze: DataFrame, spec: DatasetSpec, as_of: datetime | Column | None = None
) -> DataFrame:
    """Every row of the dataset with its payload typed, before anything is dropped."""
    payload = F.col("payload")
    return evaluated_once(
        bronze.filter(F.col("dataset") == spec.dataset),
        F.col("event_id"),
        parse_ts(payload["period"]).alias("period"),
        *[_CONVERT[f.kind](payload[f.key]).alias(f.column) for f in spec.fields],
        F.coalesce("ingestion_ts", now_or(as_of)).alias("loaded_at"),
    )


def clean(
    bronze: DataFrame, spec: DatasetSpec, as_of: datetime | Column | None = None
) -> DataFrame:
    """Rows with all required fields, newest per event."""
    return newest_complete(extract(bronze, spec, as_of), spec)


def newest_complete(typed: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The same from rows that ``extract`` has typed."""
    complete = typed.dropna(subset=list(spec.required))
    newest = latest_of_few(complete, ["event_id"], ["loaded_at", "period"])
    return newest.withColumn("event_date", F.to_date("period"))


def clean_region(bronze: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    return clean(bronze, REGION_SPEC, as_of)


def clean_fuel(bronze: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    return clean(bronze, FUEL_SPEC, as_of)


def clean_power(bronze: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    return clean(bronze, POWER_SPEC, as_of)


def extract_rules(spec: DatasetSpec) -> list[Rule]:
    """What must hold before rows are dropped: copies of one event agree."""
    return [Consistent(("event_id",), spec.versioned)]


def clean_rules(spec: DatasetSpec) -> list[Rule]:
    """What must hold of the cleaned table."""
    allowed = [Allowed(f.column, f.allowed) for f in spec.fields if f.allowed]
    return [NotNull(("event_id", *spec.required, "event_date")), *allowed, Unique(("event_id",))]


def retention(source_rows: DataFrame, cleaned: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row: distinct source events, cleaned rows and their ratio.

    ``source_rows`` are events of Bronze, or the typed rows of the dataset.
    """
    if "dataset" in source_rows.columns:
        source_rows = source_rows.filter(F.col("dataset") == spec.dataset)
    source = source_rows.agg(F.count_distinct("event_id").alias("source_events"))
    kept = cleaned.agg(F.count("*").alias("cleaned_rows")).scalar()
    return source.withColumn("cleaned_rows", kept).select(
        F.lit(spec.dataset).alias("dataset"),
        "source_events",
        "cleaned_rows",
        F.when(F.col("source_events") > 0, F.col("cleaned_rows") / F.col("source_events")).alias(
            "retention_ratio"
        ),
        F.when(F.col("source_events") == 0, True)
        .otherwise(F.col("cleaned_rows") / F.col("source_events") >= MIN_RETENTION)
        .alias("ok"),
    )


def check_retention(source_rows: DataFrame, cleaned: DataFrame, spec: DatasetSpec) -> None:
    """Raise when cleaning loses more of a window than it may."""
    row = retention(source_rows, cleaned, spec).first()
    if row["ok"]:
        return
    if row["cleaned_rows"] == 0:
        raise QualityError(f"{spec.table}: source rows were present, but no valid rows came out")
    raise QualityError(
        f"{spec.table}: only {row['cleaned_rows']} of {row['source_events']} source rows"
        f" were retained ({row['retention_ratio']:.1%})"
    )
