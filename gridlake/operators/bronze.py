"""Messages to replay-safe Bronze batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import now_or, parse_ts
from gridlake.functions.frames import evaluated_once
from gridlake.operators.rank import first_by_key
from gridlake.schemas import BRONZE, BRONZE_PARTITIONS, ENVELOPE


def decode(messages: DataFrame, loaded_at: datetime | Column | None = None) -> DataFrame:
    """Every message as a Bronze row, including those that cannot be used."""
    opened = messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    events = evaluated_once(
        opened, F.from_json("raw_json", ENVELOPE).alias("event"), keep=tuple(opened.columns)
    )
    timed = events.select("*", "event.*").withColumns(
        {
            "event_ts": parse_ts(F.col("event_timestamp")),
            "ingestion_ts": parse_ts(F.col("ingestion_timestamp")),
            "bronze_loaded_at": now_or(loaded_at),
            "dataset_partition": F.col("dataset"),
        }
    )
    at = F.col("event_ts")
    return timed.withColumns(
        {
            "event_date": F.to_date(at),
            "event_year": F.year(at),
            "event_month": F.month(at),
            "event_day": F.dayofmonth(at),
            "event_hour": F.hour(at),
        }
    ).select(*BRONZE.names)


def usable() -> Column:
    """Rows with an id, a dataset and a time. Bad JSON decodes to nulls, so it fails too."""
    return (
        F.col("event_id").isNotNull() & F.col("dataset").isNotNull() & F.col("event_ts").isNotNull()
    )


def parse_envelope(messages: DataFrame, loaded_at: datetime | Column | None = None) -> DataFrame:
    """The usable messages as Bronze rows."""
    return decode(messages, loaded_at).filter(usable())


def rejected(messages: DataFrame, loaded_at: datetime | Column | None = None) -> DataFrame:
    """The messages ``parse_envelope`` leaves out, for the quarantine table."""
    return refusals(decode(messages, loaded_at))


def refusals(decoded: DataFrame) -> DataFrame:
    """The rows of ``decode`` that cannot be used."""
    return decoded.filter(~usable()).select(
        "raw_json",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "bronze_loaded_at",
    )


def next_offsets(messages: DataFrame) -> DataFrame:
    """Where the next read of each topic partition starts."""
    return messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset")
    )


def dedupe_batch(batch: DataFrame) -> DataFrame:
    """One row per event: the one with the lowest partition and offset."""
    return first_by_key(
        batch, ["event_id"], [F.col("kafka_partition").asc(), F.col("kafka_offset").asc()]
    )


def touched_partitions(batch: DataFrame) -> DataFrame:
    return batch.select(*BRONZE_PARTITIONS).distinct()


def replay_safe_batch(batch: DataFrame, existing_ids: DataFrame) -> DataFrame:
    """One row per event of the batch that Bronze does not hold yet."""
    return dedupe_batch(batch).join(existing_ids.select("event_id"), "event_id", "left_anti")


def write_plan(batch: DataFrame, existing_ids: DataFrame) -> DataFrame:
    """One row of counts: transformed, duplicates, to write, touched partitions."""
    place = F.struct(*BRONZE_PARTITIONS)
    first = F.struct("kafka_partition", "kafka_offset")
    per_event = batch.groupBy("event_id").agg(
        F.count("*").alias("rows"), F.min_by(place, first).alias("place")
    )
    known = existing_ids.select("event_id").distinct().withColumn("known", F.lit(True))
    marked = per_event.join(known, "event_id", "left")
    return marked.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("transformed_count"),
        F.count_if(F.col("known").isNull()).alias("write_count"),
        F.count_distinct("place").alias("touched_partition_count"),
    ).select(
        "transformed_count",
        (F.col("transformed_count") - F.col("write_count")).alias("duplicate_count"),
        "write_count",
        "touched_partition_count",
    )
