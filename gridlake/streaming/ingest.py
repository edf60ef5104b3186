"""Topic to Bronze as a bounded, resumable stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.bronze import (
    decode,
    refusals,
    replay_safe_batch,
    usable,
)
from gridlake.schemas import BRONZE, BRONZE_PARTITIONS, MESSAGE
from gridlake.session import adaptive
from gridlake.sources import notes
from gridlake.sources.tables import append_partitioned, read_bronze_days, read_table


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = True,
    **options: str,
) -> DataFrame:
    """A topic as a stream. Offsets that the topic has lost are an error, unless waived.

    ``latest`` as the first start would skip what the topic already holds, so it is
    read as ``earliest``. A restart continues from the checkpoint in any case.
    Bound each batch with ``maxOffsetsPerTrigger``.
    """
    if starting.strip().lower() == "latest":
        starting = "earliest"
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
        .load()
    )


def read_topic_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A folder of parquet files with the columns of a topic, as a stream."""
    return spark.readStream.schema(MESSAGE).options(**options).parquet(path)


def existing_ids(spark: SparkSession, batch: DataFrame, bronze_path: str) -> DataFrame:
    """Ids stored in the hour partitions that ``batch`` touches.

    Only the day folders the batch touches are listed; at most one path per dataset and day
    of its events comes to the driver. Hours are then met by a join on partition columns.
    """
    days = batch.select(*BRONZE_PARTITIONS[:-1]).distinct().collect()
    stored = read_bronze_days(spark, bronze_path, days)
    hours = batch.select(*BRONZE_PARTITIONS).distinct()
    return (
        stored.join(hours, list(BRONZE_PARTITIONS), "left_semi").select("event_id").distinct()
    )


def without_replays(decoded: DataFrame, window: str) -> DataFrame:
    """A decoded stream without events that came before, up to ``window`` ago.

    The state holds ids for that long, counted from the time of the batch, so no row is
    ever late and none is dropped but copies. Copies that come later pass, and meet the
    stored ids as all rows do. Messages that cannot be used pass too. Of copies in one batch any
    may stay.
    """
    place = F.struct("kafka_topic", "kafka_partition", "kafka_offset")
    keyed = decoded.withColumns(
        {
            "_event": F.when(usable(), F.col("event_id")),
            "_place": F.when(~usable(), place),
            "_seen": F.current_timestamp(),
        }
    )
    first = keyed.withWatermark("_seen", window).dropDuplicatesWithinWatermark(["_event", "_place"])
    return first.drop("_event", "_place", "_seen")


def write_batch(messages: DataFrame, bronze_path: str, quarantine_path: str) -> None:
    """Append the batch's new events; keep the unusable messages aside.

    Running it again on the same messages adds no event: what was stored is found
    by its id. So a batch that failed half way can simply be repeated. The days of all its
    events, also of those stored before, are noted after they are in place.
    """
    # a part of a file may unpack to gigabytes of rows, which one task would keep and read
    write_decoded(decode(messages.hint("rebalance")), bronze_path, quarantine_path)


def write_decoded(decoded: DataFrame, bronze_path: str, quarantine_path: str) -> None:
    """The same from messages that have been decoded.

    Adaptively, also where the batch comes from a stream with state: few files per hour.
    """
    with adaptive(decoded.sparkSession):
        _write(decoded, bronze_path, quarantine_path)


def _write(decoded: DataFrame, bronze_path: str, quarantine_path: str) -> None:
    spark = decoded.sparkSession
    decoded = decoded.persist()  # JSON is opened once, its rows used four times
    try:
        events = decoded.filter(usable())
        fresh = replay_safe_batch(events, existing_ids(spark, events, bronze_path))
        append_partitioned(fresh, bronze_path)
        notes.leave(events, bronze_path)
        refused = refusals(decoded)
        place = ["kafka_topic", "kafka_partition", "kafka_offset"]
        # a replayed message keeps its time, so older rows of the quarantine are skipped
        oldest = refused.agg(F.min("kafka_timestamp")).scalar()
        known = read_table(spark, quarantine_path, refused.schema).filter(
            F.col("kafka_timestamp") >= oldest
        )
        new = refused.join(known.select(*place), place, "left_anti")
        new.write.mode("append").parquet(quarantine_path)
    finally:
        decoded.unpersist()


def ingest_available_now(
    stream: DataFrame,
    bronze_path: str,
    quarantine_path: str,
    checkpoint: str,
    replay_window: str | None = None,
) -> None:
    """Take everything the source holds now, then stop. A rerun starts where this ended.

    With ``replay_window``, for instance ``"2 hours"``, events replayed within it are dropped
    before they are looked up in Bronze. A checkpoint is used with or without it, not both.
    """
    write = write_batch
    if replay_window:
        stream, write = without_replays(decode(stream), replay_window), write_decoded
    query = (
        stream.writeStream.foreachBatch(
            lambda batch, _: write(batch, bronze_path, quarantine_path)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
