"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # ids that streams remember are kept on disk, not on the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app: str, master: str | None = None, shuffle_partitions: int | None = None, **conf: str
) -> SparkSession:
    """Create a UTC, adaptive session.

    Master, credentials and sizes belong to ``spark-submit``. Give
    ``shuffle_partitions`` generously on a cluster (about shuffle bytes / 128 MB):
    adaptive execution merges the small ones, but cannot split one that is too big
    outside of a join.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Put the session in UTC: dates, hours and text forms of instants depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution inside of the block, whatever the session has.

    A stream with state plans its batches without it, and the session of a batch hands that on
    to what is done with the batch: rebalancing is then left out, so that each task writes a
    file into each partition of a table.
    """
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine; on a cluster
    a missing setting is an error, since other machines would not see that folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="gridlake-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
