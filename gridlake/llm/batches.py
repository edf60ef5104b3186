"""Running a Python function over Arrow batches of a narrow frame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows of whole texts a Python function is given at once.
TEXT_ROWS = 500


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of 1 to ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_partitions(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    rows: int = TEXT_ROWS,
) -> DataFrame:
    """``function`` over the batches of each partition, at most ``rows`` rows each.

    What Spark sends is cut up here, so the bound belongs to this frame alone and the
    session's settings stay as they are; Spark bounds the bytes of what it sends
    (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB unless set).
    """
    return df.mapInArrow(lambda batches: function(sliced(batches, rows)), schema)


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    rows: int = TEXT_ROWS,
) -> DataFrame:
    """``function`` over batches of at most ``rows`` rows."""
    return map_partitions(df, lambda batches: map(function, batches), schema, rows)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a column as UTF-8 bytes; null as empty."""
    texts = batch.column(name).cast(pa.large_binary()).to_pylist()
    return [b"" if text is None else text for text in texts]
