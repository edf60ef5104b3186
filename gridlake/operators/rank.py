"""Choosing one version per key, merging versions and upserting by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"
_INCOMING = "_incoming"


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    shuffle as well: each map task sends at most one row per key, so a key that
    owns a third of the table costs no more than any other.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def latest_by_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest version of each key; ``newest`` should end in a tiebreaker."""
    return first_by_key(df, keys, [F.col(c).desc_nulls_last() for c in newest])


def first_of_few(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``first_by_key`` for keys with a handful of rows each, such as the ids of events.

    There a limit ahead of the shuffle drops next to nothing, but sorts all rows of a map
    task for it, and a task that reads a large part of a file spills them. So the rows are
    dealt by their keys first, and only the parts that come of it are sorted. A key with
    many rows gives the same result, but they all meet in one task.
    """
    return first_by_key(df.repartition(*keys), keys, order)


def latest_of_few(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """``latest_by_key`` for keys with a handful of rows each."""
    return first_of_few(df, keys, [F.col(c).desc_nulls_last() for c in newest])


def at_newest(
    stored: DataFrame, keys: Sequence[str], time: str, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The rows of each key's newest ``time``, null if it has no other: its latest is among them.

    For a stored table, which is read twice, with many rows per key. The newest times are a
    hashed aggregate over few columns; ``keep`` stores them, so their measured size decides on
    a broadcast. The table's rows are then neither sorted nor moved to thin them out.
    """
    named = {c: f"_newest_{c}" for c in (*keys, time)}
    newest = stored.groupBy(*keys).agg(F.max(time).alias(time)).withColumnsRenamed(named)
    on = [F.col(c).eqNullSafe(F.col(n)) for c, n in named.items()]
    return stored.join(keep(newest), on, "left_semi")


def merge_latest(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """Union of two versions of a table, newest row per key; on a tie the incoming wins.

    Columns that one side lacks are filled with nulls.
    """
    both = existing.withColumn(_INCOMING, F.lit(False)).unionByName(
        incoming.withColumn(_INCOMING, F.lit(True)), allowMissingColumns=True
    )
    return latest_by_key(both, keys, [*newest, _INCOMING]).drop(_INCOMING)


def upsert(
    target: DataFrame,
    stage: DataFrame,
    conflict_cols: Sequence[str],
    insert_cols: Sequence[str] | None = None,
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """``target`` after inserting ``stage``, updating rows whose key is present.

    New rows carry ``insert_cols`` and nulls elsewhere; present rows take only
    ``update_cols`` from the stage. Both sides hold a key at most once, so one full
    outer join on the key is enough and cannot be skewed. A null in a key is a value.
    """
    insert_cols = list(insert_cols or stage.columns)
    if update_cols is None:
        update_cols = [c for c in insert_cols if c not in conflict_cols]
    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = stage.select(*insert_cols).withColumn("_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in conflict_cols]

    def merged(name: str) -> Column:
        if name in conflict_cols:
            return F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}"))
        if name not in insert_cols:
            return F.col(f"t.{name}")
        if name in update_cols:
            return F.when(F.col("_s"), F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        return F.when(F.col("_t"), F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))

    return t.join(s, on, "full_outer").select(*[merged(c).alias(c) for c in target.columns])
