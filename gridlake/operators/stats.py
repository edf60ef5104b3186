"""Group statistics, row offsets and quantiles that do not gather a group in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.sources.tables import materialized


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """``df`` plus one column per aggregate over its group.

    An unordered window over the group would bring all of its rows to one task. Here
    the aggregate is combined before its shuffle and its one row per group stored and
    joined back. The stored side has a measured size, so the join is planned as a
    broadcast where that size allows it and the rows of ``df`` do not move; a larger
    side is joined by shuffle, where adaptive execution splits hot partitions.
    """
    per_group = df.groupBy(*keys).agg(*[stat.alias(name) for name, stat in stats.items()])
    return df.join(materialized(per_group, "group-stats"), list(keys), "left")


def with_previous(
    df: DataFrame, value: str, entity: str, order: str, chunk: Column, name: str
) -> DataFrame:
    """``df`` plus ``name``: the value of the entity's previous row under ``order``.

    A window over the entity alone would bring its whole history to one task, so
    rows are windowed by (entity, chunk), where ``chunk`` is a coarser unit of
    ``order`` such as its month. The first row of a chunk takes the last value of
    the entity's previous chunk, carried over from one row per chunk.
    """
    chunked = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(entity, "_chunk").orderBy(order)
    rows = chunked.withColumn("_prev", F.lag(value).over(inside)).withColumn(
        "_row", F.row_number().over(inside)
    )
    last = chunked.groupBy(entity, "_chunk").agg(F.max_by(value, order).alias("_last"))
    carried = last.select(
        entity,
        "_chunk",
        F.lag("_last").over(Window.partitionBy(entity).orderBy("_chunk")).alias("_carried"),
    )
    return (
        rows.join(carried, [entity, "_chunk"], "left")
        .withColumn(name, F.when(F.col("_row") == 1, F.col("_carried")).otherwise(F.col("_prev")))
        .drop("_chunk", "_prev", "_row", "_carried")
    )


def scalar_struct(one_row: DataFrame) -> Column:
    """The only row of a global aggregate as a struct-valued scalar subquery."""
    return one_row.select(F.struct(*one_row.columns)).scalar()


def with_scalars(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """``df`` plus a struct column holding the only row of ``one_row``; no join."""
    return df.withColumn(name, scalar_struct(one_row))


def unpivot_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide to long: ``keep``, metric name and non-null value."""
    return df.unpivot(
        [F.col(c) for c in keep],
        [F.col(c).cast("double").alias(c) for c in columns],
        "metric",
        "value",
    ).filter(F.col("value").isNotNull() & ~F.isnan("value"))


#: Bins a range is cut into per pass, and the distinct values of a range that are put in order.
BINS, ORDERED = 32, 10_000


@dataclass(frozen=True)
class _Range:
    """Where a rank lies: values of ``metric`` above ``low`` and up to ``high`` (None: no bound).

    ``before`` rows come ahead of the range; ``distinct`` values are in it.
    """

    metric: str
    rank: int
    low: float | None
    high: float | None
    before: int
    distinct: int

    def holds(self) -> Column:
        inside = F.col("metric") == self.metric
        if self.low is not None:
            inside &= F.col("value") > F.lit(self.low)
        if self.high is not None:
            inside &= F.col("value") <= F.lit(self.high)
        return inside


def _bin(borders: Sequence[float], first: int = 0) -> Column:
    """The number of borders below the value, by halving."""
    if not borders:
        return F.lit(first)
    middle = len(borders) // 2
    above = F.col("value") > F.lit(borders[middle])
    return F.when(above, _bin(borders[middle + 1 :], first + middle + 1)).otherwise(
        _bin(borders[:middle], first)
    )


def _narrowed(counted: DataFrame, ranges: Sequence[_Range]) -> list[_Range]:
    """Each range cut at about equal numbers of distinct values; the part that holds its rank.

    Two aggregates over all ranges at once. What comes back is BINS rows per range.
    """
    points = [i / BINS for i in range(1, BINS)]
    cuts = counted.agg(
        *[
            F.percentile_approx(F.when(r.holds(), F.col("value")), points, 50 * BINS).alias(f"r{i}")
            for i, r in enumerate(ranges)
        ]
    ).first()
    borders = [sorted(set(cuts[f"r{i}"] or [])) for i in range(len(ranges))]
    placed = F.array(
        *[
            F.when(r.holds(), F.struct(F.lit(i).alias("range"), _bin(borders[i]).alias("bin")))
            for i, r in enumerate(ranges)
        ]
    )
    counts = (
        counted.select("rows", F.inline(F.array_compact(placed)))
        .groupBy("range", "bin")
        .agg(F.sum("rows").alias("rows"), F.count("*").alias("distinct"))
        .collect()
    )
    found = []
    for i, r in enumerate(ranges):
        before = r.before
        for row in sorted((row for row in counts if row["range"] == i), key=lambda row: row["bin"]):
            if r.rank < before + row["rows"]:
                at = row["bin"]
                low = borders[i][at - 1] if at else r.low
                high = borders[i][at] if at < len(borders[i]) else r.high
                found.append(_Range(r.metric, r.rank, low, high, before, row["distinct"]))
                break
            before += row["rows"]
    return found


def exact_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row with an exact, linearly interpolated quantile per name.

    ``wanted`` maps a result name to (column, probability). Nulls and NaN do not
    count; a column without values gives null. Distinct values are counted and stored,
    so a value that very many rows share is one row. The range that holds a rank is cut
    at sampled borders, and its part with the rank cut again, until no more than ORDERED
    distinct values are left; these alone are put in order. So no task orders more than
    that, whatever the number of rows or of shuffle partitions, and every size takes this path.
    """
    columns = sorted({column for column, _ in wanted.values()})
    values = unpivot_values(df, columns)
    counted = materialized(
        values.groupBy("metric", "value").agg(F.count("*").alias("rows")), "quantiles"
    )
    sizes = {
        row["metric"]: (row["rows"], row["distinct"])
        for row in counted.groupBy("metric")
        .agg(F.sum("rows").alias("rows"), F.count("*").alias("distinct"))
        .collect()
    }
    places = {
        name: (column, p * (sizes[column][0] - 1))
        for name, (column, p) in wanted.items()
        if column in sizes
    }
    ranks = {(c, f(rank)) for c, rank in places.values() for f in (math.floor, math.ceil)}
    ranges = [_Range(c, rank, None, None, 0, sizes[c][1]) for c, rank in sorted(ranks)]
    while wide := [r for r in ranges if r.distinct > ORDERED]:
        narrow = _narrowed(counted, wide)
        if [r.distinct for r in narrow] == [r.distinct for r in wide]:
            break  # borders no longer tell values apart
        ranges = [r for r in ranges if r.distinct <= ORDERED] + narrow
    null = F.lit(None).cast("double")
    if not ranges:
        return counted.agg(*[F.max(null).alias(name) for name in wanted])
    listed = F.array(
        *[
            F.when(r.holds(), F.struct(F.lit(i).alias("range"), F.lit(r.rank - r.before).alias("within")))
            for i, r in enumerate(ranges)
        ]
    )
    inside = Window.partitionBy("range").orderBy("value")
    found = (
        counted.select("value", "rows", F.inline(F.array_compact(listed)))
        .withColumn("reached", F.sum("rows").over(inside))
        .filter(F.col("reached") > F.col("within"))
        .groupBy("range")
        .agg(F.min("value").alias("value"))
    )
    number = {(r.metric, r.rank): i for i, r in enumerate(ranges)}

    def at(column: str, rank: int) -> Column:
        return F.max(F.when(F.col("range") == number[column, rank], F.col("value")))

    def quantile(name: str) -> Column:
        if name not in places:
            return F.max(null)
        column, rank = places[name]
        low, high = at(column, math.floor(rank)), at(column, math.ceil(rank))
        return low + (high - low) * F.lit(rank - math.floor(rank))

    return found.agg(*[quantile(name).alias(name) for name in wanted])
