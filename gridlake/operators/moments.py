"""Counts, means and squared deviations that combine over days.

Statistics of any lookback follow from one row per group and day, so a change of one day
reads that day alone. Days are combined by the parallel-variance rule, which never
subtracts large sums from each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "moment_day"


def day_moments(df: DataFrame, by: str, columns: Sequence[str], time: str = "period") -> DataFrame:
    """One row per ``by`` and day: for each column a struct (n, mean, m2) of its values.

    Nulls are no values: a day without any has n = 0 and a mean of 0.
    """

    def moments(name: str) -> Column:
        n = F.count(name)
        mean = F.coalesce(F.avg(name), F.lit(0.0))
        m2 = F.coalesce(F.var_pop(name), F.lit(0.0)) * n
        return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2")).alias(name)

    return df.groupBy(by, F.to_date(time).alias(DAY)).agg(*[moments(name) for name in columns])


def _merge(one: Column, other: Column) -> Column:
    """The moments of two disjoint sets of values as those of their union."""
    n = one["n"] + other["n"]
    delta = other["mean"] - one["mean"]
    share = other["n"] / n
    merged = F.struct(
        n.alias("n"),
        (one["mean"] + delta * share).alias("mean"),
        (one["m2"] + other["m2"] + delta * delta * one["n"] * share).alias("m2"),
    )
    return F.when(other["n"] > 0, merged).otherwise(one)


def _combined(name: str) -> Column:
    """The moments of a group of days, folded in the order of the days."""
    days = F.sort_array(F.collect_list(F.struct(F.col(DAY).alias("day"), F.col(name).alias("of"))))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(days, none, lambda acc, day: _merge(acc, day["of"])).alias(name)


def over_all_days(moments: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Moments of the whole history, one row per ``by``; gathers one small row per day."""
    return moments.groupBy(by).agg(*[_combined(name) for name in columns])


def over_trailing_days(
    moments: DataFrame, by: str, columns: Sequence[str], days: int
) -> DataFrame:
    """Moments of each day and the ``days`` - 1 before it, one row per ``by`` and day.

    Each day's row is sent to the days it counts for: ``days`` small rows per group and day,
    and no window over a group's history.
    """
    own = moments.select(by, F.col(DAY).alias("target"))
    spread = moments.withColumn(
        "target", F.explode(F.sequence(F.col(DAY), F.date_add(F.col(DAY), days - 1)))
    )
    return (
        spread.join(own, [by, "target"], "left_semi")
        .groupBy(by, "target")
        .agg(*[_combined(name) for name in columns])
        .withColumnRenamed("target", DAY)
    )


def _score(value: Column, moments: Column) -> Column:
    """(x - mean) / population std; 0 where the std is 0 or there is none."""
    std = F.sqrt(moments["m2"] / moments["n"])
    spread = (moments["n"] > 0) & (moments["m2"] > 0)
    return F.when(spread, (value - moments["mean"]) / std).otherwise(0.0)


def zscores_from_moments(
    df: DataFrame, moments: DataFrame, by: str, named: Mapping[str, str], days: int | None = None,
    time: str = "period",
) -> DataFrame:
    """``df`` plus z-scores against its ``by``: over all days, or the ``days`` up to its own.

    ``moments`` are those of the days wanted, best stored. The scores are those that an
    aggregate over the rows themselves would give.
    """
    columns = list(dict.fromkeys(named.values()))
    if days is None:
        stats, keys = over_all_days(moments, by, columns), [by]
    else:
        stats, keys = over_trailing_days(moments, by, columns, days), [by, DAY]
    renamed = stats.select(*keys, F.struct(*columns).alias("_moments"))
    joined = df.withColumn(DAY, F.to_date(time)).join(renamed, keys, "left")
    scores = {name: _score(F.col(c), F.col(f"_moments.{c}")) for name, c in named.items()}
    return joined.withColumns(scores).drop("_moments", DAY)
