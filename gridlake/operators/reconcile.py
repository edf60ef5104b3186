"""Expected against stored keys, layer by layer."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.columns import grain_key, parse_ts
from gridlake.operators.rank import first_of_few
from gridlake.operators.silver import extract
from gridlake.operators.windowing import Bound, in_window
from gridlake.schemas import DEMAND, FORECAST, GRAIN_KEYS, DatasetSpec
from gridlake.sources.tables import materialized

# marts whose grain is a day
DAILY_MARTS = ("platinum.region_demand_daily", "platinum.resource_planning_daily")
HOURLY_MART = "platinum.grid_operations_hourly"
POWER_MART = "platinum.electric_power_operations_monthly"


def _dimension(columns: Sequence[str]) -> Column:
    if not columns:
        return F.lit("")
    if len(columns) == 1:
        return F.col(columns[0])
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def keys_of(df: DataFrame, time: str, entity: str, dimension: Sequence[str]) -> DataFrame:
    """(key, time, entity, dimension) of every row that has them."""
    named = df.select(
        F.col(time).cast("timestamp").alias("period_start_utc"),
        F.col(entity).alias("respondent"),
        _dimension(dimension).alias("dimension_value"),
    ).dropna()
    key = grain_key(F.col("period_start_utc"), F.col("respondent"), F.col("dimension_value"))
    return named.withColumn("grain_key", key).select(*GRAIN_KEYS.names)


def bronze_keys(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Keys of stored events, read from their payload; the raw message isn't opened."""
    source = {f.column: f.key for f in spec.fields}
    payload = F.col("payload")
    hourly = spec.frequency == "hourly"
    period = F.date_trunc("hour", "event_ts") if hourly else parse_ts(payload["period"])
    rows = bronze.filter(F.col("dataset_partition") == spec.dataset).select(
        period.alias("period"),
        *[payload[source[c]].alias(c) for c in (spec.entity, *spec.dimension)],
    )
    return keys_of(rows.dropna(), "period", spec.entity, spec.dimension)


def silver_keys(silver: DataFrame, spec: DatasetSpec) -> DataFrame:
    return keys_of(silver, "period", spec.entity, spec.dimension)


def gold_keys(gold: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Keys of a fact; demand and forecast share one row, so region has no dimension."""
    dimension = () if "type" in spec.dimension else spec.dimension
    return keys_of(gold, "period", spec.entity, dimension)


def mart_keys(mart: DataFrame, name: str) -> DataFrame:
    if name == POWER_MART:
        return keys_of(mart, "period", "location", ("sector_id", "fueltype_id"))
    return keys_of(mart, "date" if name in DAILY_MARTS else "period", "respondent", ())


def expected_keys(raw: DataFrame, spec: DatasetSpec, target: str) -> DataFrame:
    """Keys that ``target`` (a layer or a mart) should hold, derived from the raw feed.

    ``raw`` has the columns of a Bronze batch. Bronze expects every row with its text as
    fetched, Silver one trimmed row per complete event, Gold one per business key,
    marts one per row of their grain.
    """
    if target == "bronze":
        source = {f.column: f.key for f in spec.fields}
        rows = raw.filter(F.col("dataset") == spec.dataset).select(
            parse_ts(F.col("payload")["period"]).alias("period"),
            *[F.col("payload")[source[c]].alias(c) for c in (spec.entity, *spec.dimension)],
        )
        return keys_of(rows.dropna(), "period", spec.entity, spec.dimension)
    return expected_of_typed(extract(raw, spec), spec, target)


def expected_of_typed(rows: DataFrame, spec: DatasetSpec, target: str) -> DataFrame:
    """``expected_keys`` for a layer above Bronze, from rows that are already typed.

    For several targets of one feed: its payloads are then read once, into a stored stage.
    """
    complete = rows.dropna(subset=list(spec.expected))
    if target == "silver":
        events = first_of_few(complete, ["event_id"], [F.col("loaded_at"), F.col("period")])
        return keys_of(events, "period", spec.entity, spec.dimension)
    if spec.dimension != ("type",):
        distinct = complete.select(*spec.business_key).distinct()
        return keys_of(distinct, "period", spec.entity, spec.dimension)
    if target in DAILY_MARTS:
        days = complete.filter(F.col("type") == DEMAND).select(
            F.date_trunc("day", "period").alias("period"), "respondent"
        )
        return keys_of(days.distinct(), "period", "respondent", ())
    hours = complete.filter(F.col("type").isin(DEMAND, FORECAST)).select("period", "respondent")
    return keys_of(hours.distinct(), "period", "respondent", ())


def trim(keys: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """Keys of the half-open window."""
    return in_window(keys, "period_start_utc", start, end)


def matched(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per key of either side with its row count on both.

    Keys are counted before the join, so repeated keys shrink ahead of the shuffle
    and both sides of the join are unique.
    """

    def counted(keys: DataFrame, name: str) -> DataFrame:
        return keys.groupBy("grain_key").agg(
            F.min("period_start_utc").alias(f"{name}_period"),
            F.min("respondent").alias(f"{name}_respondent"),
            F.min("dimension_value").alias(f"{name}_dimension"),
            F.count("*").alias(f"{name}_rows"),
        )

    both = counted(expected, "expected").join(counted(actual, "actual"), "grain_key", "full_outer")
    return both.select(
        "grain_key",
        F.coalesce("expected_period", "actual_period").alias("period_start_utc"),
        F.coalesce("expected_respondent", "actual_respondent").alias("respondent"),
        F.coalesce("expected_dimension", "actual_dimension").alias("dimension_value"),
        F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
    )


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Keys on one side only, with the reason ``missing`` or ``extra``."""
    pairs = matched(expected, actual)
    reason = F.when(F.col("actual_rows") == 0, "missing").when(
        F.col("expected_rows") == 0, "extra"
    )
    return (
        pairs.withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select(*GRAIN_KEYS.names, "reason")
    )


def digests(keys: DataFrame) -> DataFrame:
    """One row per hour: rows, and sums and exclusive or of the keys' 64-bit hashes.

    Neither order nor partitioning takes part, and digests of parts add up to the digest of
    the whole. Equal digests mean equal keys, repeats included, but for a chance of 2**-64 or less.
    """
    mark = F.xxhash64("grain_key")
    return keys.groupBy(F.date_trunc("hour", "period_start_utc").alias("hour")).agg(
        F.count("*").alias("rows"),
        F.sum(F.shiftrightunsigned(mark, 32)).alias("high"),
        F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.bit_xor(mark).alias("mixed"),
    )


def differing_hours(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Hours whose digests differ, or that only one side has."""
    parts = ("rows", "high", "low", "mixed")

    def packed(side: DataFrame, name: str) -> DataFrame:
        return side.select("hour", F.struct(*parts).alias(name))

    both = packed(expected, "expected").join(packed(actual, "actual"), "hour", "full_outer")
    return both.filter(~F.col("expected").eqNullSafe(F.col("actual"))).select("hour")


KeyReader = Callable[[Collection[date] | None], DataFrame]


def reconcile_by_digests(expected: KeyReader, actual: KeyReader) -> DataFrame:
    """What ``reconcile`` gives, with only the days opened in which an hour differs.

    A reader returns the keys of the given days, of all with None. First each side is
    rolled up to a row per hour, which is all that is shuffled; then the keys of differing
    hours are compared. Gathered are days, as many as the data has.
    """
    hours = materialized(
        differing_hours(digests(expected(None)), digests(actual(None))), "differing-hours"
    )
    days = {row["day"] for row in hours.select(F.to_date("hour").alias("day")).distinct().collect()}

    def opened(read: KeyReader) -> DataFrame:
        keys = read(days)
        return keys.join(hours, F.date_trunc("hour", "period_start_utc") == F.col("hour"), "left_semi")

    return reconcile(opened(expected), opened(actual))


def _counts() -> list[Column]:
    return [
        F.coalesce(F.sum("expected_rows"), F.lit(0)).alias("expected_count"),
        F.coalesce(F.sum("actual_rows"), F.lit(0)).alias("actual_count"),
        F.count_if(F.col("actual_rows") == 0).alias("missing_count"),
        F.count_if(F.col("expected_rows") == 0).alias("extra_count"),
    ]


def by_period(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected, actual, missing and extra per period."""
    return matched(expected, actual).groupBy("period_start_utc").agg(*_counts())


def _status() -> Column:
    same_keys = (F.col("missing_count") == 0) & (F.col("extra_count") == 0)
    return (
        F.when((F.col("expected_count") == 0) & (F.col("actual_count") == 0), "not_populated")
        .when(same_keys & (F.col("expected_count") == F.col("actual_count")), "ok")
        .when(same_keys, "count_mismatch")
        .otherwise("mismatch")
    )


def summary(expected: DataFrame, actual: DataFrame, stage: str, dataset: str) -> DataFrame:
    """One row of totals with a status."""
    return snapshot([(stage, dataset, expected, actual)])


def snapshot(pairs: Sequence[tuple[str, str, DataFrame, DataFrame]]) -> DataFrame:
    """One row per (stage, dataset, expected, actual) comparison.

    Keys of all comparisons go through one grouped pass: they are counted per comparison,
    key and side before the shuffle, then rolled up to one row per comparison.
    """

    def tagged(number: int, keys: DataFrame, expected: bool) -> DataFrame:
        return keys.select(
            F.lit(number).alias("pair"),
            "grain_key",
            F.lit(int(expected)).alias("expected"),
            F.lit(int(not expected)).alias("actual"),
        )

    sides = [
        tagged(i, keys, expected)
        for i, (_, _, *both) in enumerate(pairs)
        for keys, expected in zip(both, (True, False), strict=True)
    ]
    rows = sides[0]
    for side in sides[1:]:
        rows = rows.unionByName(side)
    per_key = rows.groupBy("pair", "grain_key").agg(
        F.sum("expected").alias("expected_rows"), F.sum("actual").alias("actual_rows")
    )
    totals = per_key.groupBy("pair").agg(*_counts())
    # a row per comparison, also for those without a key
    named = rows.sparkSession.createDataFrame(
        [(i, stage, name) for i, (stage, name, _, _) in enumerate(pairs)],
        "pair int, stage string, dataset_id string",
    )
    counts = ["expected_count", "actual_count", "missing_count", "extra_count"]
    return (
        named.join(totals, "pair", "left")
        .fillna(0, counts)
        .select("stage", "dataset_id", _status().alias("status"), *counts)
    )
