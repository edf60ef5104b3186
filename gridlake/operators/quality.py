"""Data-quality rules, evaluated together.

All row rules of a table become one aggregate; rules on keys add one grouped
aggregate per key set. ``report`` is lazy, ``check`` runs it once and raises.

Row rules can also be counted while the table is written (``counting``), which leaves only
the rules on keys for a scan of what was written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A table broke at least one rule."""


@dataclass(frozen=True)
class Rule:
    @property
    def name(self) -> str:
        raise NotImplementedError

    @property
    def message(self) -> str:
        raise NotImplementedError


@dataclass(frozen=True)
class RowRule(Rule):
    """A rule that counts offending rows with one aggregate expression."""

    #: Whether the expression may be counted while rows pass by: no distinct values.
    passing: ClassVar[bool] = True

    def violations(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class KeyRule(Rule):
    """A rule about the rows that share ``keys``."""

    keys: tuple[str, ...]


def _bounds_text(low: float | None, high: float | None) -> str:
    sides = [f">= {low}" if low is not None else "", f"<= {high}" if high is not None else ""]
    return " and ".join(s for s in sides if s)


def _where_text(where: str | None) -> str:
    return f" where {where}" if where else ""


def _outside(column: str, low: float | None, high: float | None) -> Column:
    """True where the value is present and beyond a bound; null passes."""
    value, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return value.isNotNull() & bad


@dataclass(frozen=True)
class NonEmpty(RowRule):
    name = "non_empty"
    message = "produced no rows"

    def violations(self) -> Column:
        return F.when(F.count("*") == 0, 1).otherwise(0)


@dataclass(frozen=True)
class NotNull(RowRule):
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"not_null({','.join(self.columns)})"

    @property
    def message(self) -> str:
        return f"contains null values in required columns: {', '.join(self.columns)}"

    def violations(self) -> Column:
        missing = F.lit(False)
        for column in self.columns:
            missing = missing | F.col(column).isNull()
        return F.count_if(missing)


@dataclass(frozen=True)
class Allowed(RowRule):
    column: str
    values: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"allowed({self.column})"

    @property
    def message(self) -> str:
        return (
            f"contains unsupported values for {self.column}."
            f" Allowed values: {', '.join(self.values)}"
        )

    def violations(self) -> Column:
        return F.count_if(~F.col(self.column).isin(*self.values))


@dataclass(frozen=True)
class NonNegative(RowRule):
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"non_negative({','.join(self.columns)})"

    @property
    def message(self) -> str:
        return f"contains negative values in columns: {', '.join(self.columns)}"

    def violations(self) -> Column:
        bad = F.lit(False)
        for column in self.columns:
            bad = bad | _outside(column, 0.0, None)
        return F.count_if(bad)


@dataclass(frozen=True)
class Bounds(RowRule):
    column: str
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"bounds({self.column} {_bounds_text(self.low, self.high)})"

    @property
    def message(self) -> str:
        return (
            f"contains values outside bounds {_bounds_text(self.low, self.high)}"
            f" for column {self.column}"
        )

    def violations(self) -> Column:
        return F.count_if(_outside(self.column, self.low, self.high))


@dataclass(frozen=True)
class MinRows(RowRule):
    """At least ``least`` rows match ``where``; zero may be allowed."""

    least: int = 1
    where: str | None = None
    allow_empty: bool = False

    @property
    def name(self) -> str:
        return f"min_rows({self.least}){_where_text(self.where)}"

    @property
    def message(self) -> str:
        return f"expected at least {self.least} row(s)"

    def violations(self) -> Column:
        found = F.count_if(F.expr(self.where or "true"))
        short = F.greatest(F.lit(self.least) - found, F.lit(0))
        return F.when(found == 0, 0).otherwise(short) if self.allow_empty else short


@dataclass(frozen=True)
class MinDistinct(RowRule):
    """At least ``least`` distinct values of ``column`` among rows matching ``where``."""

    passing = False
    column: str
    least: int = 1
    where: str | None = None
    allow_empty: bool = False

    @property
    def name(self) -> str:
        return f"min_distinct({self.column} {self.least}){_where_text(self.where)}"

    @property
    def message(self) -> str:
        return f"expected at least {self.least} distinct value(s) of {self.column}"

    def violations(self) -> Column:
        found = F.count_distinct(F.when(F.expr(self.where or "true"), F.col(self.column)))
        short = F.greatest(F.lit(self.least) - found, F.lit(0))
        return F.when(found == 0, 0).otherwise(short) if self.allow_empty else short


@dataclass(frozen=True)
class BoundsWhere(Bounds):
    """Bounds on the rows matching ``where``."""

    where: str = "true"

    @property
    def name(self) -> str:
        return f"{super().name}{_where_text(self.where)}"

    def violations(self) -> Column:
        return F.count_if(F.expr(self.where) & _outside(self.column, self.low, self.high))


@dataclass(frozen=True)
class Unique(KeyRule):
    @property
    def name(self) -> str:
        return f"unique({','.join(self.keys)})"

    @property
    def message(self) -> str:
        return f"contains duplicate keys: {', '.join(self.keys)}"


@dataclass(frozen=True)
class Consistent(KeyRule):
    """Rows sharing a key agree on ``columns``."""

    columns: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"consistent({','.join(self.keys)}: {','.join(self.columns)})"

    @property
    def message(self) -> str:
        return (
            f"contains conflicting records for keys [{', '.join(self.keys)}]"
            f" across values [{', '.join(self.columns)}]"
        )


def _conflicting(columns: Sequence[str]) -> Column:
    """Whether a key's rows carry more than one version of ``columns``.

    The smallest and largest version differ exactly when there are two of them, so
    no set of versions is kept, however many rows a key has.
    """
    version = F.struct(*columns)
    return ~F.min(version).eqNullSafe(F.max(version))


def key_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Rows per key and whether they carry more than one version of ``columns``."""
    conflicting = _conflicting(columns) if columns else F.lit(False)
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), conflicting.alias("conflicting"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return key_counts(df, keys).filter(F.col("rows") > 1).select(*keys, "rows")


def conflicting_keys(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys whose rows disagree on ``columns``."""
    return key_counts(df, keys, columns).filter("conflicting").select(*keys, "rows")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows are repeats of an earlier row with the same key."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_count")
    )


def min_rows(df: DataFrame, least: int = 1, where: str | None = None) -> DataFrame:
    """One row: matching rows, the wanted minimum and whether it is met."""
    return df.agg(F.count_if(F.expr(where or "true")).alias("row_count")).select(
        "row_count", F.lit(least).alias("min_rows"), (F.col("row_count") >= least).alias("ok")
    )


def min_distinct(
    df: DataFrame, column: str, least: int = 1, where: str | None = None
) -> DataFrame:
    """One row: distinct values among matching rows, the wanted minimum, whether it is met."""
    found = F.count_distinct(F.when(F.expr(where or "true"), F.col(column)))
    return df.agg(found.alias("distinct_count")).select(
        "distinct_count",
        F.lit(least).alias("min_distinct"),
        (F.col("distinct_count") >= least).alias("ok"),
    )


def numeric_bounds(
    df: DataFrame,
    column: str,
    low: float | None = None,
    high: float | None = None,
    where: str | None = None,
) -> DataFrame:
    """One row: matching rows and how many of them lie outside the bounds."""
    match = F.expr(where or "true")
    return df.agg(
        F.count_if(match).alias("row_count"),
        F.count_if(match & _outside(column, low, high)).alias("invalid_count"),
    ).withColumn("ok", F.col("invalid_count") == 0)


class Counts:
    """What the row rules of a table have counted while it was written."""

    def __init__(self, observation: Observation | None) -> None:
        self._observation = observation

    def known(self) -> dict[int, int]:
        """Violations by position of the rule, once the table is written."""
        found = self._observation.get if self._observation else {}
        return {int(name[1:]): value for name, value in found.items() if value is not None}


def counting(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Counts]:
    """``df`` with its row rules counted by the first job that runs it.

    The frame returned has to be written with all of its rows, though not all columns: then the counts are taken in
    the tasks that write, each of which counts once even if it was tried more than once or
    an executor was lost. Below a shuffle a task that is run again would count twice.
    """
    watched = [(i, r) for i, r in enumerate(rules) if isinstance(r, RowRule) and r.passing]
    if not watched:
        return df, Counts(None)
    observation = Observation()
    totals = [r.violations().cast("bigint").alias(f"r{i}") for i, r in watched]
    return df.observe(observation, *totals), Counts(observation)


def read_later(df: DataFrame, rules: Sequence[Rule]) -> list[str]:
    """The columns of ``df`` that rules read which ``counting`` leaves, for a frame stored for them alone.

    All of them if another than a rule on keys is left: its condition may read any. One if none
    is left, as a file needs a column.
    """
    left = [r for r in rules if not (isinstance(r, RowRule) and r.passing)]
    if not all(isinstance(r, KeyRule) for r in left):
        return df.columns
    read = {c for r in left for c in (*r.keys, *(r.columns if isinstance(r, Consistent) else ()))}
    return [c for c in df.columns if c in read] or df.columns[:1]


def _results(
    df: DataFrame, rules: Sequence[Rule], known: Mapping[int, int] | None = None
) -> DataFrame:
    """(position, rule, violations) per rule. Rules may have equal names.

    Rules whose position is ``known`` are not counted again.
    """
    known = known or {}
    parts = []
    if known:
        one_row = df.sparkSession.range(1).select(
            *[F.lit(count).alias(f"r{i}") for i, count in known.items()]
        )
        parts.append(_as_rows(one_row, [(i, rules[i].name, f"r{i}") for i in known]))
    row_rules = [
        (i, r) for i, r in enumerate(rules) if isinstance(r, RowRule) and i not in known
    ]
    if row_rules:
        one_row = df.agg(*[r.violations().cast("bigint").alias(f"r{i}") for i, r in row_rules])
        parts.append(_as_rows(one_row, [(i, r.name, f"r{i}") for i, r in row_rules]))
    for keys in dict.fromkeys(r.keys for r in rules if isinstance(r, KeyRule)):
        about = [(i, r) for i, r in enumerate(rules) if isinstance(r, KeyRule) and r.keys == keys]
        consistent = [(i, r.columns) for i, r in about if isinstance(r, Consistent)]
        per_key = df.groupBy(*keys).agg(
            F.count("*").alias("rows"),
            *[_conflicting(columns).alias(f"conflicting{i}") for i, columns in consistent],
        )
        one_row = per_key.agg(
            F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("repeats"),
            *[F.count_if(f"conflicting{i}").alias(f"conflicts{i}") for i, _ in consistent],
        )
        named = [
            (i, r.name, "repeats" if isinstance(r, Unique) else f"conflicts{i}") for i, r in about
        ]
        parts.append(_as_rows(one_row, named))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def report(
    df: DataFrame, rules: Sequence[Rule], known: Mapping[int, int] | None = None
) -> DataFrame:
    """One row per rule: its name and number of violations. Lazy."""
    return _results(df, rules, known).select("rule", "violations")


def _as_rows(one_row: DataFrame, named: Sequence[tuple[int, str, str]]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("rule"),
            F.col(column).cast("bigint").alias("violations"),
        )
        for position, name, column in named
    ]
    return one_row.select(F.inline(F.array(*rows)))


def check(
    df: DataFrame, rules: Sequence[Rule], label: str, known: Mapping[int, int] | None = None
) -> None:
    """Raise ``QualityError`` naming every broken rule.

    One job, one row per rule back; no job if all rules are ``known``.
    """
    found = dict(known or {})
    if any(i not in found for i in range(len(rules))):
        found = {r["position"]: r["violations"] for r in _results(df, rules, found).collect()}
    broken = [(rule, found[i]) for i, rule in enumerate(rules) if found[i]]
    if broken:
        raise QualityError(
            "; ".join(f"{label} {rule.message} ({count} found)" for rule, count in broken)
        )


def union_reports(reports: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Several tables' reports as one, labelled by table."""
    labelled = [df.select(F.lit(name).alias("table_name"), "*") for name, df in reports]
    result = labelled[0]
    for part in labelled[1:]:
        result = result.unionByName(part)
    return result
