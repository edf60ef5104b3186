"""Repair of conversation structure by aligning turns with an alternating grammar.

A sound conversation's role initials read ``(s?(ua)+)?``: an optional system turn, then pairs
of user and assistant. Turns are aligned with every feasible length of that string by the
Wagner-Fischer recurrence. Edits, with their initials and costs:

* Keep: 0 if the role's initial is the wanted one.
* Rerole to user or assistant: 1.
* Delete: 2, and the only choice for blank and duplicate turns.
* Insert an empty user or assistant turn: 5.
* A truncated turn that is not deleted adds 5.

Counted from the end, all lengths share one table: with ``r`` symbols to go the next one is
``u`` if ``r`` is even, else ``a``. A cost ``c`` pays for at most c / 2 deletions and c / 5
insertions, so with the cost of a plain left-to-right repair as the incumbent only that band
around the diagonal is computed (Ukkonen). The backtraces of all cheapest lengths are walked
together and compared letter by letter; the ASCII-least audit wins.

What one task holds of a conversation is a letter and a place per turn, never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.batches import map_partitions
from gridlake.sources.tables import materialized

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: The white space of a blank turn: blank, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: Table rows kept; those between are computed again when the backtrace comes to them.
STRIDE = 256
_FAR = np.int64(1) << 60
_LEGAL = ("su", "ua", "au")


# --- the alignment of one conversation ----------------------------------------


def _plain_cost(initials: str, faults: str) -> int:
    """The cost of one valid repair: faulty turns go, others are made to alternate."""
    cost = turns = system = 0
    for initial, fault in zip(initials, faults, strict=True):
        if fault != "-":
            cost += DELETE
        elif initial == "s" and not turns and not system:
            system = 1
        else:
            cost += REROLE * (initial != "ua"[turns % 2])
            turns += 1
    if turns % 2:
        cost += INSERT
    elif system and not turns:
        cost += DELETE
    return min(cost, DELETE * len(initials))


class _Band:
    """The cost-to-go table within the band that ``limit`` allows.

    Row i holds, at q, the cost of aligning turns i.. with the last ``r`` symbols, where
    r = q + n - i - left.
    """

    def __init__(self, initials: str, faults: str, limit: int) -> None:
        self.initials, self.faults, self.n = initials, faults, len(initials)
        self.left = limit // DELETE
        self.q = np.arange(self.left + limit // INSERT + 1, dtype=np.int64)
        self.kept: dict[int, np.ndarray] = {}
        self.open: tuple[int, list[np.ndarray]] = (-1, [])
        self.system = _FAR * np.ones(self.n + 1, np.int64)  # cost to go before any symbol
        self._fill()

    def symbols(self, i: int) -> np.ndarray:
        return self.q + (self.n - i - self.left)

    def _closed(self, base: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Adds insertions: the least of base[r'] + 5 (r - r') over r' <= r."""
        base = np.where(r >= 0, base, _FAR)
        return np.minimum(np.minimum.accumulate(base - INSERT * r) + INSERT * r, _FAR)

    def _last(self) -> np.ndarray:
        r = self.symbols(self.n)
        return self._closed(np.where(r == 0, 0, _FAR), r)

    def met(self, i: int, r: np.ndarray | int) -> Any:
        """The cost of letting turn i stand where ``r`` symbols are to go."""
        wrong = (np.asarray(r) % 2 == 0) != (self.initials[i] == "u")
        if self.initials[i] not in "ua":
            wrong = np.ones_like(wrong)
        return wrong * REROLE + (TRUNCATED if self.faults[i] == "t" else 0)

    def _row(self, i: int, after: np.ndarray) -> np.ndarray:
        r = self.symbols(i)
        base = np.append(after[1:], _FAR) + DELETE
        if self.faults[i] != "x":
            base = np.minimum(base, after + self.met(i, r))
        return self._closed(base, r)

    def _fill(self) -> None:
        row = self._last()
        self.kept[self.n] = row
        for i in range(self.n - 1, -1, -1):
            if self.initials[i] == "s" and self.faults[i] != "x":
                r = self.symbols(i + 1)
                pairs = row[(r >= 2) & (r % 2 == 0)]
                stay = TRUNCATED if self.faults[i] == "t" else 0
                self.system[i] = min(pairs, default=_FAR) + stay
            self.system[i] = min(self.system[i], self.system[i + 1] + DELETE)
            row = self._row(i, row)
            if i % STRIDE == 0:
                self.kept[i] = row

    def row(self, i: int) -> np.ndarray:
        if i in self.kept:
            return self.kept[i]
        start = i - i % STRIDE
        if self.open[0] != start:
            end = min(start + STRIDE, self.n)
            rows = [self.kept[end]]
            for j in range(end - 1, start, -1):
                rows.append(self._row(j, rows[-1]))
            self.open = (start, rows[::-1])
        return self.open[1][i - start - 1]

    def togo(self, i: int, r: int) -> int:
        q = r - (self.n - i - self.left)
        return int(self.row(i)[q]) if r >= 0 and 0 <= q < len(self.q) else int(_FAR)


def align(initials: str, faults: str) -> tuple[int, str]:
    """The least cost and the ASCII-least audit that has it.

    ``initials`` has one character per turn (anything but s, u and a is a foreign role);
    ``faults`` has ``x`` for a turn that must go, ``t`` for a truncated one, ``-`` for others.
    """
    band = _Band(initials, faults, _plain_cost(initials, faults))
    n, first, r = band.n, band.row(0), band.symbols(0)
    even = (r >= 0) & (r % 2 == 0)
    best = int(min(first[even].min(initial=_FAR), band.system[0]))
    # the lengths still in the race, as symbols to go, and whether none has begun yet
    live = {int(x) for x in r[even & (first == best)]}
    before = band.system[0] == best
    audit, i, togo = [], 0, best
    while not (i == n and 0 in live):
        stay = TRUNCATED if i < n and faults[i] == "t" else 0
        deleted = {x for x in live if i < n and band.togo(i + 1, x) + DELETE == togo}
        still = before and i < n and band.system[i + 1] + DELETE == togo
        if deleted or still:
            audit.append("D")
            live, before, i, togo = deleted, still, i + 1, togo - DELETE
            continue
        inserted = {x - 1 for x in live if x and band.togo(i, x - 1) + INSERT == togo}
        if inserted:
            audit.append("I")
            live, before, togo = inserted, False, togo - INSERT
            continue
        stands = {x for x in live if x and faults[i] != "x" and band.togo(i + 1, x - 1) + int(band.met(i, x)) == togo}
        kept = {x - 1 for x in stands if int(band.met(i, x)) == stay}
        if before and initials[i] == "s" and faults[i] != "x":
            after, pairs = band.row(i + 1), band.symbols(i + 1)
            kept |= {int(x) for x in pairs[(pairs >= 2) & (pairs % 2 == 0) & (after + stay == togo)]}
        before = False
        if kept:
            audit.append("K")
            live, i, togo = kept, i + 1, togo - stay
        else:
            audit.append("R")
            live, i, togo = {x - 1 for x in stands}, i + 1, togo - stay - REROLE
    return best, "".join(audit)


def roles_of(audit: str) -> Iterator[str | None]:
    """Per edit, the role it sets: for Rerole and Insert; None for the others."""
    length = sum(edit != "D" for edit in audit)
    at = -(length % 2)
    for edit in audit:
        yield ROLES["ua"[at % 2]] if edit in "RI" else None
        at += edit != "D"


# --- tables -------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults planted by crc32(``conv_id:turn``) % 20, and a column ``gone``.

    0 drops a row (``gone``), 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets
    its role to user. Null roles and texts are one space, and so are null ids and turns in
    the hashed text.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) with ``place``, which grows along a conversation.

    By turn, nulls first; turns that tie go by role and text. A sort over ranges, so that a
    conversation of any size is spread over tasks. Stored.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).orderBy(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    return materialized(rows.withColumn("place", F.monotonically_increasing_id()), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """``place`` of each ordered row with its first fault: blank, duplicate, truncated or none.

    A duplicate has the role and text of an earlier row of its conversation.
    """
    narrow = rows.select("conv_id", "place", "role", "text", F.sha2("text", 256).alias("body"))
    first = narrow.groupBy("conv_id", "role", "body").agg(F.min("place").alias("first"))
    seen = narrow.alias("n").join(
        first.alias("f"),
        F.expr("n.conv_id <=> f.conv_id and n.role = f.role and n.body = f.body"),
    )
    bare = F.rtrim(F.col("n.text"), F.lit(SPACES))
    fault = (
        F.when(bare == "", "blank")
        .when(F.col("place") > F.col("first"), "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("none")
    )
    return seen.select(
        "n.conv_id", "place", F.substring("n.role", 1, 1).alias("initial"), fault.alias("fault")
    )


_CODES = {"blank": "x", "duplicate": "x", "truncated": "t", "none": "-"}
_AUDITS = "conv_id {0}, illegal long, cost long, audit string, places array<long>"


def _audited(batch: pa.RecordBatch) -> pa.RecordBatch:
    illegal, costs, audits, places = [], [], [], []
    for turns in batch.column("turns").to_pylist():
        turns.sort(key=lambda turn: turn["place"])
        initials = [turn["initial"] for turn in turns]
        illegal.append(sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)))
        cost, audit = align("".join(x or "?" for x in initials), "".join(_CODES[turn["fault"]] for turn in turns))
        costs.append(cost)
        audits.append(audit)
        places.append([turn["place"] for turn in turns])
    return pa.RecordBatch.from_arrays(
        [
            batch.column("conv_id"),
            pa.array(illegal, pa.int64()),
            pa.array(costs, pa.int64()),
            pa.array(audits, pa.string()),
            pa.array(places, pa.list_(pa.int64())),
        ],
        ["conv_id", "illegal", "cost", "audit", "places"],
    )


def audits(found: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit, places) per conversation, from ``faults``."""
    turns = found.groupBy("conv_id").agg(F.collect_list(F.struct("place", "initial", "fault")).alias("turns"))
    kind = found.schema["conv_id"].dataType.simpleString()
    return map_partitions(turns, lambda batches: map(_audited, batches), _AUDITS.format(kind))


def _edits(batch: pa.RecordBatch) -> pa.RecordBatch:
    index, steps, edits, places, roles = [], [], [], [], []
    columns = (batch.column(name).to_pylist() for name in ("audit", "places"))
    for k, (audit, own) in enumerate(zip(*columns, strict=True)):
        turn = iter(own)
        for step, (edit, role) in enumerate(zip(audit, roles_of(audit), strict=True)):
            index.append(k)
            steps.append(step)
            edits.append(edit)
            places.append(None if edit == "I" else next(turn))
            roles.append(role)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("conv_id").take(pa.array(index, pa.int64())),
            pa.array(steps, pa.int64()),
            pa.array(edits, pa.string()),
            pa.array(places, pa.int64()),
            pa.array(roles, pa.string()),
        ],
        ["conv_id", "step", "edit", "place", "new_role"],
    )


def _repaired(rows: DataFrame, judged: DataFrame) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    steps = map_partitions(
        judged.select("conv_id", "audit", "places"),
        lambda batches: map(_edits, batches),
        f"conv_id {kind}, step long, edit string, place long, new_role string",
    ).filter("edit != 'D'")
    return steps.join(rows.select("place", "role", "text"), "place", "left").select(
        "conv_id",
        "step",
        "edit",
        F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, step (their order), edit (K, R or I), role, text.

    Null roles and texts count as one space and a null id is a conversation of its own. A
    role that is empty or of another initial fits nowhere: it is reroled or deleted. Repeated
    rows are duplicates. A conversation whose cheapest repair deletes all has no rows; an
    empty table gives none. Other columns are not looked at.
    """
    rows = ordered(conversations)
    return _repaired(rows, materialized(audits(faults(rows)), "audits"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash over the rows of each conversation, as they come in order."""
    current: Any = None
    state, begun, kind = hashlib.sha256(), False, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([current], kind), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"]
        )

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if begun and conv == current:
                state.update(b"\n")
            else:
                if begun:
                    yield row()
                current, state, begun = conv, hashlib.sha256(), True
            state.update(f"{role}:{text}".encode())
    if begun:
        yield row()


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired turns, ``role:text`` joined by newlines."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "step")
    return map_partitions(rows.select("conv_id", "role", "text"), _digests, f"conv_id {kind}, repaired_sha256 string")


def audit_damage(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations`` after planting faults in it.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Counts
    are of the rows after damage; a conversation without any has zeros, an empty audit and
    the hash of an empty text. Nulls, ties and repeated rows are treated as ``repair`` says.
    """
    planted = damaged(conversations)
    rows = ordered(planted.filter(~F.col("gone")))
    found = materialized(faults(rows), "faults")
    judged = materialized(audits(found), "audits")
    hashed = digests(_repaired(rows, judged))
    turn = F.when(~F.col("gone"), F.col("turn"))
    spans = planted.groupBy("conv_id").agg(
        F.max(turn).alias("last"), F.min(turn).alias("first"), F.count_distinct(turn).alias("n")
    )

    def number(fault: str) -> Column:
        return F.count_if(F.col("fault") == fault).alias(fault)

    counts = found.groupBy("conv_id").agg(*[number(fault) for fault in ("blank", "duplicate", "truncated")])

    def same(left: str, right: str) -> Column:
        return F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id"))

    joined = (
        spans.alias("s")
        .join(counts.alias("c"), same("s", "c"), "left")
        .join(judged.alias("j"), same("s", "j"), "left")
        .join(hashed.alias("h"), same("s", "h"), "left")
    )

    def zero(column: Column) -> Column:
        return F.coalesce(column.cast("long"), F.lit(0).cast("long"))

    return joined.select(
        "s.conv_id",
        zero(F.col("s.last") - F.col("s.first") + 1 - F.col("s.n")).alias("gaps"),
        *[zero(F.col(name)).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
