"""Alignment, planted damage and repaired turns against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridlake.llm import conversations as C

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
COLUMNS = "conv_id long, turn long, role string, text string"


def plain_alignment(initials, faults):
    """The least (cost, audit) by best-first search over the grammar's states."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(initials) and state in (0, 3):
            return cost, audit
        if i < len(initials):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
        for symbol, after in NEXT[state].items():
            if symbol in "ua":
                heapq.heappush(heap, (cost + 5, audit + "I", i, after))
            if i < len(initials) and faults[i] != "x":
                stay = cost + 5 * (faults[i] == "t")
                if initials[i] == symbol:
                    heapq.heappush(heap, (stay, audit + "K", i + 1, after))
                if symbol in "ua":
                    heapq.heappush(heap, (stay + 1, audit + "R", i + 1, after))


@pytest.mark.parametrize("stride", [3, 256])
def test_alignment(monkeypatch, stride):
    monkeypatch.setattr(C, "STRIDE", stride)
    chance = random.Random(stride)
    for _ in range(1500):
        n = chance.randrange(14)
        initials = "".join(chance.choice("suauaua?") for _ in range(n))
        faults = "".join(chance.choice("------xt" if chance.random() < 0.7 else "-xt") for _ in range(n))
        assert C.align(initials, faults) == plain_alignment(initials, faults)


def test_a_long_conversation_needs_only_its_band():
    initials, faults = "ua" * 3000, list("-" * 6000)
    faults[77] = "x"
    cost, audit = C.align(initials, "".join(faults))
    assert cost == 2 + 2 and audit.count("D") == 2 and len(audit) == 6000
    assert len(C._Band(initials, "".join(faults), 4).q) == 3


def spaced(value):
    return " " if value is None else str(value)


def plain_damage(rows):
    kept = []
    for conv, turn, role, text in rows:
        role, text = spaced(role), spaced(text)
        kind = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return kept


def plain_audit(rows):
    """{conv_id: the contract's columns} of the rows after damage."""
    found = {}
    after = plain_damage(rows)
    for conv in {row[0] for row in rows}:
        own = sorted(
            (row[1:] for row in after if row[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
        )
        turns = [r[0] for r in own if r[0] is not None]
        faults, seen = [], set()
        for _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        initials = [r[1][:1] for r in own]
        cost, audit = plain_alignment(
            "".join(x or "?" for x in initials), "".join({"": "-", "truncated": "t"}.get(f, "x") for f in faults)
        )
        length, at, turn, lines = sum(e != "D" for e in audit), 0, iter(own), []
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(turn)
            if edit in "RI":
                role = ("user", "assistant")[(at - length % 2) % 2]
            if edit != "D":
                at += 1
                lines.append(f"{role}:{text}")
        found[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(kind) for kind in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return found


def audited(df):
    got = df.collect()
    assert df.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_audits_of_planted_damage(spark):
    chance = random.Random(4)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", " a b.\n", "cut off", "", " \t\x0b", None, "Ünï?", "x.\x00"]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(chance.randrange(1, 12)):
            place = None if chance.random() < 0.05 else turn + 3 * (chance.random() < 0.1)
            role = ("user", "assistant")[turn % 2] if chance.random() < 0.8 else chance.choice(roles)
            rows.append((conv, place, role, chance.choice(texts) if chance.random() < 0.5 else f"{conv} {turn}."))
    rows += [(900, None, "user", "Only nulls."), (901, 5, "user", "w " * 50_000)]
    # a conversation of which nothing is left
    gone = next(i for i in range(1000, 9000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Dropped."))
    table = spark.createDataFrame(rows, COLUMNS)
    for name in ("place", "fault", "step", "edit", "gone", "initial"):
        table = table.withColumn(name, F.lit("x"))
    expected = plain_audit(rows)
    assert expected[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert audited(C.audit_damage(table)) == expected
    # an odd turn is cheaper deleted (2) than completed by an insertion (5)
    assert {"K", "R", "D"} == set("".join(row[6] for row in expected.values()))


def test_no_conversations(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert C.audit_damage(empty).count() == 0 == C.repair(empty).count()


def test_repaired_turns(spark):
    rows = [
        (1, 0, "system", "Be brief."), (1, 1, "user", "Hello?"), (1, 2, "user", "Hello?"), (1, 3, "assistant", "Hi."),
        (1, 4, "user", "Bye."), (2, None, None, None), ("3", 0, "assistant", "Cut"),
    ]
    table = spark.createDataFrame([(str(a), *rest) for a, *rest in rows], "conv_id string, turn long, role string, text string")
    got = C.repair(table).orderBy("conv_id", "step").select("conv_id", "edit", "role", "text").collect()
    assert [tuple(r) for r in got] == [
        ("1", "K", "system", "Be brief."), ("1", "K", "user", "Hello?"), ("1", "K", "assistant", "Hi."),
    ]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_audits_of_the_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert audited(C.audit_damage(table)) == plain_audit(rows)
