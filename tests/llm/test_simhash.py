"""Fingerprints, links and groups against plain versions."""

from __future__ import annotations

import re
from collections import Counter

import pytest
import xxhash

from gridlake.llm.components import components
from gridlake.llm.simhash import fingerprint, links, near_duplicates, one_per_group

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [words[i : i + 4] for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


TEXTS = ["", None, " \n", "one", "A b", "a B c d", "a b c d e", "x " * 3000, "é É ü \x1c z", "tab\tand\x0bmore words here"]


def test_fingerprints():
    for text in TEXTS:
        assert fingerprint((text or "").encode()) % 2**64 == plain_fingerprint(text)


def test_fingerprint_over_chunks(monkeypatch, word_text):
    monkeypatch.setattr("gridlake.llm.simhash.CHUNK", 64)
    text = word_text(500)
    assert fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)


def test_links_find_all_pairs_within_four_bits(spark):
    import random

    chance = random.Random(5)
    marks = {0, 2**64 - 1}
    for _ in range(60):
        base = chance.getrandbits(64)
        for n in (0, 1, 2, 3, 4, 4, 4, 5, 6):
            marks.add(base ^ sum(1 << b for b in chance.sample(range(64), n)))
    signed = [m - 2**64 if m >= 2**63 else m for m in sorted(marks)]
    expected = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 4
    }
    table = spark.createDataFrame([(m,) for m in signed], "mark long")
    assert {(r["a"], r["b"]) for r in links(table).collect()} == expected


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    import random

    chance = random.Random(3)
    pairs = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(500, i) for i in range(100)] + [(7, 7)],
        "random": [(chance.randrange(300), chance.randrange(300)) for _ in range(180)],
    }[kind]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "x long, y long")).collect()}
    nodes = {n for p in pairs for n in p}
    expected = plain_groups(nodes, pairs)
    assert found == {n: r for n, r in expected.items() if n != r}


def test_groups_of_documents(documents, word_text):
    base = word_text(400, 1).split()
    near = [" ".join(base[:i] + ["changed"] + base[i + 1 :]) for i in range(0, 400, 29)]
    docs = [(i, t) for i, t in enumerate([" ".join(base), *near, " ".join(base).upper(), *TEXTS, word_text(300, 2)])]
    docs += [(0, " ".join(base)), (None, " ".join(base)), (500, word_text(300, 2)), (None, word_text(90, 7))]
    marks = {text: plain_fingerprint(text) for _, text in docs}
    distinct = sorted(set(marks.values()))
    pairs = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 4]
    assert pairs
    group = plain_groups(distinct, pairs)
    least = {}
    for i, text in docs:
        if i is not None:
            g = group[marks[text]]
            least[g] = min(i, least.get(g, i))
    degree = Counter(n for pair in pairs for n in pair)
    expected = sorted(
        str((i, f"{marks[t]:016x}", least.get(group[marks[t]]), degree[marks[t]])) for i, t in docs
    )
    table = documents(docs)
    got = near_duplicates(table).collect()
    names = ("doc_id", "fingerprint", "component_id", "n_links")
    assert sorted(str(tuple(r[c] for c in names)) for r in got) == expected
    kept = one_per_group(table)
    assert kept.columns == table.columns
    rows = kept.collect()
    assert len(rows) == len({group[m] for m in marks.values()})
    assert {group[marks[r["text"]]]: r["doc_id"] for r in rows} == {
        g: least.get(g) for g in set(group.values()) if g in {group[m] for m in marks.values()}
    }


def test_no_documents(documents):
    assert near_duplicates(documents([])).count() == 0
    assert one_per_group(documents([])).count() == 0
