"""Sketch bounds, exact scores and ranks against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from compare import connect, difference

from gridlake.llm import oracle_sql
from gridlake.llm import search as S


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(documents, items, top=10):
    counts = [(doc, Counter(terms(text))) for doc, text in documents]
    n, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scored = []
        for doc, own in counts:
            score = 0
            for t, k in Counter(terms(text)).items():
                if t in own:
                    m = 100 - 75 + 75 * own.total() * n // total
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += k * weight * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc, score))
        found += [(item, rank, doc, score) for rank, (*_, doc, score) in enumerate(sorted(scored)[:top], 1)]
    return found


@pytest.fixture
def corpus():
    chance = random.Random(8)
    words = [f"w{i}" for i in range(120)] + ["Émile", "naïve", "x2", "日本"]

    def text(n):
        return " ".join(chance.choice(words[: chance.choice((10, 124))]).upper() if chance.random() < 0.2 else chance.choice(words) for _ in range(n))

    docs = [(i, text(chance.randrange(1, 60))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)] + [docs[9], docs[9], (None, docs[7][1]), (None, "w1 w2")]
    docs += [(2000, None), (2001, ""), (2002, " .,; \n"), (2003, text(30_000)), (2004, "it's w3_w4-W5")]
    items = [(i, text(12)) for i in range(9)] + [(50, docs[7][1]), (None, "w1"), (51, ""), (52, None), (53, "unheard of"), (50, docs[7][1])]
    return docs, items


def rows_of(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("rounds, block", [((32, 256, None), 256), ((2, 5, None), 4)])
def test_ranks(spark, documents, benchmark_items, corpus, monkeypatch, rounds, block):
    monkeypatch.setattr(S, "ROUNDS", rounds)
    monkeypatch.setattr(S, "BLOCK", block)
    docs, items = corpus
    table = documents(docs, "body string, rank string, query string, holder string, nth string, score string")
    found = S.search(table, benchmark_items(items).selectExpr("*", "1 as query", "2 as body"))
    assert rows_of(found) == sorted(map(str, plain_search(docs, items)))


def test_bounds_are_never_below_scores(corpus, monkeypatch):
    docs, items = corpus
    counts = [c for _, t in docs if (c := Counter(S.terms_of((t or "").encode())))]
    queries = [Counter(S.terms_of((t or "").encode())) for _, t in items]
    holding = Counter(t for c in counts for t in c)
    known = S.Corpus(len(counts), sum(c.total() for c in counts), dict(holding))
    for cells in (8, 1 << 16):
        monkeypatch.setattr(S, "CELLS", cells)
        bounds = S.Lookups.of(queries, known).bounds([S.sketch(c, known) for c in counts])
        exact = [[S.score(q, c, known) for c in counts] for q in queries]
        assert (bounds >= exact).all()
        if cells > 8:  # rounding up is all that separates them
            assert ((bounds - exact) <= 0.0001 * bounds + 1).all()


def test_empty_tables(documents, benchmark_items, corpus):
    docs, items = corpus
    assert S.search(documents([]), benchmark_items(items)).count() == 0
    assert S.search(documents([(1, None), (2, "?")]), benchmark_items(items)).count() == 0
    none = S.search(documents(docs), benchmark_items([]))
    assert none.count() == 0 and none.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_text_ids(spark, corpus):
    docs, items = corpus
    named = [(f"d{i:05d}", t) for i, t in docs if i is not None and i != 9]
    table = spark.createDataFrame(named, "doc_id string, text string")
    asked = spark.createDataFrame([("q", items[0][1])], "item_id string, text string")
    expected = plain_search([(i, t) for i, t in docs if i is not None and i != 9], [("q", items[0][1])])
    assert [(r[0], r[1], int(r[2][1:]), r[3]) for r in S.search(table, asked).orderBy("rank").collect()] == expected


def test_query_equals_its_sql_on_a_larger_table(spark):
    root = "/root/testdata/sf0.01"
    found = S.search(*(spark.read.parquet(f"{root}/{name}.parquet") for name in ("documents", "benchmark")))
    assert difference(found.toPandas(), connect(root).execute(oracle_sql.SEARCH).df()) is None
