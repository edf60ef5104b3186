"""Native operators: quality rules and benchmark decontamination."""

from __future__ import annotations

import hashlib
import re
from math import comb

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from gridlake.llm import oracle_sql, queries
from gridlake.llm.decontamination import contamination, uncontaminated
from gridlake.llm.rules import CUTOFFS, binomial_tail, quality_rules, select_cutoffs, text_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


def repeated(words):
    runs = {}
    for i in range(len(words) - 7):
        runs.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({i + k for at in runs.values() if len(at) > 1 for i in at for k in range(8)})


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated(words),
    }


TEXTS = [
    None, "", " \n\t\x0b", "one", "é b \x1c c", "a b\na b\n\n\na b", "$$ ## <>|",
    "a b c d e f g h a b c d e f g h i", " ".join("abcdefghij") + " " + " ".join("abcdefghij"),
    "x " * 40, "x " * 5000, "\U0001f600 \U0001f600", "a\rb\r\nc", " ".join(f"w{i % 9}" for i in range(30)),
]


def test_counts_equal_a_plain_version(documents):
    rows = list(enumerate(TEXTS)) + [(3, "one"), (None, "null id"), (2, "other text")]
    got = text_counts(documents(rows)).collect()
    expected = [(i, *plain_counts(text).values()) for i, text in rows]
    names = plain_counts("")
    assert sorted(map(str, ((r["doc_id"], *[r[c] for c in names]) for r in got))) == sorted(map(str, expected))


def test_binomial_tail_is_exact(spark):
    pairs = [(k, n) for n in (1, 20, 300, 2000) for k in (0, 1, 2, 5, 13) if k <= n]
    share = 0.02
    rows = spark.createDataFrame(pairs, "k long, n long").withColumn("p", binomial_tail(F.col("k"), F.col("n"), share))
    for k, n, p in rows.collect():
        exact = sum(comb(n, j) * share**j * (1 - share) ** (n - j) for j in range(k + 1)) if k < n * share else 1
        assert abs(p - exact) <= 1e-8 * max(exact, 1e-300) + 1e-15


def test_cutoffs_are_safe_and_useful(spark):
    # of 5,000 good texts 40 have many symbols; bad texts always do
    good = [("en", 1, 8 if i < 40 else 0, 0, 0) for i in range(5000)]
    bad = [("en", 0, 12, 0, 0)] * 200
    few = [("de", 1, 0, 0, 0)] * 30 + [("de", 0, 12, 0, 0)] * 30
    table = spark.createDataFrame(good + bad + few, "stratum string, label int, symbols int, shouting int, dup_lines int")
    rows = {row["stratum"]: row for row in select_cutoffs(table, 0.02, 0.05).collect()}
    assert set(rows) == {"en"}  # 30 texts bound nothing
    assert 8 <= rows["en"]["cut_symbols"] < 12 <= CUTOFFS
    assert rows["en"]["cut_shouting"] is None


def test_false_rejections_are_limited(spark):
    """Labels drawn at a rate above alpha must not give a cutoff, but in a share DELTA of draws."""
    rows = []
    for s in range(40):
        rows += [(f"s{s}", 1, 10 if (i * 37 + s * 11) % 100 < 2 else 0, 0, 0) for i in range(1500)]
        rows += [(f"s{s}", 0, 10, 0, 0)] * 100
    table = spark.createDataFrame(rows, "stratum string, label int, symbols int, shouting int, dup_lines int")
    assert select_cutoffs(table, 0.02, 0.05).filter("cut_symbols < 10").count() == 0


def test_query_equals_its_sql_where_cutoffs_are_selected(spark, tmp_path):
    """en and other languages have the 1,301 good labels that a cutoff needs at least, de one less."""
    rows = []
    for lang, n in (("en", 1400), (None, 1301), ("de", 1300)):
        for i in range(n + 40):
            bad = i >= n
            words = [f"w{(i * 31 + j * 7) % 9973}" for j in range(30)] + ["#" * (40 if bad else i % 3)]
            rows.append((len(rows), " ".join(words), lang, "s", 0, int(not bad)))
    ids, texts, langs, sources, sizes, quality = (list(column) for column in zip(*rows, strict=True))
    docs = {"doc_id": ids, "text": texts, "lang": pa.array(langs, pa.string()), "source": sources, "n_chars": sizes}
    pq.write_table(pa.table(docs), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": ids, "quality": quality, "toxic": [0] * len(ids)}), tmp_path / "labels.parquet")
    result = queries.op1_quality_rules(spark, str(tmp_path)).toPandas()
    assert difference(result, connect(str(tmp_path)).execute(oracle_sql.QUALITY_RULES).df()) is None
    failed = dict(zip(result["doc_id"], result["failed_rules"], strict=True))
    wrong = {i for i, good in zip(ids, quality, strict=True) if not good}
    assert not result["base_failed"].any()
    assert {i for i, rules in failed.items() if rules} == {i for i in wrong if langs[i] != "de"}
    assert {rules for rules in failed.values() if rules} == {"symbols"}


def test_quality_rules_without_labels_and_rows(documents, labels, word_text):
    docs = documents([(1, word_text(50)), (2, "short"), (None, None), (1, word_text(50))])
    rows = quality_rules(docs, labels([])).collect()
    assert sorted((str(r["doc_id"]), r["base_failed"], r["kept"]) for r in rows) == [
        ("1", False, True), ("1", False, True), ("2", True, False), ("None", True, False),
    ]
    assert quality_rules(docs.limit(0), labels([(1, 1, 0), (None, 1, 0), (2, None, None)])).count() == 0


# --- decontamination ----------------------------------------------------------


def plain_contamination(docs, items, size=13):
    def lower(text):
        return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")

    windows = {}
    for item, text in items:
        words = ALNUM.findall(lower(text))
        n = min(size, len(words))
        for i in range(len(words) - n + 1) if n else ():
            windows.setdefault(tuple(words[i : i + n]), set()).add("" if item is None else str(item))
    result = []
    for doc, text in docs:
        words, hit, found = ALNUM.findall(lower(text)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                items_here = windows.get(tuple(words[i : i + n]))
                if items_here:
                    found |= items_here
                    hit |= set(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result.append((doc, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(map(str, result))


def got_contamination(docs, items):
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted(str(tuple(row[c] for c in names)) for row in contamination(docs, items).collect())


def test_every_shared_window_is_found(documents, benchmark_items, word_text):
    long = word_text(60, 1)
    words = long.split()
    items = [
        (1, long), (2, "Short Item"), (3, None), (4, "..."), (5, word_text(13, 2)), (6, word_text(12, 3)),
        (6, word_text(12, 3)), (None, word_text(20, 4)), (10, " ".join(words[20:40])), (7, "é É x1 é É x1 é É x1 é É x1 é"),
    ]
    docs = [
        (1, long), (2, long.upper().replace(" ", ", ")), (3, " ".join(words[5:18])), (4, " ".join(words[5:17])),
        (5, "a short item, twice: short-item short item"), (6, None), (7, ""), (8, word_text(30, 4) + " " + word_text(12, 3)),
        (9, word_text(500, 9) + " " + " ".join(words[30:50]) + " " + word_text(300, 8)), (9, "another text"), (1, long),
        (None, word_text(13, 2)), (11, "é É x1 " * 10), (12, "É é x1 " * 10), (13, " ".join(words[:30] + words[:30])),
        (14, word_text(12, 2)),
    ]
    assert got_contamination(documents(docs), benchmark_items(items)) == plain_contamination(docs, items)
    full = [item for item in items if item[0] in (1, 5, 10)]
    assert got_contamination(documents(docs), benchmark_items(full)) == plain_contamination(docs, full)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_many_documents_share_a_passage_with_and_without_a_broadcast(spark, documents, benchmark_items, word_text, threshold):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    docs = [(i, f"{word_text(20, 100 + i)} {word_text(25, 1)}") for i in range(60)]
    items = [(i, word_text(25, 1)) for i in range(5)]
    spark.conf.set(name, threshold)
    try:
        assert got_contamination(documents(docs), benchmark_items(items)) == plain_contamination(docs, items)
    finally:
        spark.conf.set(name, before)


def test_empty_tables_and_kept_rows(documents, benchmark_items, word_text):
    docs = [(1, word_text(20, 1)), (2, word_text(20, 2)), (None, None), (2, word_text(20, 1))]
    empty = benchmark_items([])
    assert got_contamination(documents(docs), empty) == plain_contamination(docs, [])
    assert contamination(documents([]), empty).count() == 0
    table = documents(docs)
    kept = uncontaminated(table, benchmark_items([(1, word_text(20, 1))]))
    assert kept.columns == table.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(
        map(str, [(2, word_text(20, 2)), (None, None)])
    )
