"""Suffix order, pieces and removed bytes against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from gridlake.llm import repeats as R
from gridlake.llm import suffixes as X


def test_the_cover_covers():
    for period in (1, 2, 7, 32, 64):
        cover = X.difference_cover(period).tolist()
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    i, j = np.divmod(np.arange(X.PERIOD**2), X.PERIOD)
    at = X.OFFSET[i, j]
    assert np.isin((i + at) % X.PERIOD, X.COVER).all() and np.isin((j + at) % X.PERIOD, X.COVER).all()


def repetitive(chance, letters, parts=20):
    base = bytes(chance.choice(letters) for _ in range(300))
    return b"".join(
        base[chance.randrange(200) :][: chance.randrange(1, 200)]
        if chance.random() < 0.7
        else bytes(chance.choice(letters) for _ in range(chance.randrange(1, 90)))
        for _ in range(parts)
    )


@pytest.mark.parametrize("bucket", [5, 50, X.BUCKET])
def test_suffix_order(monkeypatch, bucket):
    monkeypatch.setattr(X, "BUCKET", bucket)
    chance = random.Random(bucket)
    texts = [repetitive(chance, letters) for letters in (b"ab", b"ab\x00\xff", b"abcdefgh") for _ in range(8)]
    for text in [*texts, b"a" * 500, b"ab" * 400, bytes(700), b"x" * X.SPAN]:
        places = np.arange(len(text) - X.SPAN + 1)
        order, classes = [], []
        for k, (own, segment) in enumerate(X.Block(text).sorted_suffixes(places)):
            order += own.tolist()
            classes += [(k, c) for c in segment.tolist()]
        strings = [text[p : p + X.SPAN] for p in order]
        assert sorted(order) == places.tolist() and strings == sorted(strings)
        for a, b, c, d in zip(strings, strings[1:], classes, classes[1:]):
            assert (a == b) == (c == d)


def test_later_copies():
    chance = random.Random(3)
    text = repetitive(chance, b"ab", 40)
    places = np.arange(len(text) - X.SPAN + 1)
    owner = np.array([chance.randrange(5) for _ in places])
    start = np.array([chance.randrange(9) for _ in places]) * 10_000 + places
    first = {}
    for p in sorted(places.tolist(), key=lambda p: (owner[p], start[p])):
        first.setdefault(text[p : p + X.SPAN], p)
    expected = [first[text[p : p + X.SPAN]] != p for p in places.tolist()]
    assert X.later_copies(text, places, owner, start).tolist() == expected


def test_pieces_follow_from_what_they_hold():
    chance = random.Random(6)
    for text in (b"", b"x" * 99, b"x" * 100, repetitive(chance, b"abcdefgh", 60), b"ab" * 300):
        bucket, start, n = R.pieces_of(text)
        assert n.sum() == max(0, len(text) - R.SPAN + 1) and (n <= R.WIDTH).all()
        assert (np.cumsum(n) - n == start).all()
        own = {}
        for b, s, k in zip(bucket.tolist(), start.tolist(), n.tolist()):
            for i in range(s, s + k):
                assert own.setdefault(text[i : i + R.SPAN], b) == b


def test_a_long_text_is_cut_by_chunks(monkeypatch):
    text = repetitive(random.Random(9), b"abcd", 60)
    whole = R.kept_bytes(text, [])
    monkeypatch.setattr(R, "CHUNK", 512)
    R._powers.cache_clear()
    try:
        bucket, start, n = R.pieces_of(text)
        assert n.sum() == len(text) - R.SPAN + 1 and (np.cumsum(n) - n == start).all()
        assert len(start) > 5 and len(R.kept_bytes(text, [])[0]) >= len(whole[0])
    finally:
        R._powers.cache_clear()


@pytest.mark.parametrize("chunk, joined", [(R.CHUNK, R.JOINED), (R.CHUNK, 700), (512, R.JOINED)])
def test_texts_cut_together_give_the_pieces_of_each(monkeypatch, chunk, joined):
    chance = random.Random(4)
    texts = [repetitive(chance, letters, 1 + k) for letters in (b"ab", b"abcdefgh") for k in range(12)]
    texts += [b"", b"x" * 99, b"x" * 100, texts[5], b"ab" * 400, texts[5] + texts[9], bytes(300)]
    monkeypatch.setattr(R, "CHUNK", chunk)
    monkeypatch.setattr(R, "JOINED", joined)
    R._powers.cache_clear()
    try:
        found, by_key, by_data = R.cut(texts, keyed=True), {}, {}
        for i, text in enumerate(texts):
            own = found.text == i
            for column, expected in zip((found.bucket, found.start, found.n), R.pieces_of(text)):
                assert column[own].tolist() == expected.tolist()
        for i, key, start, n in zip(*(found[c].tolist() for c in (0, 2, 3, 4))):
            piece = texts[i][start : start + n + R.SPAN - 1]
            assert by_key.setdefault(key, piece) == piece and by_data.setdefault(piece, key) == key
        assert len(by_data) < len(found.n)
        for text, own in zip(texts, R.own_repeats(texts)):
            assert R.kept_bytes(text, [], own) == R.kept_bytes(text, [])
    finally:
        R._powers.cache_clear()


def test_short_texts_are_hashed_together(monkeypatch):
    calls, hashes = [], R._gram_hashes
    monkeypatch.setattr(R, "_gram_hashes", lambda data: calls.append(len(data)) or hashes(data))
    chance = random.Random(2)
    texts = [chance.randbytes(200).hex() for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "body": [0] * 300, "text": texts})
    for step in (R._counted, R._cut):
        calls.clear()
        assert sum(part.num_rows for part in step(iter([batch]))) > 300
        assert len(calls) < 5 and sum(calls) == 300 * 400


def test_blocks_are_sorted_in_little_memory():
    chance = random.Random(6)
    data = [chance.randbytes(150) for _ in range(30_000)]  # 4.5 MB, a bucket each
    n = len(data)
    names = ["doc_id", "body", "bucket", "start", "data"]
    columns = [range(n), [0] * n, range(n), [0] * n, data]
    batches = pa.Table.from_pydict(dict(zip(names, map(list, columns)))).to_batches(max_chunksize=5000)
    tracemalloc.start()
    try:
        for _ in R._blocks(iter(batches)):
            pass
        assert tracemalloc.get_traced_memory()[1] < 90 << 20
    finally:
        tracemalloc.stop()


def test_stored_steps_take_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes], "rows": [batch.num_rows]})

    texts = spark.range(0, 1000, 1, 1).selectExpr("repeat('x', 40000 + cast(id % 3 as int)) AS text")
    found = R._stored(R.map_partitions(texts, sizes, "n long, rows long"), "sizes").collect()
    assert sum(r["rows"] for r in found) == 1000 and max(r["n"] for r in found) <= R.BATCH_BYTES + 100_000


def plain(rows, span=100):
    """(id, n_bytes, n_removed, n_spans, hash) per row."""
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, result = set(), {}
    for i, t in order:
        data = t.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1):
            own = data[p : p + span]
            if own in seen:
                gone[p : p + span] = b"\x01" * span
            seen.add(own)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = len(re.findall(b"\x01+", bytes(gone)))
        result[i, t] = (i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return sorted(map(str, (result[i, t or ""] for i, t in rows)))


def rows_of(df):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


@pytest.fixture
def corpus(word_text):
    chance = random.Random(12)
    passages = [word_text(n, 50 + n) for n in (14, 17, 18, 19, 25, 60)] + ["é" * 50, "é" * 49, "日本語" * 12, "ab" * 60]
    rows = []
    for i in range(120):
        parts = [word_text(chance.randrange(1, 40), 200 + i * 10 + k) for k in range(chance.randrange(1, 4))]
        for _ in range(chance.randrange(3)):
            parts.insert(chance.randrange(len(parts) + 1), chance.choice(passages))
        rows.append((i, chance.choice([" ", "", "\n"]).join(parts)))
    near = rows[5][1]
    rows += [(300 + i, near[: 40 + i * 7] + "#" + near[40 + i * 7 :]) for i in range(30)]  # near copies
    rows += [(400 + i, rows[9][1]) for i in range(20)]  # exact copies
    rows += [(500, None), (501, ""), (502, "x" * 99), (503, "x" * 100), (504, "x" * 101), (505, "x" * 1000)]
    rows += [(506, passages[5] + passages[5]), (507, "ab " * 400), (508, word_text(20_000, 3)), (509, word_text(20_000, 3)[50:])]
    rows += [(None, rows[3][1]), rows[11], rows[11]]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [R.BUCKET_PIECES, 2])
def test_removed_bytes(documents, corpus, monkeypatch, limit):
    monkeypatch.setattr(R, "BUCKET_PIECES", limit)
    extra = "body string, start string, bucket string, piece string, place string, first string, spans string"
    table = documents(corpus, extra).repartition(7)
    found = R.without_repeats(table)
    assert rows_of(found) == plain(corpus)
    for row in found.collect():
        assert hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"]
        assert len(row["kept"]) == row["n_bytes"] - row["n_removed"]


def test_text_ids_and_one_id_for_two_texts(spark, word_text):
    shared = word_text(40, 1)
    rows = [("b", shared + " one"), ("a", "two " + shared), ("c", shared), ("c", shared + " three")]
    got = R.without_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    kept = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in got}
    assert kept["a", len(rows[1][1])] == 0 and kept["b", len(rows[0][1])] > 200
    assert all(r["n_removed"] for r in got if r["doc_id"] != "a") and len(got) == 4


def test_no_documents(documents):
    assert R.without_repeats(documents([])).count() == 0
    assert rows_of(R.without_repeats(documents([(1, None)]))) == plain([(1, None)])


def test_the_shuffle_setting_is_put_back(spark, documents):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    R.without_repeats(documents([(1, "a"), (2, "b" * 200)])).count()
    assert spark.conf.get(name) == before


def test_the_batch_setting_is_put_back(spark, documents):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    R.without_repeats(documents([(1, "a"), (2, "b" * 200)])).count()
    assert spark.conf.get(name) == before


def test_the_given_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert rows_of(R.without_repeats(table)) == plain(rows)
