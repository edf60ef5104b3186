"""Learned operators: the quality classifier and language identification."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import language, quality_model
from gridlake.llm.language import LanguageModel, counts_of, identify, letters_of
from gridlake.llm.quality_model import FEATURES, accepted, fit, score_quality, text_features

ROOT = "/root/testdata/sf0.01"
with_tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


def table(spark, name):
    return spark.read.parquet(f"{ROOT}/{name}.parquet")


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


# --- quality ------------------------------------------------------------------


def test_scores_are_table_look_ups():
    chance = np.random.default_rng(2)
    values = chance.normal(size=(800, 4)).astype(np.float32)
    labels = ((values[:, 0] > 0) ^ (values[:, 1] > 0.3)).astype(float)  # an interaction only
    model = fit(values, labels)
    assert (0, 1) in model.pairs
    scores = model.score(values)
    assert ((scores > 0.5) == (labels == 1)).mean() > 0.95
    for row, score in zip(values[:40], scores[:40], strict=True):
        total = model.intercept
        for j in range(4):
            total += model.tables[j][sum(row[j] >= edge for edge in model.edges[j])]
        for (i, j), pair in model.pairs.items():
            total += pair[sum(row[i] >= e for e in model.coarse[i]), sum(row[j] >= e for e in model.coarse[j])]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-9
    assert (fit(values, labels).score(values) == scores).all()


def test_a_model_without_rows_or_with_one_label():
    assert fit(np.zeros((0, 3)), np.zeros(0)).score(np.ones((2, 3))).tolist() == [0.5, 0.5]
    assert (fit(np.ones((9, 3)), np.ones(9)).score(np.ones((2, 3))) > 0.8).all()


def test_features_of_odd_texts():
    for text in ("", " \n\t", "a", "\n", "é" * 1000, "!!!", "a" * 1_000_000, "\x00 \x00"):
        features = text_features(text.encode())
        assert len(features) == len(FEATURES) and np.isfinite(features).all()


@with_tables
def test_quality_on_held_out_documents(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    rows = score_quality(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["held_out"] == (fold(row["doc_id"], 5) == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.9
    # the held-out labels change nothing
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in score_quality(docs, other).collect()}
    assert again == {r["doc_id"]: r["score"] for r in rows}


def test_quality_of_odd_rows(documents, labels, word_text):
    docs = documents([(i, word_text(40, i)) for i in range(30)] + [(50, None), (51, ""), (None, "x"), (3, word_text(40, 3)), (52, "a " * 50000)])
    marks = labels([(i, i % 2, 0) for i in range(30)] + [(3, 0, 0), (None, 1, 0), (4, None, 0), (99, 1, 0)])
    rows = score_quality(docs, marks).collect()
    assert len(rows) == 35 and all(0 <= r["score"] <= 1 for r in rows)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert len({r["score"] for r in rows if r["doc_id"] == 3}) == 1
    kept = accepted(docs, marks)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] for r in rows)
    assert score_quality(documents([]), marks).count() == 0
    assert {r["score"] for r in score_quality(docs, labels([])).collect()} == {0.5}


# --- language -----------------------------------------------------------------


def plain_buckets(letters):
    counts = np.zeros(language.BUCKETS, np.int64)
    for order in language.ORDERS:
        for i in range(len(letters) - order + 1):
            code = int.from_bytes(letters[i : i + order], "big")
            mixed = (code + order) * 2654435761 % 2**32
            counts[mixed >> (32 - language.BUCKET_BITS)] += 1
    return counts


def test_subwords(monkeypatch):
    for text in ("", "a", "Ab c", "Été, où? 12 ß!", "word " * 300):
        letters = letters_of(text)
        expected = plain_buckets(letters)
        assert (counts_of(letters) == expected).all()
        monkeypatch.setattr(language, "CHUNK", 17)
        assert (counts_of(letters) == expected).all()
        monkeypatch.undo()
    assert letters_of("Éa1b, C") == " éa b c ".encode()
    assert letters_of("12 !?") == letters_of(None) == b""


def test_a_prediction_is_the_softmax_of_the_average():
    chance = np.random.default_rng(1)
    model = LanguageModel(["a", "b", "c"], chance.normal(size=(language.BUCKETS, 3)), np.array([0.1, 0.0, -0.2]), 0.7, 0.5)
    counts = plain_buckets(letters_of("some words here"))
    scores = (counts @ model.table / counts.sum() + model.bias) / 0.7
    chances = np.exp(scores) / np.exp(scores).sum()
    assert model.predict("Some Words, here!") == pytest.approx((model.languages[int(chances.argmax())], chances.max(), chances.max() >= 0.5))


@with_tables
def test_languages_of_held_out_documents(spark):
    docs = table(spark, "documents")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    # languages of held-out rows, and other columns, change nothing
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in identify(other).collect()} == {
        (r["doc_id"], r["lang_pred"], r["score"]) for r in rows
    }


def test_languages_of_odd_rows(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(12)] + [(20 + i, "le chat et le chien", "fr") for i in range(12)]
    rows += [(50, None, "en"), (51, "", None), (52, "123 !", "fr"), (None, "the cat", "xx"), (3, "the cat and the dog", "en"), (60, "the " * 400000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("ids", F.lit(1)).withColumn("score", F.lit("x"))
    got = identify(docs).collect()
    assert len(got) == len(rows)
    unknown = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert unknown == {50, 51, 52} and all(r["score"] == 0 and not r["accepted"] for r in got if r["doc_id"] in unknown)
    assert {r["lang_pred"] for r in got} <= {"en", "fr", "und"}
    assert identify(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
