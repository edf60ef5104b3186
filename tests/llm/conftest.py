from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """``documents([(id, text), ..])`` as a table of documents with clashing extra columns."""

    def make(rows, extra="body string, row_id string, mark string, words string, spans string"):
        full = [(i, text, "en", None, None, *["x"] * len(extra.split(","))) for i, text in rows]
        return spark.createDataFrame(full, f"{DOCUMENTS}, {extra}")

    return make


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make


@pytest.fixture
def benchmark_items(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string")

    return make


@pytest.fixture
def word_text():
    """Deterministic texts of invented words."""

    def make(n, seed=0):
        return " ".join(f"w{(seed * 7919 + i * 104729) % 100003}" for i in range(n))

    return make
