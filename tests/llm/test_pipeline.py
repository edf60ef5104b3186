"""The pipeline's stages and its result against a plain version; the registered queries."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from gridlake.llm import oracle_sql, queries
from gridlake.llm.quality_model import score_quality
from gridlake.llm.secrets import scan
from plain_versions import contaminated, groups_of, mark_of

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_are_listed_and_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_dedup", "decontaminate", "redact_secrets", "segmentations",
    ]
    names = entry_points.queries()
    assert names["pipeline"] is corpus_pipeline.run
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_each_stage_does_its_part(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{ROOT}/labels.parquet")

    good = stages["quality"](spark, docs, ROOT).cache()
    scores = {r["doc_id"]: r["predicted"] for r in score_quality(docs, labels).collect()}
    assert good.columns == columns and set(rows_of(good)) == {i for i, p in scores.items() if p}

    single = stages["near_dedup"](spark, good, ROOT).cache()
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    group = groups_of({i: mark_of(t) for i, t in texts.items()})
    assert single.columns == columns and set(rows_of(single)) == {min(g) for g in group}

    clean = stages["decontaminate"](spark, single, ROOT).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, r in rows_of(single).items() if contaminated(r["text"], items)}
    assert bad and clean.columns == columns and set(rows_of(clean)) == set(rows_of(single)) - bad

    safe = rows_of(stages["redact_secrets"](spark, clean, ROOT))
    before = rows_of(clean)
    assert set(safe) == set(before)
    for i, row in safe.items():
        if not any(scan(before[i]["text"].encode())):
            assert row == before[i]
        else:
            assert "[SECRET]" in row["text"] and not scan(row["text"].encode())[0]
            assert row["n_chars"] == len(row["text"])

    last = corpus_pipeline.run(spark, ROOT)
    assert {r["doc_id"] for r in last.collect()} == set(safe)
    assert last.filter(~F.col("decoded")).count() == 0


def test_the_last_stage_keeps_the_piece_ids(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").orderBy("doc_id").limit(20)
    last = dict(corpus_pipeline.STAGES)["segmentations"](spark, docs, ROOT)
    got = [(r["doc_id"], r["sample"], len(r["ids"]), r["hash"]) for r in last.withColumn("hash", F.xxhash64("ids")).collect()]
    digests = queries.segmentation_digests(docs).collect()
    assert sorted(got) == sorted((r["doc_id"], r["sample"], r["n_pieces"], r["ids_hash"]) for r in digests)
    assert len(got) == 40


#: Rows of the result per value of the table's key, and the table, where it isn't documents.
TABLES = {"op6_warc": "pages", "op7_html": "pages", "op11_conversations": "conversations", "op12_search": "benchmark"}
ROWS = {"op4_sentencepiece": 2, "op12_search": 10}


@pytest.mark.parametrize("name", queries.registered())
def test_queries_over_whole_tables(spark, name):
    result = queries.registered()[name](spark, ROOT).toPandas()
    key = result.columns[0]
    expected = spark.read.parquet(f"{ROOT}/{TABLES.get(name, 'documents')}.parquet").toPandas()[key].drop_duplicates()
    assert sorted(result.drop_duplicates(key)[key]) == sorted(expected)
    assert len(result) == len(expected) * ROWS.get(name, 1)
    sql = oracle_sql.oracle_sql().get(name)
    if sql:
        assert difference(result, connect(ROOT).execute(sql).df()) is None
