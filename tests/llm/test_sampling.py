"""Bounded samples, and batches whose bound is their own."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.llm import batches, sampling
from gridlake.llm.language import identify


@pytest.mark.parametrize("size", [1, 50, 900, 5000])
def test_a_sample_is_bounded_and_the_same_for_any_partitioning(spark, size):
    rows = spark.range(3000).withColumn("v", F.lit(1))
    got = [{r["id"] for r in sampling.sampled(rows.repartition(n), "id", size).collect()} for n in (1, 9)]
    assert got[0] == got[1] and 0.9 * min(size, 3000) <= len(got[0]) <= size
    least = rows.orderBy(sampling.mark(F.col("id"))).limit(len(got[0])).collect()
    assert {r["id"] for r in least} == got[0]


def test_samples_of_repeated_keys_and_of_nothing(spark):
    hot = spark.range(3000).select((F.col("id") % 3).alias("id"))
    assert sampling.sampled(hot, "id", 999).count() == 0
    assert sampling.sampled(hot, "id", 3000).count() == 3000
    assert sampling.sampled(hot.limit(0), "id", 10).count() == 0


def test_frames_keep_their_own_batch_size(spark):
    """Two frames are built and run in either order; the session is left as it was."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batch):
        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows = spark.range(0, 1200, 1, 1).select("id")
    for order in ((1, 500), (500, 1)):
        frames = {n: batches.map_batches(rows, sizes, "n long", n) for n in order}
        assert {n: max(r["n"] for r in df.collect()) for n, df in frames.items()} == {1: 1, 500: 500}
        assert frames[1].count() == 1200
    assert spark.conf.get(name) == before


def test_languages_with_clashing_columns(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "le chat et le chien", "en" if i % 2 else "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    expected = sorted(identify(docs).collect())
    for name in ("chosen", "ids", "counts", "mark", "digit", "held_out", "lang_pred"):
        docs = docs.withColumn(name, F.lit("x"))
    assert sorted(identify(docs).collect()) == expected
