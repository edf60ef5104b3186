"""A corpus pipeline: reject poor texts, drop near-duplicates and benchmark texts, redact
secrets, and sample segmentations of what is left.

Each stage takes the documents its predecessor kept and returns documents, the last one
the segmentations. ``run`` stores every stage in the shared folder and reads it back, so a
lost executor costs no more than its own tasks.

The classifier, SimHash groups, the randomness tests and the sampler are not SQL, so there
is no SQL for the result; the tests compare it with a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake.llm.decontamination import uncontaminated
from gridlake.llm.quality_model import accepted
from gridlake.llm.pieces import load_vocabulary, sample_segmentations
from gridlake.llm.secrets import redact
from gridlake.llm.simhash import one_per_group
from gridlake.sources.tables import materialized

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it learns from those that come in."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return redact(docs)


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, with their piece ids."""
    return sample_segmentations(docs, load_vocabulary())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("segmentations", segmentations),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return docs
