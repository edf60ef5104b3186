"""The corpus operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.conversations import audit_damage
from gridlake.llm.decontamination import contamination
from gridlake.llm.extraction import extract_text
from gridlake.llm.language import identify
from gridlake.llm.licenses import scan_licenses
from gridlake.llm.pieces import load_vocabulary, sample_segmentations
from gridlake.llm.quality_model import score_quality
from gridlake.llm.repeats import without_repeats
from gridlake.llm.rules import quality_rules
from gridlake.llm.secrets import find_secrets, report
from gridlake.llm.search import search
from gridlake.llm.simhash import near_duplicates
from gridlake.llm.warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).drop("body")


def segmentation_digests(documents: DataFrame) -> DataFrame:
    """The sampled segmentations with their number of pieces and a hash of the ids."""
    return sample_segmentations(documents, load_vocabulary()).select(
        "doc_id",
        "sample",
        F.size("ids").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "log_prob",
        "perturbed",
        "log_inclusion",
        "decoded",
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation_digests(_table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages"))[1]


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return contamination(documents, benchmark).drop("body")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("matches")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(find_secrets(_table(spark, sf_dir, "documents")))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_damage(_table(spark, sf_dir, "conversations"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(_table(spark, sf_dir, "documents")).drop("body", "kept")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_simhash": op3_simhash,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_language": op5_language,
        "op6_warc": op6_warc,
        "op7_html": op7_html,
        "op8_decontamination": op8_decontamination,
        "op9_licenses": op9_licenses,
        "op10_secrets": op10_secrets,
        "op11_conversations": op11_conversations,
        "op12_search": op12_search,
        "op13_suffix_dedup": op13_suffix_dedup,
    }
