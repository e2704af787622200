"""A training corpus from documents: quality, near-duplicates, repeated passages, test passages, packing.

STAGES lists (name, function); each takes (spark, docs, sf_dir), works on all
that the stage before it kept and returns the columns of documents, the last one
packed pieces.  run() applies them in order, each one's result written as
Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelock.llm import decontaminate, neardup, packing, quality, substring, tokens
from tidelock.llm.shared import Scratch, table

#: SQL can't express the trained trees, sketches or packing: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def _counted(changed: DataFrame, columns: list[str]) -> DataFrame:
    """n_chars follows the text where a stage cuts texts."""
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(changed.schema["n_chars"].dataType))
    return changed.select(columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the base rule or the trees reject; null and empty texts are among these."""
    return quality.keep_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, the one with the smallest doc_id.

    Shingles of five words, similarity 0.8.  Rows that share a doc_id and hold the same words are one document, those with
    other texts are documents of their own; those whose doc_id is null all stay.
    """
    scratch = Scratch(spark, "pipeline-near")
    found = scratch.keep(neardup.near_duplicates(docs, neardup.Rule(words=5, percent=80), scratch), "found")
    return neardup.keep_firsts(docs, found)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has, or that stand earlier in the same one."""
    scratch = Scratch(spark, "pipeline-passages")
    passages = scratch.keep(substring.passages(docs, scratch), "found")
    return _counted(substring.remove_passages(docs, passages), docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that windows of test items cover."""
    return _counted(decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "pipeline-benchmark")), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in sequences of at most 2048 tokens."""
    vocabulary = tokens.Vocabulary(spark, tokens.vocabulary_path("word_bpe_49k.json"))
    return packing.pack(docs, vocabulary, 1, Scratch(spark, "pipeline-pack"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
