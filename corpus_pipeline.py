"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crawlweft.llm import decontaminate, ngram_join, packing, substrings, toxicity
from crawlweft.llm.queries import VOCABULARY_JSON, VOCABULARY_PATTERN, VOCABULARY_RANKS, table
from crawlweft.operators.staging import scratch_path, write_stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not reject."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return ngram_join.drop_copies(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat an earlier document's."""
    return substrings.cut_passages(docs, n_chars="n_chars")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of up to 2048 ids, a row per piece of a document."""
    return packing.pack(docs, VOCABULARY_JSON, VOCABULARY_RANKS, VOCABULARY_PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_copies),
    ("substring dedup", cut_passages),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = write_stage(stage(spark, docs, sf_dir), str(k), folder)
    return docs
