"""The registered queries of the package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft.llm import conversations, decontaminate, fingerprints, language_id, licences, merkle, ngram_join, packing, quality, substrings, suffix_arrays, toxicity, warc
from crawlweft.llm.oracles import CONVERSATIONS, MERKLE
from crawlweft.llm.samples import learnable

#: Vocabulary files of a public tokenizer, present on every machine.
VOCABULARY = "/opt/tokenizers"
VOCABULARY_JSON = f"{VOCABULARY}/byte_bpe_50k.json"
VOCABULARY_RANKS = f"{VOCABULARY}/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary cuts a text before its merges.
VOCABULARY_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    may = learnable("doc_id", 3, 1)
    model = quality.train(docs.filter(may), table(spark, sf_dir, "labels").filter(may))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", (~may).alias("held_out"), "score", "predicted")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_versions(table(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.array_join("expressions", ";").alias("expressions"),
        "score",
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY_JSON, VOCABULARY_RANKS, VOCABULARY_PATTERN)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), words=4, threshold=(85, 100))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    may = learnable("doc_id", 5, 0)
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(may))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", (~may).alias("held_out"), "score", "predicted")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    may = learnable("doc_id", 4, 2)
    dictionaries = language_id.train_dictionaries(docs.filter(may))
    found = language_id.identify(docs, dictionaries)
    return found.select("doc_id", (~may).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.passage_report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_repeated", "n_links", "component_id", "leaders", F.size("spans").alias("n_passages"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = {"n_chars": F.when(tampered, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))}
    found = merkle.manifest(docs, ("doc_id", "source", "lang", "n_chars", "text"), "lang", "doc_id", changed)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", "verified")


def op12_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_arrays.cut_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["first"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    report, messages = conversations.repair(conversations.damage(rows), copies="copies")
    found = conversations.digests(report, messages).withColumnRenamed("conv_id", "_id")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    counts = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_fingerprints,
        op3_licences,
        op4_decontamination,
        op5_packing,
        op6_ngram_join,
        op7_toxicity,
        op8_warc,
        op9_language,
        op10_substrings,
        op11_merkle,
        op12_suffix_array,
        op13_conversations,
    )
}
#: SQL can express none of the other methods whole: labels, tables, fits and packings are checked against brute force in tests.
ORACLES: dict[str, str] = {"op11_merkle": MERKLE, "op13_conversations": CONVERSATIONS}
