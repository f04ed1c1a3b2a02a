"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweft.operators.staging import write_stage

_STEP = 1 << 30


def learnable(doc_id: str, parts: int, held: int) -> Column:
    """Whether a row's label may be learned from: crc32 of its id as text modulo `parts` is not `held`."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts != held, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, bounds: dict[int, int], doc_id: str = "doc_id", text: str = "text") -> tuple[dict[int, list[str]], dict[int, int]]:
    """At most about `bounds[v]` distinct texts for each label value v, and how many rows bear it.

    Texts are counted and chosen by their hashes, so copies displace no other text; up to
    `bounds[v]` all are taken.  Only the ids of chosen texts go to the documents, one of
    each text.  Rows without id, text or label are left out.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).filter(F.col("_id").isNotNull() & F.col("_label").isin(*bounds)).distinct()
    counts = {r["_label"]: r["n"] for r in labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(label).cast("int").alias("_label")).agg(F.count("*").alias("n")).collect() if r["_label"] in bounds}
    if not counts:
        return {v: [] for v in bounds}, {v: 0 for v in bounds}
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")).filter("_id is not null and _text is not null")
    hashes = texts.select("_id", F.xxhash64("_text").alias("_hash")).join(known, "_id").groupBy("_label", "_hash").agg(F.min("_id").alias("_id"))
    hashes = write_stage(hashes, "labelled")
    distinct = {r["_label"]: r["n"] for r in hashes.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    cut = F.lit(0)
    for v, n in distinct.items():
        cut = F.when(F.col("_label") == v, min(_STEP, _STEP * bounds[v] // n)).otherwise(cut)
    # The bounds hold for distinct texts, so these few rows may go to every task.
    chosen = F.broadcast(hashes.filter(F.pmod(F.col("_hash"), F.lit(_STEP)) < cut))
    rows = texts.join(chosen, "_id").filter(F.xxhash64("_text") == F.col("_hash")).select("_label", "_text").distinct()
    out: dict[int, list[str]] = {v: [] for v in bounds}
    for r in rows.toLocalIterator():
        out[r["_label"]].append(r["_text"])
    return {v: sorted(x) for v, x in out.items()}, {v: counts.get(v, 0) for v in bounds}


def unlabelled_texts(docs: DataFrame, rows: int, doc_id: str = "doc_id", text: str = "text") -> list[str]:
    """About `rows` distinct texts of all documents at most, chosen by a hash of the id."""
    n = docs.count()
    if not n:
        return []
    chosen = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")).filter((F.pmod(F.xxhash64("_id"), F.lit(_STEP)) < min(_STEP, _STEP * rows // n)) & F.col("_text").isNotNull())
    return sorted(r["_text"] for r in chosen.select("_text").distinct().toLocalIterator())
