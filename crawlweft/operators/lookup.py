"""Lookups over the document, token and postings tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft.functions.tokens import ANALYZERS


def keyword(documents: DataFrame, column: str, value: str) -> DataFrame:
    """Documents whose unanalyzed field (text or list of texts) holds exactly `value`."""
    if documents.schema[column].dataType.typeName() == "array":
        return documents.filter(F.array_contains(column, value))
    return documents.filter(F.col(column) == value)


def date_range(documents: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Documents with any date of the list in [start, end]."""
    return documents.filter(F.exists(column, lambda d: d.between(start, end)))


def number_range(documents: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return documents.filter(F.col(column).between(low, high))


def flag(documents: DataFrame, column: str, value: bool) -> DataFrame:
    return documents.filter(F.col(column) == F.lit(value))


def query_terms(spark: SparkSession, text: str, analyzer: str = "standard") -> list[str]:
    """Terms of a query text, by the analyzer of the field that it looks in, in order."""
    found = spark.range(1).select(F.transform(ANALYZERS[analyzer](F.lit(text)), lambda t: t["term"]).alias("terms"))
    return found.first()["terms"]


def all_terms(token_rows: DataFrame, field: str, terms: list[str], key: str = "id") -> DataFrame:
    """(key, hits): documents that hold every term in the field."""
    wanted = sorted(set(terms))
    return (
        token_rows.filter((F.col("field") == field) & F.col("term").isin(wanted))
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("hits"))
        .filter(F.col("n_terms") == len(wanted))
        .select(key, "hits")
    )


def phrase(token_rows: DataFrame, field: str, terms: list[str], *key: str) -> DataFrame:
    """(key, position): every place where the terms stand next to each other in order.

    Each token votes for the start it would belong to; a start with a vote for
    every offset is a match.
    One shuffle by (key, start), no self join.  `key` is `id` and `part` by default, so
    that no phrase runs from one part of a document into another.
    """
    key = key or ("id", "part")
    offsets = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(t).alias("word")) for i, t in enumerate(terms)])
    votes = (
        token_rows.filter((F.col("field") == field) & F.col("term").isin(sorted(set(terms))))
        .select(*key, "term", "position", F.explode(offsets).alias("o"))
        .filter(F.col("term") == F.col("o.word"))
        .select(*key, (F.col("position") - F.col("o.at")).alias("position"), "o.at")
    )
    return votes.groupBy(*key, "position").agg(F.size(F.collect_set("at")).alias("n")).filter(F.col("n") == len(terms)).select(*key, "position")
