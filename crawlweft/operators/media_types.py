"""Which media types are worth reading."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft.operators.staging import broadcast_if_small, is_small
from crawlweft.sources.lists import fixed_table, rules_from_values

INDEXABLE, NON_INDEXABLE, COMMON = (
    "IndexableMediaTypes",
    "NonIndexableMediaTypes",
    "CommonMediaTypes",
)


def rules(spark: SparkSession, sections: dict[str, list[str]]) -> DataFrame:
    rows = [(name, value) for name, values in sections.items() for value in values]
    return rules_from_values(fixed_table(spark, rows, "section", "value"))


def primary_type(media_type: Column) -> Column:
    return F.substring_index(F.lower(media_type), "/", 1)


def close_over_known_types(rule_table: DataFrame, known_types: DataFrame) -> DataFrame:
    """Every known type (`value`) that no rule settles becomes indexable."""
    known = known_types.select("value", primary_type(F.col("value")).alias("primary")).distinct()
    settled_exact = rule_table.filter((F.col("section") == NON_INDEXABLE) & (F.col("kind") == "exact"))
    settled_primary = rule_table.filter(
        F.col("section").isin(INDEXABLE, NON_INDEXABLE) & (F.col("kind") == "primary")
    )
    added = known.join(settled_exact, "value", "left_anti").join(
        settled_primary.select(F.col("value").alias("primary")), "primary", "left_anti"
    )
    return rule_table.unionByName(
        added.select(F.lit(INDEXABLE).alias("section"), F.lit("exact").alias("kind"), "value")
    ).distinct()


def _verdicts(rule_table: DataFrame, kind: str, key: str) -> DataFrame:
    return (
        rule_table.filter((F.col("kind") == kind) & F.col("section").isin(INDEXABLE, NON_INDEXABLE))
        .groupBy(F.col("value").alias(key))
        .agg(
            F.bool_or(F.col("section") == NON_INDEXABLE).alias(f"{kind}_no"),
            F.bool_or(F.col("section") == INDEXABLE).alias(f"{kind}_yes"),
        )
    )


def decide(records: DataFrame, rule_table: DataFrame, column: str = "header_media_type") -> DataFrame:
    """Add `decision`: yes, no or unknown.

    Non-indexable rules go before indexable ones, primary types before exact
    types.  A few media types make up most of any crawl, so the rules are
    broadcast after counting them; only a rule list of a size no one keeps would
    be merged instead.
    """
    hint = F.broadcast if is_small(rule_table) else (lambda df: df)
    out = (
        records.withColumns({"_exact": F.lower(column), "_primary": primary_type(F.col(column))})
        .join(hint(_verdicts(rule_table, "primary", "_primary")), "_primary", "left")
        .join(hint(_verdicts(rule_table, "exact", "_exact")), "_exact", "left")
    )
    decision = (
        F.when(F.col(column).isNull(), "no")
        .when(F.col("primary_no") | F.col("exact_no"), "no")
        .when(F.col("primary_yes") | F.col("exact_yes"), "yes")
        .otherwise("unknown")
    )
    return out.withColumn("decision", decision).drop(
        "_exact", "_primary", "primary_no", "primary_yes", "exact_no", "exact_yes"
    )


def flag_common(documents: DataFrame, rule_table: DataFrame, column: str = "media_type") -> DataFrame:
    """Add `is_common_type`: exact, case-sensitive membership of the common list."""
    common = rule_table.filter(F.col("section") == COMMON).select(F.col("value").alias(column)).distinct()
    return documents.join(broadcast_if_small(common).withColumn("_common", F.lit(True)), column, "left").withColumn(
        "is_common_type", F.coalesce("_common", F.lit(False))
    ).drop("_common")
