"""Small reference tables: media-type rules and language profiles on disk."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft import schemas


def fixed_table(spark: SparkSession, rows: list[tuple[str, ...]], *names: str) -> DataFrame:
    """A table of fixed texts whose exact size the planner knows."""

    def literal(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def read_rule_list(spark: SparkSession, path: str) -> DataFrame:
    """Rule file -> (section, kind, value).

    `[Section]` lines open a section, `<>` lines are comments, every other line
    is a value.  A file is one row here, so sections keep their order; a rule
    file is configuration of a few hundred lines.
    """
    lines = spark.read.text(path, wholetext=True).select(
        F.explode(F.split(F.concat(F.lit("\n"), "value"), r"\n[ \t]*\[")).alias("block")
    )
    values = lines.select(
        F.trim(F.regexp_extract("block", r"^([^\]\n]*)\]", 1)).alias("section"),
        F.explode(F.split(F.regexp_replace("block", r"^[^\n]*", ""), r"\r?\n")).alias("line"),
    )
    return rules_from_values(
        values.filter((F.col("section") != "") & (F.trim("line") != "") & ~F.col("line").startswith("<>"))
        .select("section", F.trim("line").alias("value"))
        .distinct()
    )


def rules_from_values(values: DataFrame) -> DataFrame:
    """(section, value) -> rules; `type/*` becomes a rule on the primary type."""
    primary = F.col("value").endswith("/*")
    return values.select(
        "section",
        F.when(primary, "primary").otherwise("exact").alias("kind"),
        F.when(primary, F.regexp_replace("value", r"/\*$", "")).otherwise(F.col("value")).alias("value"),
    )


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Language profile files, one JSON object each -> (lang, n, ngram, count, total)."""
    raw = spark.read.schema(schemas.LANGUAGE_PROFILE).json(path)
    return raw.select("name", "n_words", F.explode("freq").alias("ngram", "count")).select(
        F.col("name").alias("lang"),
        F.length("ngram").alias("n"),
        "ngram",
        "count",
        F.element_at("n_words", F.length("ngram")).alias("total"),
    )
