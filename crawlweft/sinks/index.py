"""The index table: validity, strict schema, upsert, stored view, rejects, state.

The table is an append-only folder of document versions, one partition per batch;
readers take the newest version of each id.  A batch therefore writes only its
own documents, and repeating a batch replaces its own partition.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweft import schemas


def valid_groups(df: DataFrame) -> DataFrame:
    """Groups that may be indexed: an id, an address and a raw address."""
    return df.filter(_valid())


def invalid_groups(df: DataFrame) -> DataFrame:
    return df.filter(~_valid())


def _valid() -> Column:
    return F.coalesce(
        (F.col("fingerprint") != "") & (F.col("n_urls") > 0) & (F.col("n_raw_urls") > 0), F.lit(False)
    )


def strict(df: DataFrame, schema: T.StructType = schemas.TEXT_DOCUMENT) -> DataFrame:
    """Bring `df` to the fixed schema; refuse columns the schema does not name."""
    unknown = sorted(set(df.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"columns not in the document schema: {', '.join(unknown)}")
    return df.to(schema)


def latest(versions: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of each key's newest version (all its parts).

    The winners are found on narrow rows with a map-side maximum; the semi join
    keys on the full version, so an id written very often does not land in one
    task.
    """
    newest = versions.groupBy(key).agg(F.max(F.struct(*order)).alias("v")).select(
        key, *[F.col(f"v.{c}").alias(c) for c in order]
    )
    return versions.join(newest, [key, *order], "left_semi").select(*versions.columns)


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Whole-document replace: rows of `new` displace those of the same key."""
    kept = existing.join(new.select(key).distinct(), key, "left_anti")
    return kept.select(*existing.columns).unionByName(new)


def stored_view(documents: DataFrame) -> DataFrame:
    """The columns a hit can return."""
    return documents.drop(*schemas.NOT_STORED)


def to_json(documents: DataFrame, *columns: str) -> DataFrame:
    """One JSON text per document; null fields are left out."""
    names = columns or documents.columns
    return documents.select(F.to_json(F.struct(*names), {"ignoreNullFields": "true"}).alias("json"))


def reject(df: DataFrame, stage: str, reason: str) -> DataFrame:
    """Reject rows `(item_name, fingerprint, stage, reason)` for `df`'s records."""
    return df.select("item_name", "fingerprint", F.lit(stage).alias("stage"), F.lit(reason).alias("reason"))


def write_profiles(profiles: DataFrame, path: str) -> None:
    """Save (lang, n, ngram, count, total) rows as one JSON object per language.

    A trained profile is bounded by its share of the language's letters, so a
    language fits one row.
    """
    total = [F.max(F.when(F.col("n") == n, F.col("total"))) for n in (1, 2, 3)]
    profiles.groupBy(F.col("lang").alias("name")).agg(
        F.map_from_entries(F.collect_list(F.struct("ngram", "count"))).alias("freq"), F.array(*total).alias("n_words")
    ).write.json(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch partition; writing it again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batch partitions of a table with their `batch_id`; empty when none is written."""
    fields = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(fields).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)


def compact(spark: SparkSession, path: str, target: str, schema: T.StructType, key: str, *order: str) -> None:
    """Rewrite a table's newest versions as the single first batch of `target`."""
    rows = latest(read_batches(spark, path, schema), key, *order).drop("batch_id")
    write_batch(rows, target, 0)
