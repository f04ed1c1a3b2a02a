"""Crawl-record scans: typed records, originals, and the narrow attribute form."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft import schemas
from crawlweft.functions import dates, headers


def read_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schemas.CRAWL_RECORD).format(fmt).load(path)


def from_attributes(attributes: DataFrame) -> DataFrame:
    """Narrow (item_name, seq, attribute, value) rows -> one wide row per item.

    The last value of a repeated attribute wins.  `max_by` combines on the map
    side, so an item with very many rows shuffles one row per task.
    """
    known = attributes.filter(F.col("attribute").isin(*schemas.ATTRIBUTE_COLUMNS))
    last = [
        F.expr(f"max_by(value, seq) FILTER (WHERE attribute = '{name}')").alias(column)
        for name, column in schemas.ATTRIBUTE_COLUMNS.items()
    ]
    return known.groupBy("item_name").agg(*last).select(*schemas.CRAWL_RECORD.names)


def typed(records: DataFrame) -> DataFrame:
    """Add `fetched_at`, `fetched_num` and the other columns read from header text."""
    fetched_at = dates.epoch_timestamp(F.col("fetched"))
    return records.withColumns(
        {
            "fetched_num": F.col("fetched").try_cast("double"),
            "fetched_at": fetched_at,
            "discovered_at": dates.discovered_timestamp(F.col("discovered"), F.col("fetched")),
            "modified_at": dates.text_date(F.col("last_modified"), fetched_at),
            "filename": headers.filename(F.col("content_disposition"), F.col("url")),
            "header_media_type": headers.media_type(F.col("content_type")),
            "header_charset": headers.charset(F.col("content_type")),
            "blocked": headers.is_blocked(F.col("googlebot_exclusion_reasons")),
            "malformed": headers.is_malformed_reasons(F.col("googlebot_exclusion_reasons")),
        }
    )


def originals(records: DataFrame, mark: float | None = None) -> DataFrame:
    """Original pages with a fingerprint, fetched strictly after `mark`.

    The predicate on the raw columns reaches the scan; `fetched` is compared as
    a number because text order breaks when the number of digits changes.
    """
    out = records.filter(
        (F.col("original") == "self") & F.col("fingerprint").isNotNull() & F.col("fetched").isNotNull()
    )
    if mark is not None:
        out = out.filter(F.col("fetched").try_cast("double") > F.lit(float(mark)))
    return out


def originals_by_time(records: DataFrame, mark: float | None = None) -> DataFrame:
    """Report of the originals in fetch order."""
    return (
        originals(records, mark)
        .select("item_name", "fetched", "fingerprint")
        .orderBy(F.col("fetched").try_cast("double"), "item_name")
    )


def late_records(records: DataFrame, mark: float) -> DataFrame:
    """Originals at or before the mark: an incremental run never indexes them."""
    return originals(records).filter(F.col("fetched").try_cast("double") <= F.lit(float(mark)))


def high_water_mark(records: DataFrame) -> DataFrame:
    """One row: the largest `fetched` handled, failures included."""
    return originals(records).agg(F.max(F.col("fetched").try_cast("double")).alias("mark"))
