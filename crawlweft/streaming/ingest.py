"""Incremental indexing of a growing folder of crawl records.

Each micro-batch indexes its new originals against the whole record table and
appends one partition to each output table: documents, rejects, state.  A batch
that is run again after a failure reads the mark of the batches before it and
replaces its own partitions, so nothing is lost, doubled or taken for late.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crawlweft import schemas
from crawlweft.operators.staging import discard
from crawlweft.plans.pipeline import DOCUMENT_VERSION, Indexed
from crawlweft.sinks import index
from crawlweft.sources import records as record_source

STATE = T.StructType([T.StructField("mark", T.DoubleType())])


def saved_mark(spark: SparkSession, target: str, before: int | None = None) -> float | None:
    """High-water mark of the batches before `before` (all by default); None at the start."""
    state = index.read_batches(spark, f"{target}/state", STATE)
    if before is not None:
        state = state.filter(F.col("batch_id") < before)
    return state.agg(F.max("mark")).first()[0]


def save_mark(batch: DataFrame, previous: float | None, target: str, batch_id: int) -> None:
    """The largest `fetched` of the batch, never below the mark before it."""
    mark = record_source.high_water_mark(batch).select(
        F.greatest("mark", F.lit(previous).cast("double")).alias("mark")
    )
    index.write_batch(mark, f"{target}/state", batch_id)


def run_batch(
    batch: DataFrame, batch_id: int, target: str, build: Callable[[DataFrame], Indexed]
) -> None:
    """Index one batch of records: `build` maps fresh originals to documents and rejects."""
    spark = batch.sparkSession
    mark = saved_mark(spark, target, before=batch_id)
    fresh = record_source.originals(batch, mark)
    documents, rejects, stages = build(fresh)
    if mark is not None:
        late = record_source.late_records(batch, mark)
        rejects = rejects.unionByName(index.reject(late, "late", "fetched at or before the mark"))
    index.write_batch(documents, f"{target}/documents", batch_id)
    index.write_batch(rejects, f"{target}/rejects", batch_id)
    save_mark(batch, mark, target, batch_id)
    discard(spark, stages)


def start(
    spark: SparkSession,
    source: str,
    target: str,
    build: Callable[[DataFrame], Indexed],
    fmt: str = "parquet",
    poll: str | None = "10 seconds",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Watch `source` for record files and index what arrives.

    With `poll` the query runs until stopped; with None it drains what is there
    and ends.
    """
    reader = spark.readStream.schema(schemas.CRAWL_RECORD).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    trigger = {"processingTime": poll} if poll else {"availableNow": True}
    return (
        reader.load(source)
        .writeStream.foreachBatch(lambda batch, batch_id: run_batch(batch, batch_id, target, build))
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(**trigger)
        .start()
    )


def current_documents(spark: SparkSession, target: str) -> DataFrame:
    versions = index.read_batches(spark, f"{target}/documents", DOCUMENT_VERSION)
    return index.latest(versions, "id", "version", "batch_id")


def rejects(spark: SparkSession, target: str) -> DataFrame:
    return index.read_batches(spark, f"{target}/rejects", schemas.REJECT)
