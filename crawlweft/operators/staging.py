"""Cutting lineage, and size checks before a broadcast."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share, `spark.checkpoint.dir`.

    Where it is unset, a local session (one machine) uses the warehouse folder; on a
    cluster nothing is guessed, as executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/crawlweft/{name}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Later passes then read only the columns they need, and a lost executor costs
    a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that `scratch_path` made, once nothing reads its stages any more."""
    if "/crawlweft/" not in folder:
        raise ValueError(f"not a scratch folder: {folder}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether `df` has at most `max_rows` rows and its texts `max_bytes` bytes.

    Rows written into the plan itself are known without a job; all others are counted,
    never estimated.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if plan.getClass().getSimpleName() == "LocalRelation":
        return int(plan.maxRows().get()) <= max_rows and int(str(plan.stats().sizeInBytes())) <= max_bytes
    widths = [F.coalesce(F.octet_length(F.col(f"`{n}`")), F.lit(0)) for n, t in df.dtypes if t in ("string", "binary")]
    width = sum(widths, F.lit(0)).cast("long")
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; beyond `max_rows` Spark merges instead.

    `df` should be cheap to scan (a stage, a file or an aggregate of one) and
    have narrow rows.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df
