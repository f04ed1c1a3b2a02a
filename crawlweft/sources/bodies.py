"""Page bodies by key."""

import gzip
import re
from itertools import groupby
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft.functions.charsets import decode
from crawlweft.functions.html import html_charset
from crawlweft.operators.staging import is_small, write_stage


#: Rows of a batch of bodies at most, and bytes from which on it is passed on.
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 24
#: Files, and bytes of them, for which a reading task is made; rows from which on a list of files is passed on.
TASK_FILES, TASK_BYTES, LISTED_ROWS = 4000, 1 << 25, 10_000


def content_key(item_name: Column) -> Column:
    """Key of a page's body: its name without `?` and `/` at either end."""
    return F.btrim(item_name, F.lit("?/"))


def _key_from_path(path: str) -> Column:
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    inside = F.substring_index(file, path.rstrip("/") + "/", -1)
    return F.regexp_replace(inside, r"\.gz$", "")


def _uri(spark: SparkSession, path: str) -> str:
    """`path` as Spark understands it, with its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.toUri().getScheme() is None:
        place = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place)
    return re.sub("^file:/+", "file:///", place.toUri().toString())


def _is_open_folder(uri: str) -> bool:
    """Whether `uri` is a folder that tasks can open by themselves."""
    try:
        system, root = fs.FileSystem.from_uri(uri)
        return system.get_file_info(root).type == fs.FileType.Directory
    except (pa.ArrowException, OSError):
        return False


def _is_hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


_FILE = "name string, size long"


def _list(folders: DataFrame, uri: str, deep: bool) -> DataFrame:
    """Rows (name, size) below `uri`, those without a size replaced by what is in that folder; `deep`: by all files below it."""

    def run(batches):
        system, root = fs.FileSystem.from_uri(uri)
        names, sizes = [], []
        for batch in batches:
            for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                left = [name] if size is None else []
                if size is not None:
                    names.append(name)
                    sizes.append(size)
                while left:
                    folder = left.pop()
                    for x in system.get_file_info(fs.FileSelector(f"{root}/{folder}".rstrip("/"))):
                        is_folder, inside = x.type == fs.FileType.Directory, f"{folder}/{x.base_name}".lstrip("/")
                        if _is_hidden(x.base_name) or not is_folder and not x.size:
                            continue
                        if is_folder and deep:
                            left.append(inside)
                        else:
                            names.append(inside)
                            sizes.append(None if is_folder else x.size)
                    if len(names) >= LISTED_ROWS:
                        yield pa.RecordBatch.from_pydict({"name": names, "size": pa.array(sizes, pa.int64())})
                        names, sizes = [], []
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "size": pa.array(sizes, pa.int64())})

    return folders.mapInArrow(run, _FILE)


def _read(files: DataFrame, uri: str) -> DataFrame:
    """(content_key, bytes) of each file (name, size) below `uri`, unpacked."""

    def run(batches):
        system, root = fs.FileSystem.from_uri(uri)
        keys, contents, size = [], [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{name}", compression="detect") as file:
                    contents.append(file.read())
                keys.append(name.removesuffix(".gz"))
                size += len(contents[-1])
                if len(keys) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pydict({"content_key": keys, "bytes": pa.array(contents, pa.binary())})
                    keys, contents, size = [], [], 0
        yield pa.RecordBatch.from_pydict({"content_key": pa.array(keys, pa.string()), "bytes": pa.array(contents, pa.binary())})

    return files.mapInArrow(run, "content_key string, bytes binary")


def read_gzip_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One row per gzip file below `path`: (content_key, bytes).

    Bytes are kept as they are, whatever their charset.  Tasks list the folders, into a
    table below the shared folder, and read the files; the driver never holds a list of them.
    Many small files go to one task.  What tasks cannot open by themselves (patterns of
    paths, file systems that only Hadoop knows) is read by Spark's text source, whose list
    of files is kept on the driver.
    """
    uri = _uri(spark, path)
    if not _is_open_folder(uri):
        return (
            spark.read.option("recursiveFileLookup", "true")
            .text(path, wholetext=True)
            .select(_key_from_path(path).alias("content_key"), F.col("value").cast("binary").alias("bytes"))
        )
    cores = spark.sparkContext.defaultParallelism
    top = _list(spark.createDataFrame([("", None)], _FILE), uri, deep=False).repartition(cores, "name")
    second = _list(top, uri, deep=False).repartition(4 * cores, "name")
    files = write_stage(_list(second, uri, deep=True), "files")
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return _read(files.repartition(max(cores, n // TASK_FILES, size // TASK_BYTES), "name"), uri)


#: Folders over which `write_gzip_bodies` deals its files.
FOLDERS = 256


def write_gzip_bodies(bodies: DataFrame, path: str) -> None:
    """One gzip file per key of (key, value) below `path`, named `folder/key=task.gz`; rows without a key are left out.

    Files are dealt over a fixed number of folders and written by the tasks straight
    into their place: a folder for each key would cost more than its file, in the writer
    as in every later listing.  Each value is a line; rows of one key in one task share
    a file.  A task that is run again writes the same files.
    """
    key, value = bodies.columns
    bodies.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    uri = _uri(bodies.sparkSession, path)

    def write(batches):
        system, root = fs.FileSystem.from_uri(uri)
        made, n = set(), 0
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for name, group in groupby(rows, lambda r: r[0]):
            folder = f"{root}/{crc32(name.encode()) % FOLDERS:02x}"
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            lines = b"".join((x or b"") + b"\n" for _, x in group)
            with system.open_output_stream(f"{folder}/{name}={TaskContext.get().partitionId()}.gz", compression=None) as out:
                out.write(gzip.compress(lines, 6))
            n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    named = bodies.filter(F.col(key).isNotNull()).select(F.col(key), F.col(value).cast("binary"))
    named.sortWithinPartitions(key).mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


def read_binary_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One row per unpacked file: (content_key, bytes), for bodies in other charsets."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(_key_from_path(path).alias("content_key"), F.col("content").alias("bytes"))
    )


def declared_charset(content: Column) -> Column:
    """Charset that a body names itself: by a byte-order mark, else in a `<meta>` tag; null without either."""
    mark = F.hex(F.substring(content, 1, 3))
    by_mark = F.when(mark == "EFBBBF", "utf-8").when(mark.startswith("FFFE") | mark.startswith("FEFF"), "utf-16")
    return F.coalesce(by_mark, html_charset(F.decode(content, "ISO-8859-1")))


def body_text(content: Column, header_charset: Column) -> Column:
    """Text of a body in the charset it names itself, else its header's, else UTF-8."""
    return decode(content, F.coalesce(declared_charset(content), header_charset))


def attach_bodies(pages: DataFrame, bodies: DataFrame) -> DataFrame:
    """Left join on the body key: adds `content`, `n_bytes` and `has_body`.

    `bodies` is (content_key, content), or (content_key, bytes) for bodies that
    are decoded in the charset they name themselves, else in their page's header's.
    Keys are unique on the body side.  When the pages are few, as in an incremental run, their keys are
    broadcast to the scan of the bodies, so that other bodies are never shuffled.
    """
    keyed = pages.withColumn("content_key", content_key(F.col("item_name")))
    keys = keyed.select("content_key")
    if is_small(keys):
        bodies = bodies.join(F.broadcast(keys), "content_key", "left_semi")
    out = keyed.join(bodies.withColumn("has_body", F.lit(True)), "content_key", "left").withColumn(
        "has_body", F.coalesce("has_body", F.lit(False))
    )
    if "bytes" in bodies.columns:
        out = out.withColumns(
            {"content": body_text(F.col("bytes"), F.col("header_charset")), "n_bytes": F.octet_length("bytes")}
        ).drop("bytes")
    else:
        out = out.withColumn("n_bytes", F.octet_length("content"))
    return out


def missing_bodies(pages: DataFrame, bodies: DataFrame) -> DataFrame:
    keyed = pages.withColumn("content_key", content_key(F.col("item_name")))
    return keyed.join(bodies.select("content_key"), "content_key", "left_anti")
