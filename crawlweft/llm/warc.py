"""WARC archives: writing, normalising whole-file gzip streams, and reading by offset.

Some crawlers gzip an archive as one stream, which can only be read from its start.  The
normaliser inflates each such file once, as a stream, writes every record as a gzip
member of its own, and puts a sidecar index of (offset, length, record) beside the
archive, so that readers can fetch one record or split a file.

Archives are files in a folder that all machines share; any file system that pyarrow or
Spark can reach by its URI will do.  A task writes files under names of its own and
returns them as rows, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.texts import arrow_limits
from crawlweft.operators.staging import scratch_path, write_stage

#: Records of one archive at most when writing.
ARCHIVE_RECORDS = 2000
LEVEL = 6
CHUNK = 1 << 18
END = "\r\n\r\n"
SALTS = 16
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of bytes: five hexadecimal digits give four letters."""
    digits = F.sha1(payload)
    letters = []
    for k in range(0, 40, 5):
        n = F.conv(F.substring(digits, k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(_BASE32), F.shiftright(n, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """WARC records of pages: page_id, record_type, refers_to, payload_bytes, payload_digest, record (text).

    Of pages with equal payloads of at least `least_bytes` bytes, the one with the
    largest id is the response and the others revisit it.  Null html is an empty payload;
    null urls are left out of the record.  Rows without id are responses.  Rows that
    repeat an id with an equal payload are records of the same type.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    payload = F.col("html").cast("binary")
    rows = rows.withColumn("payload_bytes", F.octet_length(payload).cast("long")).withColumn("payload_digest", base32_sha1(payload))
    # Narrow rows find the winners; those of shared payloads are repeated per salt, so that a hot payload spreads.
    shared = (
        rows.filter((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("winner"), F.min("page_id").alias("least"))
        .filter("winner <> least")
        .select("payload_digest", "winner", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("page_id"), F.lit(SALTS)), F.lit(0)).cast("int")).join(shared, ["payload_digest", "salt"], "left")
    refers = F.when(F.col("winner") != F.col("page_id"), F.col("winner"))
    rows = rows.withColumn("refers_to", refers).withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = F.when(F.col("refers_to").isNull(), F.concat(F.lit(http), "html")).otherwise(F.lit(http))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]+", " ")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to"))),
        F.concat(F.lit("WARC-Profile: "), F.when(F.col("refers_to").isNotNull(), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body.cast("binary")).cast("string")),
    )
    return rows.withColumn("record", F.concat(head, F.lit("\r\n\r\n"), body)).select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "record")


def write_monolithic(warc_records: DataFrame, folder: str) -> None:
    """Archives as whole-file gzip streams of many records, by Spark's text writer."""
    warc_records.select("record").write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", ARCHIVE_RECORDS).text(folder)


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip file of any number of members, in pieces of bounded size."""
    unzip = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            piece = unzip.decompress(chunk, CHUNK * 4)
            if piece:
                yield piece
            if unzip.eof:
                chunk = unzip.unused_data.lstrip(b"\0")
                unzip = zlib.decompressobj(31)
            else:
                chunk = unzip.unconsumed_tail
    if rest := unzip.flush():  # output that was still held back
        yield rest


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record without its end) of a WARC byte stream.

    One record is held at a time.  A stream that ends inside a record raises ValueError,
    as does a record without a length.
    """
    held, at = bytearray(), 0
    pieces = iter(pieces)

    def more() -> bool:
        nonlocal at
        piece = next(pieces, None)
        if piece is None:
            return False
        if at:
            del held[:at]
            at = 0
        held.extend(piece)
        return True

    while True:
        while len(held) - at < 4 and more():
            pass
        while held[at : at + 2] == b"\r\n":  # ends of records, and stray blank lines
            at += 2
        if len(held) - at < 5:
            if more():
                continue
            if held[at:].strip():
                raise ValueError("the archive ends inside a record")
            return
        while (stop := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                raise ValueError("the archive ends inside a header")
        fields = {}
        for line in held[at:stop].decode("utf-8", "replace").split("\r\n")[1:]:
            key, _, value = line.partition(":")
            fields[key.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdigit():
            raise ValueError("a record has no length")
        size = stop + 4 - at + int(fields["content-length"])
        while len(held) - at < size:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield fields, bytes(held[at : at + size])
        at += size


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri else fs.FileSystem.from_uri(f"file://{uri.removeprefix('file:')}")


def _chunks(stream) -> Iterator[bytes]:
    while chunk := stream.read(CHUNK):
        yield chunk


INDEX = "archive string, record long, offset long, length long, record_type string, record_id string"


def normalise(spark, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrite every archive of a folder with one gzip member per record; the index of all of them.

    The index has archive, record (its number), offset, length, record_type, record_id,
    and is also written beside each archive as lines of JSON (`.idx`).  Spark lists and
    hands out the files; a task holds a chunk and one record at a time.  Files without
    records give empty archives and no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    arrow_limits(spark)

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = _open(path)
                # Lost and repeated attempts leave files that no row names.
                archive = f"{target.rstrip('/')}/{PurePosixPath(name).name.removesuffix('.gz').removesuffix('.txt')}-{uuid.uuid4().hex[:12]}.warc.gz"
                out_system, out_name = _open(archive)
                out_system.create_dir(str(PurePosixPath(out_name).parent), recursive=True)
                rows, at = [], 0
                with system.open_input_stream(name, compression=None) as stream, out_system.open_output_stream(out_name, compression=None) as out:
                    for fields, record in split_records(inflate(_chunks(stream))):
                        zipper = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = zipper.compress(record) + zipper.compress(END.encode()) + zipper.flush()
                        out.write(member)
                        rows.append((archive, len(rows), at, len(member), fields.get("warc-type"), fields.get("warc-record-id")))
                        at += len(member)
                with out_system.open_output_stream(f"{out_name}.idx", compression=None) as side:
                    for row in rows:
                        side.write((json.dumps(dict(zip(("record", "offset", "length", "type", "id"), row[1:], strict=True))) + "\n").encode())
                names = [x.split()[0] for x in INDEX.split(", ")]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return files.mapInArrow(run, INDEX)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(index: DataFrame) -> DataFrame:
    """Records of normalised archives, fetched by the index: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Each record is inflated from its own offset.  Length and digest of a response are
    computed from its payload; a mismatch with its header raises ValueError.  A revisit
    has no payload and tells them in its header.
    """
    import base64
    import hashlib

    arrow_limits(index.sparkSession)

    def number(uri: str | None) -> int | None:
        last = (uri or "").rstrip(">").rpartition(":")[2]
        return int(last) if last.lstrip("-").isdigit() else None

    def run(batches):
        opened: dict[str, object] = {}
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if archive not in opened:
                    for f in opened.values():
                        f.close()
                    system, name = _open(archive)
                    opened = {archive: system.open_input_file(name)}
                member = opened[archive].read_at(length, offset)
                fields, record = next(split_records(inflate(iter([member]))))
                body = record[len(record) - int(fields["content-length"]) :]
                payload = body[body.index(b"\r\n\r\n") + 4 :]
                size, digest = int(fields["warc-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "response":
                    found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != (size, digest):
                        raise ValueError(f"record at {offset} of {archive} does not match its digest")
                out.append((number(fields.get("warc-record-id")), size, digest, fields["warc-type"], number(fields.get("warc-refers-to"))))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in READ.split(", ")])
        for f in opened.values():
            f.close()

    return index.select("archive", "offset", "length").mapInArrow(run, READ)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write pages as monolithic archives, normalise these, and read the records back."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_monolithic(records(pages, page_id, url, html, least_bytes), f"{folder}/monolithic")
    index = write_stage(normalise(spark, f"{folder}/monolithic", f"{folder}/normal"), "index", folder)
    return read_archives(index)
