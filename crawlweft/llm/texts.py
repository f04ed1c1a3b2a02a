"""Words, hashes and Arrow plumbing that the operators share."""

from __future__ import annotations

import ctypes
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows an Arrow batch holds at most, so that a batch of very long texts still fits a worker.
BATCH_ROWS = 1000

_word_bytes = {*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)}
#: Lower-cases A-Z and turns every byte outside `[0-9a-z]` and UTF-8's upper half into a blank.
WORDS = bytes(c if c in _word_bytes else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(raw: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text with A-Z lower-cased; none for null."""
    return raw.translate(WORDS).split() if raw else []


def spaced_words(raw: bytes | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased; none for null."""
    return raw.lower().split() if raw else []


def arrow_limits(spark: SparkSession) -> None:
    """Bound what one Arrow batch carries to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def give_back() -> None:
    """Return what a task has freed to the system; a worker process would keep it through later stages."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # other C libraries than glibc
        ctypes.CDLL(None).malloc_trim(0)


def map_rows(df: DataFrame, rows, schema: str) -> DataFrame:
    """`mapInArrow` with a function from a batch's columns (name to Python list) to output columns."""
    arrow_limits(df.sparkSession)
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = rows({n: batch.column(i) for i, n in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([x if isinstance(x := out[f.name], pa.Array) else pa.array(x, f.type) for f in wanted], schema=wanted)
        give_back()

    return df.mapInArrow(run, schema)


def as_bytes(name: str, alias: str = "text"):
    """A text column as its UTF-8 bytes, which Python then need not decode."""
    return F.col(name).cast("string").cast("binary").alias(alias)


_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * _GOLD
    return h ^ (h >> np.uint64(32))


class Spans:
    """64-bit hashes of runs of words: a polynomial over bytes, so that one pass serves every run length.

    `shingles(ws, k)` gives one value per k consecutive words, depending on these words
    alone.  Powers are kept for texts up to `keep` bytes and made anew for longer ones.
    """

    base = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64

    def __init__(self, keep: int = 1 << 18):
        self.keep = keep
        self.up, self.down = self._powers(keep + 1)
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)

    def _powers(self, n: int):
        up = np.full(n, self.base, np.uint64)
        down = np.full(n, pow(self.base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)

    def shingles(self, ws: list[bytes], k: int) -> np.ndarray:
        """One hash per k consecutive words; the whole sequence as one when there are fewer; none for no words."""
        n = len(ws)
        if not n:
            return np.empty(0, np.uint64)
        k = min(k, n)
        joined = b" ".join(ws)
        up, down = (self.up, self.down) if len(joined) <= self.keep else self._powers(len(joined) + 1)
        code = np.frombuffer(joined, np.uint8)
        sums = np.empty(len(joined) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.values[code] * up[: len(code)], out=sums[1:])
        gaps = np.flatnonzero(code == 32)
        starts = np.concatenate(([0], gaps + 1))[: n - k + 1]
        ends = np.concatenate((gaps, [len(code)]))[k - 1 :]
        return mix((sums[ends] - sums[starts]) * down[starts])
