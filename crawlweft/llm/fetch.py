"""Whole texts of chosen documents, without shuffling the others.

A Bloom filter of fixed size over the chosen keys is sent to the tasks that read the
documents; a text whose key is surely not chosen is dropped there, and the others are
compressed before they move.  The filter may let a text pass that was not chosen, so a
join must follow; a filter that is too small for its keys only drops less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.texts import arrow_limits, give_back

FILTER_BITS = 25
_HASHES = 3


def _spot(key: Column, k: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(k)), F.lit(1 << FILTER_BITS))


def key_filter(keys: DataFrame) -> Broadcast:
    """The filter over the one column of `keys`, as words of 64 bits; at most `2 ** FILTER_BITS` bits reach the driver."""
    key = F.col(keys.columns[0])
    spots = keys.select(F.explode(F.array(*(_spot(key, k) for k in range(_HASHES)))).alias("at"))
    return bit_table(spots)


def bit_table(spots: DataFrame) -> Broadcast:
    """Bits set at the places in the column `at`, as words of 64 bits; at most `2 ** FILTER_BITS` bits reach the driver."""
    words = spots.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits")).toPandas()
    bits = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return spots.sparkSession.sparkContext.broadcast(bits)


def spots(key: str) -> list[Column]:
    """Columns that `passes` looks at; they must come first."""
    return [_spot(F.col(key), k).alias(f"_spot{k}") for k in range(_HASHES)]


def passes(batch: pa.RecordBatch, bits: np.ndarray) -> np.ndarray:
    """Which rows of a batch may hold a chosen key."""
    at = np.stack([batch.column(k).to_numpy() for k in range(_HASHES)])
    return (bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool).all(axis=0)


def without_spots(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.select(batch.schema.names[_HASHES:])


def packed_texts(source: DataFrame, key: str, held: Broadcast) -> DataFrame:
    """`source` with its last column, a text's bytes, compressed; rows that the filter drops are left out."""

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            keep = passes(batch, held.value)
            if keep.any():
                batch = without_spots(batch.filter(pa.array(keep)))
                texts = pa.array([pack(x or b"") for x in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], batch.schema.names)
        give_back()

    arrow_limits(source.sparkSession)
    return source.select(*spots(key), *source.columns).mapInArrow(run, source.schema)
