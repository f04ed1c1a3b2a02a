"""Repeated strings by suffix arrays: interval expansion on a Burrows-Wheeler transform.

All byte strings of `length` that start at more than one place are found, and the bytes that
they cover are cut.  Inside a block of text the search goes as follows.  The transform of the
block's segments is built from their suffix array.  Starting with the empty string, intervals of suffixes
that share a prefix are extended backward by one byte, breadth first, for all bytes and
intervals of a level at once.  The interval of a string of l + 1 bytes ends where the common prefix with
the next suffix has l bytes, so common prefixes come out by increasing value; an interval whose end is
known already is not followed.  After `length` levels the search stops: suffixes whose common
prefix is still unknown share at least `length` bytes.

Blocks are made so that equal strings meet in one.  Every window of `length` bytes has a key: the
least hash of its grams of `GRAMS[0]` bytes.  Consecutive windows with one key make a segment.
Only keys with several occurrences matter, and of equal segments one is enough, with their
count: segments that occur twice need no search.  Segments travel by key to tasks,
which search blocks of about `BLOCK` bytes.  A key that has more than `KEY_BYTES` of different segments,
such as a line shared by a third of all documents, is not searched as one: its segments are texts
of their own and are dealt anew by longer grams (`GRAMS[1]`, ...), which the line does not fill,
and in the end by whole windows, of which equal ones are only counted.

Texts are known by their digests, so that copies of a document weigh as one text with a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.typing import NDArray
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from crawlweft.llm.fetch import key_filter, packed_texts
from crawlweft.llm.substrings import sliding_minima
from crawlweft.llm.texts import Spans, arrow_limits, mix
from crawlweft.operators.staging import broadcast_if_small, scratch_path, write_stage

LENGTH = 400  # bytes
GRAMS = (64, 192, 304, 360, 388)
#: Different segments of one key that are searched as one, and text of a block, in bytes.
KEY_BYTES = 1 << 18
BLOCK = 1 << 20
_PLACE_BITS = 20
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)


def suffix_array(segments: list[bytes]) -> tuple[NDArray, NDArray, NDArray]:
    """(code, suffixes, ranks) of the segments in a row; each ends with a separator of its own, less than any byte.

    Suffixes are sorted by their first eight bytes and then by prefix doubling, ever only
    those that are not yet told apart.  UTF-8 has no byte 255, so a byte's code is one more.
    """
    sizes = np.fromiter((len(s) + 1 for s in segments), np.int64, len(segments))
    n = int(sizes.sum())
    code = np.zeros(n + 8, np.uint8)
    code[: n - 1] = np.frombuffer(b"\xff".join(segments), np.uint8) + np.uint8(1)
    left = np.repeat(np.cumsum(sizes) - 1, sizes) - np.arange(n)  # bytes before the separator
    word = np.zeros(n, np.uint64)
    for j in range(8):
        word |= np.where(left > j, code[j : n + j], 0).astype(np.uint64) << np.uint64(56 - 8 * j)
    suffixes = np.argsort(word, kind="stable")
    word = word[suffixes]
    # Suffixes that end within the word differ by their separators, in the order of the segments.
    new = np.ones(n, bool)
    new[1:] = (word[1:] != word[:-1]) | (left[suffixes[1:]] < 8)
    slots, ranks, depth = np.arange(n), np.empty(n, np.int64), 8
    open_ = suffixes
    while True:
        ranks[open_] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        lone = new.copy()
        lone[:-1] &= new[1:]
        slots = slots[~lone]
        if not len(slots):
            return code[:n], suffixes, ranks
        open_ = suffixes[slots]
        key = ranks[open_] << 32 | ranks[open_ + depth]
        order = np.argsort(key, kind="stable")
        open_, key = open_[order], key[order]
        suffixes[slots] = open_
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        depth *= 2


def common_prefixes(code: NDArray, suffixes: NDArray, ranks: NDArray, length: int) -> NDArray:
    """For each suffix the common prefix with the one before in order, or `length` where it is that long or longer."""
    n, separators = len(code), int((code == 0).sum())
    first = np.zeros(n + 1, np.uint8)
    first[:n] = code[suffixes]
    before = np.where(suffixes > 0, code[suffixes - 1], 0)  # the transform; strings do not reach over separators
    back = ranks[suffixes - 1]
    known = np.full(n + 1, length, np.int64)
    known[0] = known[n] = 0
    owner = np.full(n + 2, -1, np.int64)
    low, high, made = np.array([0]), np.array([n]), 0
    for level in range(length):
        width = high - low
        mine = np.repeat(np.arange(len(low)), width)
        rows = np.arange(len(mine)) + (low - np.cumsum(width) + width)[mine]
        inside = before[rows] != 0
        to = back[rows[inside]]
        mine = mine[inside] + made
        made += len(low)
        # Rows of one interval with one byte before go to consecutive places.
        owner[to] = mine
        ends = np.sort(to[(owner[to + 1] != mine) | (first[to + 1] != first[to])]) + 1
        starts = np.sort(to[(owner[to - 1] != mine) | (first[to - 1] != first[to])])
        fresh = known[ends] == length
        low, high = starts[fresh], ends[fresh]
        known[high] = level
        known[0] = known[n] = 0
        if not level:  # every separator is a byte of its own
            known[1 : separators + 1] = 0
            low = np.concatenate((np.arange(separators), low))
            high = np.concatenate((np.arange(1, separators + 1), high))
        if not len(low):
            break
    return known[:n]


def repeated_starts(segments: list[bytes], length: int) -> list[NDArray]:
    """Per segment the places from which a string of `length` bytes goes that starts elsewhere in them too."""
    code, suffixes, ranks = suffix_array(segments)
    shared = common_prefixes(code, suffixes, ranks, length) == length
    shared[:-1] |= shared[1:]
    found = np.sort(suffixes[shared])
    starts = np.concatenate(([0], np.cumsum([len(s) + 1 for s in segments])))
    return [x - a for x, a in zip(np.split(found, np.searchsorted(found, starts[1:-1])), starts, strict=False)]


def runs_of(places: NDArray) -> list[dict[str, int]]:
    """Sorted places as runs [first, stop)."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return [{"first": int(x[0]), "stop": int(x[-1]) + 1} for x in np.split(places, cut)]


def segments_of(raw: bytes, gram: int, length: int, spans: Spans) -> tuple[NDArray, ...]:
    """(start, size, key, inner) of the segments of a text; `inner` says that a segment may repeat a string in itself.

    One gram is the least of at most `length - gram + 1` windows.  Longer runs, which need equal grams, are
    cut after so many, so that periodic texts fall into few different segments.  With `gram`
    equal to `length`, each segment is a whole run of equal windows.
    """
    out, most = [], length - gram + 1
    step = (1 << _PLACE_BITS) - length
    for at in range(0, len(raw) - length + 1, step):
        code = np.frombuffer(raw, np.uint8, min(len(raw) - at, step + length - 1), at)
        n = len(code)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(spans.values[code] * spans.up[:n], out=sums[1:])
        hashed = mix((sums[gram:] - sums[:-gram]) * spans.down[: n - gram + 1])
        # The place in the lowest bits picks the leftmost of equal grams.
        least = sliding_minima(hashed & ~_PLACE | np.arange(len(hashed), dtype=np.uint64), length - gram + 1)
        place = (least & _PLACE).astype(np.int64)
        value = hashed[place]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        start = np.flatnonzero(new)
        windows = np.diff(np.concatenate((start, [len(value)])))
        if len(windows) and gram < length and windows.max() > most:
            parts = -(-windows // most)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            start = np.repeat(start, parts) + nth * most
            windows = np.diff(np.concatenate((start, [len(value)])))
        last = start + windows - 1
        out.append((start + at, windows + length - 1, value[start].view(np.int64), place[start] != place[last]))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _spans(length: int) -> Spans:
    return Spans(keep=(1 << _PLACE_BITS) + length)


_RANGES = "array<struct<first:long,stop:long>>"
_RANGES_KIND = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))


def _occurrences(source: DataFrame, gram: int, length: int) -> DataFrame:
    """(tid, start, size, key, seg, inner, n) of the segments of texts (tid, n, text).

    `seg` is a segment's digest; of a run of equal windows, which differ in number alone, it is the window's.
    """
    schema = "tid binary, start long, size int, key long, seg binary, inner boolean, n long"

    def run(batches):
        import xxhash

        spans, digest = _spans(length), xxhash.xxh3_128_digest
        for batch in batches:
            columns = [[] for _ in range(7)]
            for tid, n, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                start, size, key, inner = segments_of(raw, gram, length, spans)
                for column, values in zip(columns, ([tid] * len(start), start, size.astype(np.int32), key, None, inner, [n] * len(start)), strict=True):
                    if values is None:
                        column += [digest(raw[a : a + (length if gram == length else s)]) for a, s in zip(start.tolist(), size.tolist(), strict=True)]
                    elif isinstance(values, list):
                        column += values
                    else:
                        column.append(values)
            if columns[0]:
                arrays = [pa.array(np.concatenate(c)) if isinstance(c[0], np.ndarray) else pa.array(c, k) for c, k in zip(columns, (pa.binary(), None, None, None, pa.binary(), None, pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["tid", "start", "size", "key", "seg", "inner", "n"])

    arrow_limits(source.sparkSession)
    return source.filter(F.octet_length("text") >= length).select("tid", "n", "text").mapInArrow(run, schema)


def _texts_of(segs: DataFrame, source: DataFrame) -> DataFrame:
    """Segments (seg, key, n, tid, start, size) with their `bytes`, out of one copy of each text."""
    wanted = segs.groupBy("tid").agg(F.collect_list(F.struct("seg", "key", "n", "start", "size")).alias("segs"))  # of one text
    texts = packed_texts(source.select("tid", "text"), "tid", key_filter(wanted.select("tid"))).dropDuplicates(["tid"])
    schema = "seg binary, key long, n long, bytes binary"
    kinds = pa.schema([("seg", pa.binary()), ("key", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())])

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for packed, segs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = unpack(packed)
                rows = [{"seg": s["seg"], "key": s["key"], "n": s["n"], "bytes": raw[s["start"] : s["start"] + s["size"]]} for s in segs]
                yield pa.RecordBatch.from_pylist(rows, kinds)

    arrow_limits(source.sparkSession)
    return texts.join(wanted, "tid").select("text", "segs").mapInArrow(run, schema)


def _searched(segs: DataFrame, length: int, block: int) -> DataFrame:
    """(seg, ranges) of window starts that repeat, for segments (seg, key, n, bytes) that occur once; keys stay together."""
    kinds = pa.schema([("seg", pa.binary()), ("ranges", _RANGES_KIND)])

    def search(held):
        found = repeated_starts([raw for _, _, raw in held], length)
        rows = [{"seg": seg, "ranges": runs_of(places)} for (seg, n, _), places in zip(held, found, strict=True) if n == 1 and len(places)]
        return pa.RecordBatch.from_pylist(rows, kinds)

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for key, seg, n, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if size >= block and key != last:
                    yield search(held)
                    held, size = [], 0
                held.append((seg, n, raw))
                size, last = size + len(raw), key
        if held:
            yield search(held)

    arrow_limits(segs.sparkSession)
    dealt = segs.select("key", "seg", "n", "bytes").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, f"seg binary, ranges {_RANGES}")


def _repeated(source: DataFrame, length: int, grams: tuple[int, ...], key_bytes: int, block: int, folder: str) -> DataFrame:
    """(tid, first, stop): runs of window starts that repeat, in texts (tid, n, text), each of which occurs n times."""
    whole = not grams  # keys of whole windows
    occurrences = write_stage(_occurrences(source, length if whole else grams[0], length), "occurrences", folder)
    windows = (F.col("size") - (length - 1)).cast("long")
    if whole:  # every segment is a run of one and the same window
        counts = occurrences.groupBy("seg").agg(F.sum(F.col("n") * windows).alias("n")).filter("n > 1").select("seg")
        return occurrences.join(counts, "seg").select("tid", F.col("start").alias("first"), (F.col("start") + windows).alias("stop"))
    keys = occurrences.groupBy("key").agg(F.sum("n").alias("n"), F.max("inner").alias("inner")).filter("n > 1 or inner").select("key")
    keys = write_stage(keys, "keys", folder)
    # Copies of a text count together.
    kept = occurrences.join(broadcast_if_small(keys), "key").groupBy("tid", "start", "size", "key", "seg", "inner").agg(F.sum("n").alias("n"))
    kept = write_stage(kept, "kept", folder)
    segs = kept.groupBy("seg", "key", "size").agg(F.sum("n").alias("n"), F.max("inner").alias("inner"), F.min(F.struct("tid", "start")).alias("place"))
    segs = write_stage(segs.select("seg", "key", "size", "n", "inner", "place.*"), "segs", folder)
    work = segs.groupBy("key").agg(F.count("*").alias("segs"), F.min("n").alias("least"), F.max("inner").alias("inner"), F.sum("size").alias("bytes"))
    work = write_stage(work.filter("least = 1 and (segs > 1 or inner)").select("key", (F.col("bytes") > key_bytes).alias("hot")), "work", folder)
    found = segs.filter("n > 1").select("seg", F.array(F.struct(F.lit(0).cast("long").alias("first"), windows.alias("stop"))).alias("ranges"))
    if not work.isEmpty():
        wanted = write_stage(segs.join(broadcast_if_small(work), "key").select("seg", "key", "n", "tid", "start", "size", "hot"), "wanted", folder)
        few, many = wanted.filter("not hot"), wanted.filter("hot")
        found = found.unionByName(write_stage(_searched(_texts_of(few, source), length, block), "searched", folder))
        if not many.isEmpty():
            texts = write_stage(_texts_of(many, source).select(F.col("seg").alias("tid"), F.col("n"), F.col("bytes").alias("text")), "hot", folder)
            deeper = _repeated(texts, length, grams[1:], key_bytes, block, f"{folder}/deeper")
            # A segment has a bounded size, and so has its list.
            deeper = deeper.groupBy(F.col("tid").alias("seg")).agg(F.collect_list(F.struct("first", "stop")).alias("ranges"))
            found = found.unionByName(deeper.join(segs.filter("n = 1").select("seg"), "seg", "left_semi"))
    found = write_stage(found, "found", folder)
    hits = kept.join(found, "seg").select("tid", "start", F.explode("ranges").alias("range"))
    return hits.select("tid", (F.col("start") + F.col("range.first")).alias("first"), (F.col("start") + F.col("range.stop")).alias("stop"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint ranges that cover `ranges`; ranges that touch are one."""
    out: list[tuple[int, int]] = []
    for first, stop in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((first, stop))
    return out


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, grams: tuple[int, ...] = GRAMS, key_bytes: int = KEY_BYTES, block: int = BLOCK) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, spans and kept.

    `spans` are the byte ranges [first, stop), maximal and in order, that are covered by
    strings of `length` bytes which also start at another place, of the same text or
    another row's; `kept` are the text's other bytes in UTF-8.  Null texts are empty; texts
    shorter than `length` stay whole.  Rows that repeat an id or a text, and null ids, are rows like any
    other.  A table without rows gives none.  Other columns are ignored.
    """
    folder = scratch_path(docs.sparkSession, "suffix-arrays")
    kind = docs.schema[doc_id].dataType.simpleString()
    raw = F.coalesce(F.col(f"`{text}`").cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), raw.alias("text")).withColumn("tid", F.unhex(F.md5("text")))
    source = rows.select("tid", F.lit(1).cast("long").alias("n"), "text")
    hits = _repeated(source, length, grams, key_bytes, block, folder)
    # The runs of one text; there are fewer than its windows.
    runs = hits.groupBy(F.col("tid").alias("_tid")).agg(F.collect_list(F.struct("first", "stop")).alias("runs"))
    runs = write_stage(runs, "runs", folder)
    schema = f"doc_id {kind}, n_bytes long, spans {_RANGES}, kept binary"
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def pack(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([squeeze(x) for x in batch.column(2).to_pylist()], pa.binary())], ["doc_id", "tid", "packed"])

    def cut(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, spans, kept = [], [], []
            for packed, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, at, parts = unpack(packed), 0, []
                ranges = merged([(r["first"], r["stop"] + length - 1) for r in runs or ()])
                for first, stop in ranges:
                    parts.append(raw[at:first])
                    at = stop
                sizes.append(len(raw))
                spans.append([{"first": a, "stop": b} for a, b in ranges])
                kept.append(b"".join([*parts, raw[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, _RANGES_KIND), pa.array(kept, pa.binary())], schema=wanted)

    arrow_limits(docs.sparkSession)
    packed = rows.select("doc_id", "tid", "text").mapInArrow(pack, f"doc_id {kind}, tid binary, packed binary")
    told = packed.join(runs, F.col("tid") == F.col("_tid"), "left").select("doc_id", "packed", "runs")
    return told.mapInArrow(cut, schema)
