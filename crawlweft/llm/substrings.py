"""Near-duplicate passages by compact windows.

A passage is a run of at least `LENGTH` words.  Tokens are word shingles with several
hash functions.  For one function, a compact window is a node of the Cartesian tree over
the tokens' hashes that spans enough tokens: all passages inside it that hold the node's
token have that token's hash as their minimum.  The windows are read off the sliding
minima: each run of passage starts with one and the same minimum is one window, so the
tree needs no recursion.  Passages share a signature when functions agree, so the windows
of two functions are intersected inside each document, and the pair of minima is the key
on which documents are joined.  A text of n words has about 4 n / LENGTH such keys; a sketch
of all keys drops most of those that occur once before they move.  An edited passage may differ in one pair of minima, so this is done for several pairs of
functions that are independent of each other (`BANDS`).

Documents of one and the same text are joined with others once, under the smallest id; the
rest of them get what was found for it, and the whole text as a passage of that document, and
take part by themselves only at keys where a document fails.

Per key, the first document that has it leads; every other one is paired with it, so a
passage in a third of all documents gives one pair for each of them.  Pairs are verified
on both texts, and only verified passages are reported.  A leader may share a key
without sharing the passage there, and so hide another document that does, even if the
two share a passage elsewhere.  So a document fails at a key unless a verified passage
holds the key's tokens, and one that fails is compared with all the others of the key.  A
leader may also lack the first or last words of a passage that two later documents share.
So a document's tokens around a key that no verified passage holds are open; it is compared
with the first document that has such a token at this key, and if it stays open, with all that
have it.

Where a key has few documents, all of them are compared.  Where it has many, the tokens of all
passages that hold the key's tokens are compared first (`alike`).  If two documents share a passage, a stretch of
it of `LENGTH` words has two thirds of its tokens in both; documents with fewer tokens in common there
than `ALIKE` asks for share no passage at this key, and their texts need not move.  Documents that
both share a passage with a key's leader, with no open token in common, are linked through the leader alone.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.components import components
from crawlweft.llm.fetch import key_filter, packed_texts, passes, spots, without_spots
from crawlweft.llm.texts import WORDS, arrow_limits, as_bytes, give_back, mix
from crawlweft.operators.staging import discard, scratch_path, write_stage

LENGTH = 50  # words of the shortest passage
SHINGLE = 5  # words of a token
SIMILARITY = 0.8  # share of a passage's tokens that must occur in the other passage
#: Hash functions that must agree, and independent sets of so many; to agree on one set is enough.
HASHES, BANDS = 2, 6
#: Documents of a key up to which each one that failed is paired with all the others without looking at the key's places.
FEW = 16
#: Share of the tokens that a passage must have in common from which on two places of a key are alike, and places that are compared at once.
ALIKE, PLACES = 0.75, 2048
#: Kinds of tokens that are counted at once, which bounds a task's table of counts.
KINDS = 512
#: Bits of the sketch that holds which keys occur twice, at most.
MOST_BITS = 1 << 29
#: Keys that a task holds before it sends their places in the sketch.
HELD_KEYS = 1 << 22
#: Tokens from which on the texts at hand are hashed; a place among them and one more stretch has so many bits.
AT_ONCE = 1 << 14
_PLACE_BITS = 22
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
#: Odd factors; tokens are hashed already, so that a product is a hash function of its own.
_SEEDS = mix(np.arange(1, HASHES * BANDS + 1, dtype=np.uint64)) | np.uint64(1)


def sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, from minima of twice as many values in each step."""
    reach = 1
    while 2 * reach <= width:
        values, reach = np.minimum(values[:-reach], values[reach:]), 2 * reach
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Tokens:
    """64-bit hashes of the shingles of a text's words.

    A word is hashed as a polynomial over its bytes, read off running sums, and a shingle
    as one over its words; so a text is never cut into Python objects.  Powers are kept for
    texts up to `keep` bytes and made anew for longer ones.
    """

    base = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64

    def __init__(self, shingle: int, keep: int = 1 << 17):
        self.keep, self.shingle = keep, shingle
        self.up, self.down = self._powers(keep)
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(self.base))

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.full(n, self.base, np.uint64), np.full(n, pow(self.base, -1, 1 << 64), np.uint64)
        up[:1] = down[:1] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)

    def __call__(self, raw: bytes | None) -> np.ndarray:
        """One hash per `shingle` consecutive words; none for texts of fewer words."""
        code = np.frombuffer((raw or b"").translate(WORDS), np.uint8)
        edges = _word_edges(code)
        n = len(edges) // 2 - self.shingle + 1
        if n < 1:
            return np.empty(0, np.uint64)
        up, down = (self.up, self.down) if len(code) <= self.keep else self._powers(len(code))
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(self.values.take(code) * up[: len(code)], out=sums[1:])
        starts, ends = edges[::2], edges[1::2]
        word = mix((sums[ends] - sums[starts]) * down[starts])
        out = word[:n].copy()
        for k in range(1, self.shingle):
            out *= np.uint64(self.base)
            out += word[k : k + n]
        return mix(out)


def _word_edges(code: np.ndarray) -> np.ndarray:
    """First place and place behind the last of each word, in turn, in bytes that `WORDS` translated."""
    form = np.empty(len(code) + 2, bool)
    form[0] = form[-1] = False
    np.not_equal(code, 32, out=form[1:-1])
    return np.flatnonzero(form[1:] != form[:-1])


def compact_windows(tokens: np.ndarray, width: int, hashes: int = HASHES, band: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and token ranges [first, last] of the windows on which the hash functions of one set (`band`) agree.

    A range holds all passages of `width` tokens or more whose minima are the key's.
    """
    key, start, stop, _, _ = _anchored_windows(tokens, width, hashes, band)
    return key, start, stop


def _anchored_windows(tokens: np.ndarray, width: int, hashes: int, band: int) -> tuple[np.ndarray, ...]:
    """Compact windows of one text, and the first and last place of the tokens whose hashes are their minima."""
    stretches = list(_stretches(tokens, width))
    if not stretches:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none, none, none, none
    nth, key, *places = _windows_of_all([x for _, x in stretches], width, hashes, band)
    offset = np.array([at for at, _ in stretches])[nth]
    return key, *(x + offset for x in places)


def _stretches(tokens: np.ndarray, width: int):
    """(offset, tokens) of parts that share no window; a text is one part unless it is very long."""
    step = (1 << _PLACE_BITS - 1) - width
    for at in range(0, len(tokens) - width + 1, step):
        yield at, tokens[at : at + step + width - 1]


def _windows_of_all(parts: list[np.ndarray], width: int, hashes: int, band: int) -> tuple[np.ndarray, ...]:
    """(part, key, start, stop, first, last) of the compact windows of several token sequences, in one go."""
    (found,) = _windows_of_bands(parts, width, hashes, [band])
    return found


def _windows_of_bands(parts: list[np.ndarray], width: int, hashes: int, bands):
    """`_windows_of_all` for each of several sets of functions."""
    tokens, sizes = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    n, begin = len(tokens) - width + 1, np.cumsum(sizes) - sizes
    part = np.repeat(np.arange(len(parts)), sizes)[:n]
    places = np.arange(len(tokens), dtype=np.uint64)
    inside = np.zeros(n, bool)  # where a run of `width` tokens of one part starts
    edge = np.zeros(n, bool)
    for a, b in zip(begin.tolist(), (begin + sizes - width + 1).tolist(), strict=True):
        if b > a:
            inside[a:b] = edge[a] = True
    edge[1:] |= inside[1:] != inside[:-1]
    for band in bands:
        least = [_least(tokens * s, places, width) for s in _SEEDS[band * hashes : (band + 1) * hashes]]
        new = edge.copy()
        for x in least:
            new[1:] |= x[1:] ^ x[:-1] > _PLACE
        start = np.flatnonzero(new)
        keep = inside[start]
        stop = np.append(start[1:], n)[keep]
        start = start[keep]
        key = np.full(len(start), band, np.uint64)
        least = [x[start] for x in least]
        for x in least:
            key = mix(key ^ (x & ~_PLACE))
        back = begin[part[start]]
        at = [(x & _PLACE).astype(np.int64) for x in least]
        yield part[start], key, start - back, stop - back + (width - 2), np.minimum.reduce(at) - back, np.maximum.reduce(at) - back


def _least(hashed: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive hashes; the lowest bits give way to the hash's first place."""
    return sliding_minima(hashed & ~_PLACE | places, width)


def shared_passages(mine: np.ndarray, other: np.ndarray, length: int, shingle: int, similarity: float) -> list[list[int]]:
    """Word ranges [first, behind last] of `mine` whose tokens occur in `other`, of at least `length` words.

    Runs of matching tokens grow over gaps as long as `similarity` of all tokens match.
    """
    return _runs(np.isin(mine, other), length, shingle, similarity)


def _runs(match: np.ndarray, length: int, shingle: int, similarity: float) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], match.astype(np.int8), [0])))).reshape(-1, 2)
    if not len(edges):
        return []
    out, begin, end, matched = [], *edges[0].tolist(), int(edges[0][1] - edges[0][0])
    for a, b in edges[1:].tolist():
        if matched + (b - a) >= similarity * (b - begin):
            end, matched = b, matched + (b - a)
        else:
            out.append((begin, end))
            begin, end, matched = a, b, b - a
    out.append((begin, end))
    return [[a, b + shingle - 1] for a, b in out if b + shingle - 1 - a >= length]


def _within(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the sorted values occur among the sorted others."""
    if not len(others):
        return np.zeros(len(values), bool)
    return others[np.minimum(np.searchsorted(others, values), len(others) - 1)] == values


def _text_windows(texts, length: int, shingle: int, hashes: int, bands: int):
    """(ids, keys, first, last) arrays of the windows of (id, text), many texts at a time."""
    tokens_of, width = Tokens(shingle), length - shingle + 1

    def windows(held):
        ids, offsets = (np.array([x[k] for x in held], np.int64) for k in (0, 1))
        out = []
        for nth, key, _, _, first, last in _windows_of_bands([x[2] for x in held], width, hashes, range(bands)):
            out.append((ids[nth], key, first + offsets[nth], last + offsets[nth]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    held, size = [], 0
    for key, raw in texts:
        for at, part in _stretches(tokens_of(raw), width):
            held.append((key, at, part))
            size += len(part)
            if size >= AT_ONCE:
                yield windows(held)
                held, size = [], 0
    if held:
        yield windows(held)


def _texts(batches, copies: Copies | None = None):
    """(id, text) of batches (id, text); without copies if `copies` tells them by the first columns."""
    for batch in batches:
        if copies:
            batch = without_spots(batch.filter(pa.array(~copies.told(batch))))
        yield from zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True)


class Copies(NamedTuple):
    """Filters that tell rows (id, text) with the text of a smaller id; a few of them pass as others, others never as them."""

    rows: Broadcast
    but: Broadcast  # rows that the first filter only seems to hold

    def told(self, batch: pa.RecordBatch) -> np.ndarray:
        return passes(batch, self.rows.value) & ~passes(batch, self.but.value)


def _with_spots(source: DataFrame, *columns: str) -> DataFrame:
    row = F.xxhash64("id", "tid")
    return source.withColumn("_row", row).select(*spots("_row"), *columns)


def _copies(source: DataFrame, folder: str) -> tuple[DataFrame, Copies | None]:
    """Rows (id, tid, leader, n_words) with the text of a smaller id, and the filters for them if there are any."""

    def count(batches):
        for batch in batches:
            n_words = [len(_word_edges(np.frombuffer(x.translate(WORDS), np.uint8))) // 2 for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n_words, pa.int64())], ["id", "tid", "again", "n_words"])
        give_back()

    # Two hashes of a text, from seeds of their own, stand for it.
    hashed = source.select("id", "tid", F.xxhash64(F.lit(1), "text").alias("again"), "text")
    rows = write_stage(hashed.mapInArrow(count, "id long, tid long, again long, n_words long").distinct(), "texts", folder)
    first = rows.groupBy("tid", "again").agg(F.min("id").alias("leader"), F.max("id").alias("also")).filter("leader <> also").drop("also")
    copies = write_stage(rows.join(first, ["tid", "again"]).filter("id <> leader").select("id", "tid", "leader", "n_words"), "copies", folder)
    if copies.isEmpty():
        return copies, None
    told = key_filter(copies.select(F.xxhash64("id", "tid")))

    def seeming(batches):
        for batch in batches:
            yield without_spots(batch.filter(pa.array(passes(batch, told.value))))

    others = rows.join(copies, ["id", "tid"], "left_anti")
    others = _with_spots(others, "id", "tid").mapInArrow(seeming, "id long, tid long")
    return copies, Copies(told, key_filter(others.select(F.xxhash64("id", "tid"))))


def _at(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each key in a sketch."""
    return (keys >> np.uint64(65 - bits.bit_length())).astype(np.int64), (keys & np.uint64(bits - 1)).astype(np.int64)


def common_keys(source: DataFrame, length: int, shingle: int, hashes: int, bands: int, copies: Copies | None = None) -> Broadcast:
    """A sketch of the keys that occur more than once: words of 64 bits, two bits for some keys.

    Keys that occur once are mostly seen as such; others never.  There are about eight bits for
    a key up to `MOST_BITS`; a fuller sketch only lets more keys pass.  Tasks hold places rather
    than a sketch of their own, and send what they saw once and twice in compressed chunks, which
    are joined in two steps; the first step has a group of each chunk for every 8 GB of text.
    """
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(1 << 16, 1 << int(size * bands // 9).bit_length()))
    chunk = min(bits >> 6, 1 << 16)
    salts = 1 + (size >> 33)

    def marked(at):
        """Words of a chunk with the bits at some places, which are sorted, and compressed."""
        words = np.zeros(chunk, np.uint64)
        if len(at):
            word, bit = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            words[word[starts]] = np.bitwise_or.reduceat(bit, starts)
        return zstandard.ZstdCompressor(level=1).compress(words.tobytes())

    def count(batches):
        held, n = np.empty(HELD_KEYS, np.uint32), 0
        salt = TaskContext.get().partitionId() % salts

        def flush():
            at = held[:n]
            at.sort()
            again = at[1:][at[1:] == at[:-1]]
            for k in range(bits // (chunk << 6)):
                here = np.array([k * chunk << 6, (k + 1) * chunk << 6])
                once, twice = (x[slice(*np.searchsorted(x, here.astype(x.dtype)))].astype(np.int64) - here[0] for x in (at, again))
                if len(once):
                    yield pa.RecordBatch.from_pydict({"chunk": [k], "salt": [salt], "once": [marked(once)], "twice": [marked(twice)]}, schema)

        for _, keys, _, _ in _text_windows(_texts(batches, copies), length, shingle, hashes, bands):
            at = np.concatenate(_at(keys, bits)).astype(np.uint32)
            while len(at):
                some = at[: HELD_KEYS - n]
                held[n : n + len(some)] = some
                n, at = n + len(some), at[len(some) :]
                if n == HELD_KEYS:
                    yield from flush()
                    n = 0
        yield from flush()
        give_back()

    schema = pa.schema([("chunk", pa.int32()), ("salt", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def joined(rows):
        if len(rows) == 1:
            return rows
        pack, unpack = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        once, twice = np.zeros(chunk, np.uint64), np.zeros(chunk, np.uint64)
        for a, b in zip(rows["once"], rows["twice"], strict=True):
            a, b = (np.frombuffer(unpack(x), np.uint64) for x in (a, b))
            twice |= b | once & a
            once |= a
        return rows[:1].assign(once=[pack(once.tobytes())], twice=[pack(twice.tobytes())])

    kinds = "chunk int, salt int, once binary, twice binary"
    parts = _read(source, copies).mapInArrow(count, kinds).groupBy("chunk", "salt").applyInPandas(joined, kinds)
    out, unpack = np.zeros(bits >> 6, np.uint64), zstandard.ZstdDecompressor().decompress
    for r in parts.groupBy("chunk").applyInPandas(joined, kinds).select("chunk", "twice").toLocalIterator():
        out[r["chunk"] * chunk : (r["chunk"] + 1) * chunk] = np.frombuffer(unpack(r["twice"]), np.uint64)
    return source.sparkSession.sparkContext.broadcast(out)


def _read(source: DataFrame, copies: Copies | None) -> DataFrame:
    return _with_spots(source, "id", "text") if copies else source.select("id", "text")


def _windows(source: DataFrame, length: int, shingle: int, hashes: int, bands: int, common: Broadcast | None = None, copies: Copies | None = None) -> DataFrame:
    """(key, id, first, last) for each window of rows (id, text) under each set of hash functions.

    `first` and `last` are the places of the key's tokens, the outermost ones.
    `common` is a filter over the keys; it may let others pass.  Rows that `copies` tells are left out.
    """

    def run(batches):
        for ids, keys, *places in _text_windows(_texts(batches, copies), length, shingle, hashes, bands):
            yield _window_rows(ids, keys, *places, common)
        give_back()

    return _read(source, copies).mapInArrow(run, _WINDOW)


_WINDOW = "key long, id long, first int, last int"


def _window_rows(ids, keys, first, last, common: Broadcast | None = None) -> pa.RecordBatch:
    columns = [keys.view(np.int64), ids, first.astype(np.int32), last.astype(np.int32)]
    if common is not None:
        keep = np.ones(len(keys), bool)
        for at in _at(keys, len(common.value) << 6):
            keep &= (common.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        columns = [c[keep] for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "id", "first", "last"])


_PLACES = "key long, n long, id long, tokens binary, open binary"


def _places(texts: DataFrame, places: DataFrame, passages: DataFrame | None, length: int, shingle: int) -> DataFrame:
    """The tokens of all passages that hold a key's tokens, for each of `places` (key, id, n, first, last, failed), and which of them are open.

    Those outside of all `passages` (id, tid, passages) are; without passages, all of a place that failed and no others.
    """
    width, by_passages = length - shingle + 1, passages is not None

    def run(batches):
        unpack, tokens_of = zstandard.ZstdDecompressor().decompress, Tokens(shingle)
        for batch in batches:
            for key, raw, found, covered in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                tokens = tokens_of(unpack(raw)).astype(np.uint32)
                is_open = np.full(len(tokens), by_passages)
                for a, b in covered or ():
                    is_open[a : b - shingle + 1] = False
                near = [slice(max(0, x["last"] - width + 1), x["first"] + width) for x in found]
                tells = [np.ones(len(tokens[x]), bool) if p["failed"] else is_open[x] for p, x in zip(found, near, strict=True)]
                columns = [[x["key"] for x in found], [x["n"] for x in found], [key] * len(found)]
                columns = [pa.array(x, pa.int64()) for x in columns] + [pa.array([x.tobytes() for x in y], pa.binary()) for y in ([tokens[x] for x in near], tells)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n", "id", "tokens", "open"])
        give_back()

    grouped = places.groupBy("id").agg(F.collect_set(F.struct("key", "n", "first", "last", "failed")).alias("places"))
    held = texts.join(grouped, "id")
    if by_passages:
        covered = passages.groupBy("id", "tid").agg(F.flatten(F.collect_list("passages")).alias("covered"))
        held = held.join(covered, ["id", "tid"], "left")
    else:
        held = held.withColumn("covered", F.lit(None).cast("array<array<int>>"))
    return held.select("id", "text", "places", "covered").mapInArrow(run, _PLACES)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token, open) of all tokens of rows with columns `tokens` and `open`."""
    tokens, tells = ([np.frombuffer(x, t) for x in table[c].to_pylist()] for c, t in (("tokens", np.uint32), ("open", bool)))
    return np.repeat(np.arange(len(tokens)), [len(x) for x in tokens]), np.concatenate(tokens), np.concatenate(tells)


def _first_holders(places: DataFrame) -> DataFrame:
    """(key, id, other): for each open token of a document at a key the first document that has it there too.

    Tokens of a key with more than `PLACES` documents are dealt over several groups.
    """

    def split(batches):
        for batch in batches:
            row, token, is_open = _unpacked(pa.Table.from_batches([batch]))
            n = np.maximum(1, -(-batch.column(1).to_numpy() // PLACES))[row]
            order = np.lexsort((token % n, row))
            row, token, is_open, part = row[order], token[order], is_open[order], (token % n)[order]
            cuts = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])))) if len(row) else np.empty(0, np.int64)
            ends = np.append(cuts[1:], len(row))
            parts = [[x[a:b].tobytes() for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)] for x in (token, is_open)]
            at = pa.array(row[cuts])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(part[cuts].astype(np.int64)), batch.column(2).take(at), *(pa.array(x, pa.binary()) for x in parts)], ["key", "part", "id", "tokens", "open"])

    def run(table):
        row, token, is_open = _unpacked(table)
        ids = table["id"].to_numpy()[row]
        order = np.lexsort((ids, token))
        token, ids, is_open = token[order], ids[order], is_open[order]
        new = np.concatenate(([True], token[1:] != token[:-1]))[: len(token)]
        first = ids[new][np.cumsum(new) - 1]
        pairs = np.unique(np.stack((ids, first))[:, is_open & (ids > first)], axis=1)
        return pa.table([pa.array(x, pa.int64()) for x in (np.full(len(pairs[0]), table["key"][0].as_py()), *pairs)], ["key", "id", "other"])

    parts = places.mapInArrow(split, "key long, part long, id long, tokens binary, open binary")
    return parts.groupBy("key", "part").applyInArrow(run, "key long, id long, other long")


def alike(ids: np.ndarray, row: np.ndarray, token: np.ndarray, is_open: np.ndarray, mine: np.ndarray, least: float) -> np.ndarray:
    """Pairs (id, other) of a row among `mine` and one of another id not among them, where one has `least` tokens or more that the other has too.

    An open token of the first must be among those.
    """
    left = 0
    while left != len(row):  # a token counts only where two ids have it, and a row only if it has enough of those, open ones among them
        left = len(row)
        held = np.unique(np.stack((token, ids[row])), axis=1)[0]
        shared = np.isin(token, held[1:][held[1:] == held[:-1]]) & np.isin(token, token[mine[row]])
        enough = np.bincount(row[shared], minlength=len(ids)) >= least
        enough &= ~mine | (np.bincount(row[shared & is_open], minlength=len(ids)) > 0)
        keep = shared & enough[row]
        row, token, is_open = row[keep], token[keep], is_open[keep]
    live, at = np.unique(row, return_inverse=True)
    here, there = np.flatnonzero(mine[live]), np.flatnonzero(~mine[live])
    order = np.argsort(token, kind="stable")
    at, is_open, token = at[order], is_open[order], np.unique(token, return_inverse=True)[1][order]
    most = np.zeros((3, len(here), len(there)), np.float32)
    for k in range(0, int(token[-1]) + 1 if len(token) else 0, KINDS):
        some = slice(*np.searchsorted(token, (k, k + KINDS)))
        counts, opened = np.zeros((2, len(live), int(token[some][-1]) - k + 1), np.float32)
        np.add.at(counts, (at[some], token[some] - k), 1)
        np.add.at(opened, (at[some], token[some] - k), is_open[some])
        a, b = counts[here], counts[there]
        has = (b > 0).T.astype(np.float32)
        most += a @ has, (a > 0).astype(np.float32) @ b.T, opened[here] @ has
    x, y = np.nonzero((most[:2].max(axis=0) >= least) & (most[2] > 0))
    pairs = np.stack((ids[live[here[x]]], ids[live[there[y]]]))
    return np.unique(pairs[:, pairs[0] != pairs[1]], axis=1).T


def _alike(places: DataFrame, width: int, similarity: float) -> DataFrame:
    """Pairs (id, other) of documents whose places of a key are alike, the first with an open token that the other has too.

    `PLACES` places of a key stand against as many at once; a key of more is dealt over pairs of blocks.
    """
    least = ALIKE * similarity * width

    def run(table):
        row, token, is_open = _unpacked(table)
        pairs = alike(table["id"].to_numpy(), row, token, is_open, table["mine"].to_numpy(), least)
        return pa.table({"id": pa.array(pairs[:, 0], pa.int64()), "other": pa.array(pairs[:, 1], pa.int64())})

    blocks = F.ceil(F.col("n") / PLACES).cast("int")
    own, every = F.pmod(F.xxhash64("id"), blocks).cast("int"), F.sequence(F.lit(0), blocks - 1)
    cell = lambda x, y, mine: F.struct(x.alias("x"), y.alias("y"), F.lit(mine).alias("mine"))
    of_others, of_own = F.transform(every, lambda x: cell(x, own, False)), F.transform(every, lambda y: cell(own, y, True))
    some_open = F.instr(F.hex("open"), "1") > 0
    cells = F.when(some_open, F.concat(of_others, of_own)).otherwise(of_others)
    dealt = places.select("key", "id", "tokens", "open", F.inline(cells))
    return dealt.groupBy("key", "x", "y").applyInArrow(run, "id long, other long")


def duplicate_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    folder: str | None = None,
) -> DataFrame:
    """Verified pairs (doc_id, tid, leader, passages): word ranges of a document that also stand in an earlier one.

    `passages` are sorted [first, behind last] ranges over the words of the text with A-Z
    lower-cased; `leader` is a document with a smaller id.  Ids must be whole numbers.
    Rows without id or text take no part; rows with a repeated id are one document, and `tid`,
    the hash of a row's text, tells which of its texts holds the passages.  Passages that repeat within one
    document alone are not reported.  Other columns are ignored.
    """
    folder = folder or scratch_path(docs.sparkSession, "substrings")
    arrow_limits(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("id"), _text_id(text).alias("tid"), as_bytes(text)).filter("id is not null and text is not null")
    copies, told = _copies(source, folder)
    found, width = None, length - shingle + 1

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        """All verified pairs, with those of `pairs` that are new."""
        pairs = pairs.filter("id <> leader").distinct()
        if found is not None:
            pairs = pairs.join(found.select("id", "leader").distinct(), ["id", "leader"], "left_anti")
        pairs = write_stage(pairs, f"pairs-{name}", folder)
        checked = write_stage(_verify(pairs, source, length, shingle, similarity), f"checked-{name}", folder)
        return checked if found is None else found.unionByName(checked)

    def counted(rows: DataFrame) -> DataFrame:
        """(key, id, n): the documents of each key and their number."""
        rows = rows.select("key", "id").distinct()
        return rows.join(rows.groupBy("key").agg(F.count("*").alias("n")), "key")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("id", "other").alias("id"), F.least("id", "other").alias("leader"))

    def with_copies(rows: DataFrame) -> DataFrame:
        """Rows with those of each document again for its copies, which the first round leaves out until a key fails."""
        same = copies.select(F.col("id").alias("copy"), F.col("leader").alias("id")).distinct()
        again = rows.join(same, "id").drop("id").withColumnRenamed("copy", "id")
        return rows.unionByName(again).distinct()

    common = common_keys(source, length, shingle, HASHES, BANDS, told)
    windows = write_stage(_windows(source, length, shingle, HASHES, BANDS, common, told), "windows", folder)
    common.destroy()
    lead = windows.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("also")).filter("leader <> also").select("key", "leader")
    rows = write_stage(windows.join(lead, "key"), "rows", folder)
    discard(docs.sparkSession, f"{folder}/windows")
    found = verify(rows.select("id", "leader"), "leaders")
    passed = found.filter(F.size("passages") > 0)
    around = F.coalesce(F.exists("passages", lambda x: (x[0] <= F.col("first")) & (x[1] >= F.col("last") + shingle)), F.lit(False))
    failed = rows.filter("id <> leader").join(passed, ["id", "leader"], "left").filter(~around).select("key", "id").distinct()
    failed = write_stage(with_copies(failed) if told else failed, "failed", folder)
    # All of a key stand for the copies only where one fails; others are there for words that the leader lacks.
    failed_rows = rows.join(failed.select("key").distinct(), "key", "left_semi")
    failed_rows = write_stage(with_copies(failed_rows) if told else failed_rows, "failed-rows", folder)
    members = write_stage(counted(failed_rows), "members", folder)
    every = write_stage(counted(rows).filter("n > 2"), "every", folder)
    few = members.filter(F.col("n") <= FEW).select("key", F.col("id").alias("other")).join(failed, "key").select("id", "other")
    some = every.filter(F.col("n") <= FEW).select("key", "id")
    few = few.unionByName(some.join(some.withColumnRenamed("id", "other"), "key").filter("id > other").select("id", "other"))
    many, all_many = members.filter(F.col("n") > FEW), every.filter(F.col("n") > FEW)
    texts = packed_texts(source.select("id", "tid", "text"), "id", key_filter(many.select("id").union(all_many.select("id")).distinct()))
    texts = write_stage(texts, "texts-of-many", folder)
    tells = failed.withColumn("failed", F.lit(True))
    at = failed_rows.join(many, ["key", "id"]).join(tells, ["key", "id"], "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
    near = write_stage(_places(texts, at, None, length, shingle), "places", folder)
    found = verify(ordered(few.unionByName(_alike(near, width, similarity))), "others")
    at = rows.join(all_many, ["key", "id"]).withColumn("failed", F.lit(False))
    held = write_stage(_first_holders(_places(texts, at, found, length, shingle)), "holders", folder)
    if not held.isEmpty():
        found = verify(ordered(held), "holders")
        at = at.join(held.select("key").distinct(), "key", "left_semi")  # at other keys no open token is shared
        near = write_stage(_places(texts, at, found, length, shingle), "places-left", folder)
        found = verify(ordered(_alike(near, width, similarity).filter("id > other")), "left")
    good = found.filter(F.size("passages") > 0).select("id", "tid", "leader", "passages")
    if told:
        whole = F.array(F.array(F.lit(0), F.col("n_words").cast("int")))
        alike = copies.filter(F.col("n_words") >= length).select("id", "tid", "leader", whole.alias("passages"))
        also = copies.select(F.col("id").alias("copy"), "tid", F.col("leader").alias("id")).join(good, ["id", "tid"])
        more = alike.unionByName(also.select(F.col("copy").alias("id"), "tid", "leader", "passages"))
        good = good.unionByName(more.join(good, ["id", "tid", "leader"], "left_anti"))
    return good.withColumnRenamed("id", "doc_id")


def _text_id(text: str) -> F.Column:
    return F.xxhash64(F.col(f"`{text}`").cast("string"))


def _verify(pairs: DataFrame, source: DataFrame, length: int, shingle: int, similarity: float) -> DataFrame:
    """Add to pairs of documents the passages of the first that stand in the second, over the whole of both texts."""
    others = packed_texts(source.select(F.col("id").alias("leader"), F.col("text").alias("other")), "leader", key_filter(pairs.select("leader").distinct()))
    texts = packed_texts(source.select("id", "tid", F.col("text").alias("mine")), "id", key_filter(pairs.select("id").distinct()))

    def run(batches):
        unpack, tokens_of = zstandard.ZstdDecompressor().decompress, Tokens(shingle)

        @lru_cache(maxsize=64)
        def tokens(packed):
            """A text's distinct tokens in order, and the rank of each token among them."""
            return np.unique(tokens_of(unpack(packed)), return_inverse=True)

        for batch in batches:
            out = []
            for mine, other in zip(*(batch.column(k).to_pylist() for k in (3, 4)), strict=True):
                (kinds, nth), (others, _) = tokens(mine), tokens(other)
                out.append(_runs(_within(kinds, others)[nth], length, shingle, similarity))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.list_(pa.int32())))], ["id", "tid", "leader", "passages"])
        tokens.cache_clear()
        give_back()

    sides = pairs.join(others, "leader").join(texts, "id").select("id", "tid", "leader", "mine", "other")
    checked = sides.mapInArrow(run, "id long, tid long, leader long, passages array<array<int>>")
    # Texts of a repeated leader count together.
    return checked.groupBy("id", "tid", "leader").agg(F.array_distinct(F.flatten(F.collect_set("passages"))).alias("passages"))


def _merged(ranges) -> F.Column:
    """Sorted, disjoint ranges that cover an array of ranges."""
    return F.aggregate(
        F.array_sort(ranges),
        F.array().cast("array<array<int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))[1] >= x[0]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.array(F.try_element_at(acc, F.lit(-1))[0], F.greatest(F.try_element_at(acc, F.lit(-1))[1], x[1])))),
        ).otherwise(F.concat(acc, F.array(x))),
    )


def repeated_spans(pairs: DataFrame) -> DataFrame:
    """Per text with a passage of an earlier document: doc_id, tid, leaders (sorted), spans (merged ranges)."""
    grouped = pairs.groupBy("doc_id", "tid").agg(F.sort_array(F.collect_set("leader")).alias("leaders"), F.flatten(F.collect_list("passages")).alias("spans"))
    return grouped.select("doc_id", "tid", "leaders", _merged(F.col("spans")).alias("spans"))


def passage_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Per row of `docs`: doc_id, n_repeated (words), spans, leaders, n_links, component_id.

    `spans` are word ranges that repeat a passage of an earlier document, `leaders` those
    documents, `n_links` counts a document's links either way, and `component_id` is the
    smallest id that links of shared passages reach.  Documents without one have no
    spans, no links and their own id.
    """
    folder = scratch_path(docs.sparkSession, "substrings")
    pairs = write_stage(duplicate_passages(docs, doc_id, text, length, shingle, similarity, folder), "pairs", folder)
    spans = repeated_spans(pairs)
    whole = components(pairs.select(F.col("doc_id").alias("a"), F.col("leader").alias("b")), f"{folder}/components")
    ends = pairs.select("doc_id", "leader").distinct()
    links = ends.select("doc_id").union(ends.select("leader")).groupBy("doc_id").agg(F.count("*").alias("n_links"))
    marks = whole.withColumnRenamed("node", "_id").join(links.withColumnRenamed("doc_id", "_id"), "_id")
    spans = spans.withColumnsRenamed({"doc_id": "_span_id", "tid": "_tid"})
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _text_id(text).alias("_text")).join(marks, F.col("doc_id") == F.col("_id"), "left")
    out = out.join(spans, (F.col("doc_id") == F.col("_span_id")) & (F.col("_text") == F.col("_tid")), "left")
    no_spans = F.array().cast("array<array<int>>")
    spans_or_none = F.coalesce("spans", no_spans)
    return out.select(
        "doc_id",
        F.aggregate(spans_or_none, F.lit(0).cast("long"), lambda n, x: n + x[1] - x[0]).alias("n_repeated"),
        spans_or_none.alias("spans"),
        F.coalesce("leaders", F.array().cast("array<long>")).alias("leaders"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def cut_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, shingle: int = SHINGLE, similarity: float = SIMILARITY, n_chars: str | None = None) -> DataFrame:
    """`docs` with all their columns, with passages that repeat an earlier document's cut out of `text`.

    The earliest document keeps its copy.  Cut places become one blank line; texts without
    such a passage stay as they are.  Documents of which nothing is left are dropped.
    `n_chars` names a column to hold the new text's length in code points.
    """
    pairs = duplicate_passages(docs, doc_id, text, length, shingle, similarity)
    spans = repeated_spans(pairs).select(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid"), F.col("spans").alias("_spans"))
    marked = docs.join(spans, (F.col(doc_id).cast("long") == F.col("_id")) & (_text_id(text) == F.col("_tid")), "left").drop("_id", "_tid")
    place, names = docs.columns.index(text), docs.columns
    arrow_limits(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            all_spans = batch.column(len(names)).to_pylist()
            keep = np.ones(len(texts), bool)
            if any(all_spans):
                sizes = batch.column(names.index(n_chars)).to_pylist() if n_chars else None
                for k, s in enumerate(all_spans):
                    if s and texts[k] is not None:
                        texts[k] = cut_words(texts[k], s)
                        keep[k] = bool(texts[k].strip())
                        if sizes:
                            sizes[k] = len(texts[k])
                columns = [batch.column(k) for k in range(len(names))]
                columns[place] = pa.array(texts, columns[place].type)
                if n_chars:
                    columns[names.index(n_chars)] = pa.array(sizes, columns[names.index(n_chars)].type)
                batch = pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))
            else:
                batch = batch.select(names)
            yield batch
        give_back()

    return marked.mapInArrow(run, docs.schema)


def cut_words(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the ranges and what stands between them."""
    raw = text.encode()
    edges = _word_edges(np.frombuffer(raw.translate(WORDS), np.uint8)).reshape(-1, 2)
    out, at = [], 0
    for first, stop in spans:
        out.append(raw[at : edges[first][0]].rstrip())
        at = int(edges[stop - 1][1])
        while at < len(raw) and raw[at : at + 1] in b".,;:!?\")'":
            at += 1
    out.append(raw[at:].lstrip())
    return b"\n\n".join(x for x in out if x).decode()
