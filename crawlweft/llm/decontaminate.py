"""Benchmark decontamination: Wu-Manber search for all word windows of the test items.

Texts are brought to one form (A-Z lower-cased, words set apart by one blank), so that
a window of words is a byte string with a blank at either end.  All windows of an item
set are searched at once: a shift table over blocks of bytes says how far the search
may jump, a jump of none looks the block up among the windows' suffix hashes, and the
bytes of the text and the window are then compared.  The texts of a batch are cut into
equal lanes that jump in step, so each step is a few vector operations.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.texts import arrow_limits, as_bytes, give_back, map_rows, words

WINDOW = 10
#: Bytes of item text that one search holds; more items are searched in further blocks of this size.
BLOCK_BYTES = 4_000_000
#: Patterns shorter than these are searched apart, as the shortest pattern bounds every jump.
LENGTH_CLASSES = (1, 4, 12, 32)
_TABLE_BITS = 18
_LANE = 4096


class WuManber:
    """All occurrences of byte strings, by their shift tables.

    `patterns` are distinct and share a length class; `search` gives arrays of
    (position in the text, pattern number).
    """

    def __init__(self, patterns: list[bytes]):
        self.length = m = min(map(len, patterns))  # what the tables look at: the last m bytes before a window's end
        self.block = b = min(4, m)
        self.longest = max(map(len, patterns))
        self.size = np.array([len(p) for p in patterns])
        self.data = np.frombuffer(b"".join(patterns) + b"\0" * 8, np.uint8)
        self.start = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        heads = np.stack([np.frombuffer(p[:m], np.uint8) for p in patterns])
        self.shift = np.full(1 << _TABLE_BITS, m - b + 1, np.int32)
        for end in range(b, m + 1):  # later blocks lie nearer to the end and so allow smaller jumps
            self.shift[self._code(heads[:, end - b : end])] = m - end
        suffix = self._code(heads[:, m - b : m])
        self.bucket = np.argsort(suffix, kind="stable")
        self.first = np.searchsorted(suffix[self.bucket], np.arange((1 << _TABLE_BITS) + 1))
        self.prefix = self._sum(heads)

    @staticmethod
    def _code(blocks: np.ndarray) -> np.ndarray:
        """Table place of blocks (rows of b bytes)."""
        out = np.zeros(len(blocks), np.uint32)
        for column in blocks.T:
            out = out * np.uint32(0x01000193) ^ column
        return ((out * np.uint32(0x9E3779B1)) >> np.uint32(32 - _TABLE_BITS)).astype(np.int64)

    @staticmethod
    def _sum(heads: np.ndarray) -> np.ndarray:
        """A 64-bit value of the first bytes, compared before whole patterns are."""
        out = np.zeros(len(heads), np.uint64)
        for column in heads[:, :8].T:
            out = out << np.uint64(8) | column
        return out

    def _at(self, text: np.ndarray, places: np.ndarray, count: int) -> np.ndarray:
        return text[places[:, None] + np.arange(count)]

    def search(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions and pattern numbers of every occurrence."""
        m, b = self.length, self.block
        if len(raw) < m:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        text = np.frombuffer(raw, np.uint8)
        # Lane i looks at ends of windows in (i * lane + m - 1, (i + 1) * lane + m - 1].
        place = np.arange(0, len(text) - m + 1, _LANE, dtype=np.int64)
        stop = np.minimum(place + _LANE, len(text) - m + 1)
        found = []
        while len(place):
            jump = self.shift[self._code(self._at(text, place + (m - b), b))]
            hit = jump == 0
            if hit.any():
                found.append(place[hit])
            place = place + np.maximum(jump, 1)
            live = place < stop
            if not live.all():
                place, stop = place[live], stop[live]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return self._confirm(text, np.concatenate(found))

    def _confirm(self, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compare the patterns of each place's suffix bucket, one bucket entry of all places at a time."""
        m, b = self.length, self.block
        code = self._code(self._at(text, place + (m - b), b))
        head = self._sum(self._at(text, place, min(m, 8)))
        low, high = self.first[code], self.first[code + 1]
        places, numbers = [], []
        while len(place):
            some = low < high
            place, low, high, head = place[some], low[some], high[some], head[some]
            number = self.bucket[low]
            fits = (self.prefix[number] == head) & (place + self.size[number] <= len(text))
            at, which = place[fits], number[fits]
            for size in np.unique(self.size[which]):
                same = self.size[which] == size
                a, w = at[same], which[same]
                equal = (self._at(text, a, size) == self._at(self.data, self.start[w], size)).all(axis=1)
                places.append(a[equal])
                numbers.append(w[equal])
            low = low + 1
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(places), np.concatenate(numbers)


class Patterns:
    """The windows of a block of items, ready to search."""

    def __init__(self, items: list[tuple[object, bytes | None]], window: int = WINDOW):
        self.items = sorted({str(i) for i, _ in items if i is not None})
        number = {x: n for n, x in enumerate(self.items)}
        of: dict[bytes, set[int]] = defaultdict(set)
        for item, raw in items:
            ws = words(raw)
            for k in range(max(1, len(ws) - window + 1) if ws and item is not None else 0):
                of[b" " + b" ".join(ws[k : k + window]) + b" "].add(number[str(item)])
        self.owners, self.searches = [], []
        for low, high in zip(LENGTH_CLASSES, (*LENGTH_CLASSES[1:], 1 << 62), strict=True):
            chosen = sorted(p for p in of if low <= len(p) - 2 < high)
            if chosen:
                self.searches.append((WuManber(chosen), len(self.owners), np.array([p.count(b" ") - 1 for p in chosen])))
                self.owners += [sorted(of[p]) for p in chosen]

    def hits(self, forms: list[bytes]) -> Iterator[tuple[int, np.ndarray, set[int]]]:
        """For each text form with an occurrence: its number, the mask of its words that are hit, item numbers."""
        joined = b"".join(forms)
        if not joined:
            return
        begin = np.concatenate(([0], np.cumsum([len(x) for x in forms])))
        at, span, which = [], [], []
        for search, base, lengths in self.searches:
            place, number = search.search(joined)
            at.append(place)
            span.append(lengths[number])
            which.append(number + base)
        at, span, which = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (at, span, which))
        if not len(at):
            return
        doc = np.searchsorted(begin, at, side="right") - 1
        order = np.argsort(doc, kind="stable")
        cuts = np.flatnonzero(np.diff(doc[order])) + 1
        for part in np.split(order, cuts):
            d = int(doc[part[0]])
            form = np.frombuffer(forms[d], np.uint8)
            blanks = np.cumsum(form == 32)  # one more than the number of the word that starts behind a blank
            first = blanks[at[part] - begin[d]] - 1
            edge = np.zeros(int(blanks[-1]), np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + span[part], -1)
            yield d, np.cumsum(edge)[:-1] > 0, {o for p in np.unique(which[part]) for o in self.owners[p]}


def _form(raw: bytes | None) -> tuple[bytes, int]:
    """A blank before, between and behind the words; empty without words.  Two texts' forms never join to a match."""
    ws = words(raw)
    return (b" " + b" ".join(ws) + b" " if ws else b""), len(ws)


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list]:
    """The items in blocks of at most `BLOCK_BYTES` bytes (or one item), fetched one partition at a time."""
    held, size = [], 0
    for row in items.select(F.col(item_id).cast("string").alias("i"), as_bytes(text, "t")).toLocalIterator():
        if held and size + len(row.t or b"") > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((row.i, bytes(row.t) if row.t is not None else None))
        size += len(row.t or b"")
    yield held


def search_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, item_ids, hit_spans, contaminated.

    A window is `window` consecutive words of an item, or the whole item when it has
    fewer (but not none).  `hit_spans` are [first, behind last] word ranges.  Items come
    to the driver in blocks of `BLOCK_BYTES`, each broadcast and searched in all
    documents in turn where they were read; nothing is shuffled.  Null and empty texts
    have no words.  Every row of `docs` gives one row, whatever its id.  Items without
    id are left out, as nothing could name them; equal item ids count as one item.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    found = docs.select(F.col(doc_id).alias("doc_id"), as_bytes(text))
    blocks = item_blocks(items)
    block, first = next(blocks), True
    while block is not None:
        after = next(blocks, None)
        held = spark.sparkContext.broadcast(Patterns(block, window))
        found = map_rows(
            found,
            lambda batch, held=held, first=first, last=after is None: _search_batch(batch, held.value, first, last),
            f"doc_id {kind}, n_words long, item_ids array<string>, hit_spans array<array<long>>" + ", text binary" * (after is not None),
        )
        block, first = after, False
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, x: n + x[1] - x[0])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "item_ids",
        "hit_spans",
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def _search_batch(batch: dict, patterns: Patterns, first: bool, last: bool) -> dict:
    """Add a block's finds to those of the blocks before it."""
    forms = [_form(x) for x in batch["text"].to_pylist()]
    n, low = len(forms), 0
    ids = [[] for _ in range(n)] if first else batch["item_ids"].to_pylist()
    spans = [[] for _ in range(n)] if first else batch["hit_spans"].to_pylist()
    while low < n:  # a few MB at a time
        high, size = low, 0
        while high < n and (high == low or size + len(forms[high][0]) <= 4_000_000):
            size += len(forms[high][0])
            high += 1
        for d, mask, owners in patterns.hits([f for f, _ in forms[low:high]]):
            for begin, end in spans[low + d]:
                mask[begin:end] = True
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
            spans[low + d] = edges.reshape(-1, 2).tolist()
            ids[low + d] = sorted({*ids[low + d], *(patterns.items[o] for o in owners)})
        low = high
    out = {"doc_id": batch["doc_id"], "n_words": [w for _, w in forms], "item_ids": ids, "hit_spans": spans}
    return out if last else out | {"text": batch["text"]}


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` with all their columns, without the documents in which a window of an item occurs.

    Rows are judged where they are read, so no shuffle and no key is needed; null ids
    and repeated rows are judged like others.  Each block of items filters what is left.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    kept = docs
    for block in item_blocks(items):
        held = spark.sparkContext.broadcast(Patterns(block, window))

        def keep(batches, held=held):
            for batch in batches:
                forms = [_form(x.encode() if x is not None else None)[0] for x in batch.column(text).to_pylist()]
                mask = np.ones(len(forms), bool)
                for d, _, _ in held.value.hits(forms):
                    mask[d] = False
                yield batch.filter(pa.array(mask))
            give_back()

        kept = kept.mapInArrow(keep, docs.schema)
    return kept
