"""Hierarchical multi-length packing of token sequences.

Documents are routed to tiers of window lengths.  Whole windows of the longest tier are
cut off first; the rest of a document goes to the shortest tier that holds it.  Tiers
are packed from the longest to the shortest: each document opens a window, and the gap
behind it is filled with whole rests of shorter tiers, the longest that fit, then with
the head of one more.  What is left at the very end is cut into windows of powers of
two, so that nothing is padded.  Windows are then dealt to step groups of equal token
counts, so that the groups of a tier cost about the same attention.

The work is done where the rows are read, shelf by shelf; a shelf is a bounded run of a
partition's documents.  No shuffle, no hot group, and a repeated task gives the same
sequences again.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.texts import arrow_limits

TIERS = (256, 512, 1024, 2048)
END = 1  # the id behind every document
SHELF_TOKENS = 2_000_000
STEP_TOKENS = 65_536  # tokens of a step group, whatever its tier


class Tokens:
    """Ids of a byte-level BPE: the `tokenizers` file, run through its vocabulary as tiktoken ranks.

    Both give the same ids; tiktoken takes a fifth of the time.  A text that spells a
    special token goes to `tokenizers`, which gives it the special id.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.exact = json_path, None
        known = Tokenizer.from_file(json_path)
        self.special = [x.content for x in known.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> np.ndarray:
        if any(x in text for x in self.special):
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_file(self.json_path)
            found = self.exact.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        return np.array([*found, END], "<u4")


class Shelf:
    """Packs the documents of one shelf; `windows` is a list of (tier, pieces), a piece being (document, start, length)."""

    def __init__(self, lengths: list[int], tiers: tuple[int, ...] = TIERS):
        self.tiers, self.windows = tiers, []
        # Per tier, rests as (length, document, start) in order of length.
        self.rests: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}
        longest = tiers[-1]
        for doc, n in enumerate(lengths):
            whole = n // longest * longest
            for start in range(0, whole, longest):
                self.windows.append((longest, [(doc, start, longest)]))
            if n > whole:
                self.rests[self._tier(n - whole)].append((n - whole, doc, whole))
        for rests in self.rests.values():
            rests.sort()
        for tier in reversed(tiers):
            self._pack(tier)

    def _tier(self, n: int) -> int:
        return next(t for t in self.tiers if n <= t)

    def _take(self, gap: int, below: int) -> tuple[int, int, int] | None:
        """The longest rest of a tier up to `below` that fits the gap."""
        for tier in reversed(self.tiers):
            if tier <= below and (rests := self.rests[tier]):
                at = bisect_right(rests, (gap, 1 << 62, 0))
                if at:
                    return rests.pop(at - 1)
        return None

    def _cut(self, gap: int, below: int) -> tuple[int, int, int] | None:
        """The head of the shortest rest longer than the gap; what remains of it is routed anew."""
        for tier in self.tiers:
            if tier <= below and self.rests[tier]:
                n, doc, start = self.rests[tier].pop(0)
                insort(self.rests[self._tier(n - gap)], (n - gap, doc, start + gap))
                return gap, doc, start
        return None

    def _pack(self, tier: int) -> None:
        rests = self.rests[tier]
        while rests:
            n, doc, start = rests.pop()
            pieces, gap = [(doc, start, n)], tier - n
            while gap:
                # Once the shorter tiers are empty, the tier fills its own gaps.
                piece = self._take(gap, tier) or self._cut(gap, tier)
                if piece is None:
                    break
                pieces.append((piece[1], piece[2], piece[0]))
                gap -= piece[0]
            if gap:
                self._close(pieces, tier - gap)
            else:
                self.windows.append((tier, pieces))

    def _close(self, pieces: list[tuple[int, int, int]], total: int) -> None:
        """Cut the shelf's last, unfilled window into windows of powers of two."""
        pieces = pieces[::-1]
        for bit in range(total.bit_length() - 1, -1, -1):
            room = total & 1 << bit
            if not room:
                continue
            window, held = [], 0
            while held < room:
                doc, start, n = pieces.pop()
                part = min(n, room - held)
                window.append((doc, start, part))
                held += part
                if part < n:
                    pieces.append((doc, start + part, n - part))
            self.windows.append((room, window))

    def steps(self, step_tokens: int = STEP_TOKENS) -> list[int]:
        """A step group for each window: one tier per group, dealt by attention cost in a snake."""
        group, out = 0, [0] * len(self.windows)
        by_tier = defaultdict(list)
        for k, (tier, pieces) in enumerate(self.windows):
            by_tier[tier].append((-sum(n * n for _, _, n in pieces), k))
        for tier in sorted(by_tier, reverse=True):
            costs = sorted(by_tier[tier])
            groups = max(1, -(-len(costs) * tier // step_tokens))
            for rank, (_, k) in enumerate(costs):
                turn, at = divmod(rank, groups)
                out[k] = group + (at if turn % 2 == 0 else groups - 1 - at)
            group += groups
        return out


PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, sequence_length long, step_group long"
)


def pack(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    shelf_tokens: int = SHELF_TOKENS,
    step_tokens: int = STEP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, sequence_length, step_group.

    `json_path` and `ranks_path` name one vocabulary for `tokenizers` and tiktoken and
    must exist on every machine.  Null texts count as empty and give the closing id
    alone.  Each row of `docs` is packed by itself, so null and repeated ids are kept.
    A shelf holds about `shelf_tokens` tokens and at least one document, however long.
    `tier` is the window length a sequence was packed for and `sequence_length` its
    tokens, which only at the end of a shelf is a smaller power of two.  `with_ids` adds
    the ids of each piece as an array.  Other columns are ignored.
    """
    schema = f"doc_id long, {PIECES}" + ", ids array<long>" * with_ids
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    arrow_limits(docs.sparkSession)

    def run(batches):
        tokens = Tokens(json_path, ranks_path, pattern)
        part = TaskContext.get().partitionId()
        ids, held, size, shelf = [], [], 0, 0

        def empty():
            nonlocal ids, held, size, shelf
            packed = Shelf([len(x) for x in held])
            columns = defaultdict(list)
            for k, ((tier, pieces), step) in enumerate(zip(packed.windows, packed.steps(step_tokens), strict=True)):
                offset = 0
                for doc, start, n in pieces:
                    piece = held[doc][start : start + n]
                    row = (ids[doc], start, n, zlib.crc32(piece.tobytes()), len(held[doc]), (part << 40) + (shelf << 20) + k, offset, tier)
                    for name, x in zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier"), row, strict=True):
                        columns[name].append(x)
                    columns["sequence_length"].append(sum(p[2] for p in pieces))
                    columns["step_group"].append((part << 40) + (shelf << 20) + step)
                    if with_ids:
                        columns["ids"].append(piece.astype(np.int64))
                    offset += n
            ids, held, size, shelf = [], [], 0, shelf + 1
            names = ["doc_id", *(x.split()[0] for x in PIECES.split(", "))]
            arrays = [pa.array(columns[n], pa.int64()) for n in names]
            if with_ids:
                arrays.append(pa.array(columns["ids"], pa.list_(pa.int64())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for key, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(key)
                held.append(tokens.ids(x))
                size += len(held[-1])
                if size >= shelf_tokens:
                    yield empty()
        if held:
            yield empty()

    return source.mapInArrow(run, schema)
