"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles (tokens); two link when their Jaccard similarity
reaches the threshold.  The join finds all linked documents up to connection:

1. Equal sets form a class; everything below works on one row per class.
2. Classes with an equal pair of min-hashes are compared with the first of them; verified
   links form components.
3. Classes are partitioned into groups of similar ones: a large component is a group, other
   classes join those that share their most frequent pair of min-hashes.  Groups are kept
   in blocks of some `BLOCK` members or `BLOCK_TOKENS` tokens, dealt by hash.
4. The matrix stores each group's union of tokens.  A class and a group can only link if
   they share `OVERLAP` tokens of their prefixes: the rarest tokens of each set, as many as
   the threshold leaves room for (prefix filter).  So the matrix holds prefix tokens,
   and a token that lies in one group only is dropped at once.
5. The shared prefix tokens of two groups bound the overlap of their members; only groups
   that reach the bound are opened.  For groups of many blocks the bound is applied again
   to their blocks.  Two opened blocks go to one task, which counts the common tokens of
   all members at once and returns links as a forest, at most one a member.

Members of a component need no search, so a large group of linked copies costs one comparison
per member.  Members of a large group that look alike without linking are compared block by
block: what moves and what comes back is a row per pair of blocks, not per pair of
documents.  Rarity comes from a
count sketch of bounded size over all documents.  Any order of the tokens gives right
results as long as all documents use the same one; the sketch only keeps frequent
tokens out of the prefixes.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.components import components
from crawlweft.llm.fetch import FILTER_BITS, bit_table, key_filter, packed_texts
from crawlweft.llm.texts import Spans, arrow_limits, as_bytes, give_back, map_rows, spaced_words
from crawlweft.operators.staging import scratch_path, write_stage

WORDS = 5
THRESHOLD = (80, 100)  # as a fraction, so that it is compared without rounding
OVERLAP = 3
BLOCK = 256
BLOCK_TOKENS = 1 << 18
#: Bytes of packed blocks that one Arrow batch holds.
BATCH_BYTES = 32 << 20
CHUNK = 1 << 16
MOST_BUCKETS = 1 << 26
#: Odd factors that turn a token's hash into further hash functions; two make a group key.
_FACTORS = tuple(int(x) | 1 for x in np.random.default_rng(11).integers(1, 1 << 63, 8))


def _tokens(spans: Spans, raw: bytes | None, k: int, split) -> np.ndarray:
    return np.unique(spans.shingles(split(raw), k))


def _needed(n: int, threshold: tuple[int, int]) -> int:
    """The least overlap of a set of n tokens with any set that it links to."""
    return -(-threshold[0] * n // threshold[1])


class _Counts:
    """Exact counts of places: a byte each, and a list of what goes beyond it."""

    def __init__(self, n: int):
        self.low, self.high = np.zeros(n, np.uint8), []

    def add(self, places: np.ndarray) -> None:
        places, n = np.unique(places, return_counts=True)
        n += self.low[places]
        self.low[places] = n & 255
        beyond = n > 255
        if beyond.any():
            self.high.append((places[beyond].astype(np.int64), (n[beyond] >> 8 << 8).astype(np.uint64)))

    def chunk(self, at: int) -> np.ndarray:
        """The counts of `CHUNK` places."""
        out = self.low[at : at + CHUNK].astype(np.uint64)
        for places, n in self.high:
            here = slice(*np.searchsorted(places, (at, at + CHUNK)))
            out[places[here] - at] += n[here]
        return out


def rarity(docs: DataFrame, text: str, k: int, split=spaced_words) -> np.ndarray:
    """A class of frequency for each bucket of token hashes; 0 for the usual, one more per doubling.

    All tokens of all documents are counted.  There is a bucket for about eight tokens,
    up to `MOST_BUCKETS`, so the result has at most that many bytes.  Tasks count in an
    array of single bytes, with a list of what goes beyond them, and send it in compressed chunks, which are added in two steps; the first step has
    more groups where there are more tasks, so that neither step gathers many chunks.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(CHUNK, 1 << int(size // 56).bit_length()))
    mask = np.uint64(buckets - 1)
    salts = 4 + math.isqrt(size >> 27)

    def pack(counts):
        return zlib.compress(counts.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)  # small counts have seven empty bytes

    def unpack(data):
        return np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()

    def count(batches):
        spans, total = Spans(), _Counts(buckets)

        for batch in batches:
            held, size = [], 0
            for raw in batch.column(0).to_pylist():
                held.append(_tokens(spans, raw, k, split) & mask)
                size += len(held[-1])
                if size > 1 << 17:
                    total.add(np.concatenate(held))
                    held, size = [], 0
            if held:
                total.add(np.concatenate(held))
        salt = TaskContext.get().partitionId() % salts
        for at in range(0, buckets, CHUNK):
            counts = total.chunk(at)
            if counts.any():
                data = pack(counts)
                yield pa.RecordBatch.from_pydict({"chunk": [at // CHUNK], "salt": [salt], "data": [data]}, schema)
        give_back()

    schema = pa.schema([("chunk", pa.int32()), ("salt", pa.int32()), ("data", pa.binary())])

    def summed(rows):
        out = np.zeros(CHUNK, np.uint64)
        for data in rows["data"]:
            out += unpack(data)
        return out

    def add_up(rows):
        return rows[:1].assign(data=[pack(summed(rows))])

    def levels(rows):
        counts = summed(rows)
        return rows[["chunk"]][:1].assign(n=int(counts.sum()), data=[np.floor(np.log2(np.maximum(counts, 1))).astype(np.uint8).tobytes()])

    arrow_limits(docs.sparkSession)
    parts = docs.select(as_bytes(text)).mapInArrow(count, "chunk int, salt int, data binary")
    parts = parts.groupBy("chunk", "salt").applyInPandas(add_up, "chunk int, salt int, data binary")
    out, n = np.zeros(buckets, np.int16), 0
    for r in parts.groupBy("chunk").applyInPandas(levels, "chunk int, n long, data binary").toLocalIterator():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["data"], np.uint8)
        n += r["n"]
    usual = max(0, int(n // buckets).bit_length() - 1)
    return np.maximum(0, out - usual).astype(np.uint8)


def describe(docs: DataFrame, classes: np.ndarray, doc_id: str, text: str, k: int, threshold: tuple[int, int], split=spaced_words) -> DataFrame:
    """Per row: doc_id, tid (hash of the text), n, cls (its set), keys (for groups), prefix (rarest tokens first)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(classes)
    made: list[Spans] = []

    def one(raw):
        tokens = _tokens(made[0], raw, k, split)
        n = len(tokens)
        if not n:
            return 0, None, [], []
        least = [int((tokens * np.uint64(f)).min()) for f in _FACTORS]
        keys = [xxhash.xxh3_64_intdigest(f"{j}:{least[j]}:{least[j + 1]}") - (1 << 63) for j in range(0, len(least), 2)]
        order = tokens >> np.uint64(8) | held.value[tokens & np.uint64(len(held.value) - 1)].astype(np.uint64) << np.uint64(56)
        needed = _needed(n, threshold)
        size = min(n, n - needed + min(OVERLAP, needed))
        prefix = np.partition(order, size - 1)[:size] if size < n else order
        return n, xxhash.xxh3_128_digest(tokens.tobytes()), keys, prefix.view(np.int64)

    def rows(batch):
        if not made:
            made.append(Spans())
        found = zip(*(one(x) for x in batch["text"].to_pylist()), strict=True)
        return {"doc_id": batch["doc_id"], "tid": batch["tid"]} | dict(zip(("n", "cls", "keys", "prefix"), map(list, found), strict=True))

    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("tid"), as_bytes(text))
    return map_rows(source, rows, f"doc_id {kind}, tid long, n long, cls binary, keys array<long>, prefix array<long>")


def _sized(a: str, b: str, threshold: tuple[int, int]):
    """Whether sets of these sizes can reach the threshold."""
    low, high = F.least(a, b), F.greatest(a, b)
    return low * threshold[1] >= high * threshold[0]


def _fetch(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`wanted` (cls, rep and more) with the compressed text, `packed`, of each row that holds a class's first one."""
    source = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("tid"), as_bytes(text, "packed"))
    packed = packed_texts(source, "tid", key_filter(wanted.select("rep.tid")))
    return packed.join(wanted, F.col("id").eqNullSafe(F.col("rep.doc_id")) & (F.col("tid") == F.col("rep.tid")))


def common_tokens(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of `left` shares with each set of `right`, as a matrix."""
    if len(left) == len(right) == 1:
        return np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]])
    rows, tokens = (np.concatenate(x) for x in zip(*((np.full(len(t), k), t) for k, t in enumerate([*left, *right])), strict=True))
    _, column, times = np.unique(tokens, return_inverse=True, return_counts=True)
    column, rows = column[times[column] > 1], rows[times[column] > 1]
    order = np.argsort(column, kind="stable")
    column, rows = column[order], rows[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        here = slice(*np.searchsorted(column, (first, first + 4096)))
        if here.start < here.stop:
            _, at = np.unique(column[here], return_inverse=True)
            has = np.zeros((len(left) + len(right), int(at.max()) + 1), np.float32)
            has[rows[here], at] = 1
            out += np.rint(has[: len(left)] @ has[len(left) :].T).astype(np.int64)  # below 2**24, so exact
    return out


def forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Edges (root, node) that connect what a symmetric boolean matrix connects."""
    names = np.arange(len(adjacent))
    while True:
        near = np.minimum(names, np.where(adjacent, names, len(names)).min(axis=1, initial=len(names)))
        near = near[near]
        if (near == names).all():
            return [(int(r), k) for k, r in enumerate(names) if r != k]
        names = near


def open_blocks(pairs: DataFrame, members: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str, k: int, threshold: tuple[int, int], folder: str, split=spaced_words) -> DataFrame:
    """Links (a, b) of classes, as forests: one row per member and pair of blocks at most.

    `pairs` (a, b) are blocks to compare, `members` (cls, blk) what they hold; a pair of a
    block with itself compares its members with one another.
    """
    pairs = write_stage(pairs, "far-pairs", folder)
    opened = pairs.select(F.col("a").alias("blk")).union(pairs.select("b")).distinct()
    wanted = write_stage(members.join(opened, "blk").join(classes.select("cls", "rep"), "cls"), "far-wanted", folder)
    texts = _fetch(wanted, docs, doc_id, text).repartition("blk").groupBy("blk", "cls").agg(F.first("packed").alias("packed"))
    blocks = write_stage(texts.groupBy("blk").agg(F.collect_list(F.struct("cls", "packed")).alias("held")), "far-blocks", folder)

    def linked(batches):
        import zstandard

        unpack, spans, last = zstandard.ZstdDecompressor().decompress, Spans(), {}

        def tokens(blk, held):
            """Names and sets of a block; the last few blocks are kept."""
            if blk not in last:
                if len(last) > 7:
                    del last[next(iter(last))]
                rows = held.as_py()
                last[blk] = [r["cls"] for r in rows], [_tokens(spans, unpack(r["packed"]), k, split) for r in rows]
            return last[blk]

        for batch in batches:
            found = []
            for a, b, x, y in zip(*batch.columns, strict=True):
                a, b = a.as_py(), b.as_py()
                (x_names, x), (y_names, y) = tokens(a, x), tokens(b, y)
                both = common_tokens(x, y)
                sizes = np.array([len(t) for t in x])[:, None] + np.array([len(t) for t in y])
                link = threshold[1] * both >= threshold[0] * (sizes - both)
                if not link.any():
                    continue
                if a == b:
                    names, adjacent = x_names, link
                else:
                    names, n = x_names + y_names, len(x)
                    adjacent = np.zeros((len(names), len(names)), bool)
                    adjacent[:n, n:], adjacent[n:, :n] = link, link.T
                found += [(names[r], names[q]) for r, q in forest(adjacent)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found, strict=True)], ["a", "b"])

    sides = pairs.join(blocks.select(F.col("blk").alias("b"), F.col("held").alias("y")), "b").join(blocks.select(F.col("blk").alias("a"), F.col("held").alias("x")), "a")
    arrow_limits(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return write_stage(sides.select("a", "b", "x", "y").mapInArrow(linked, "a binary, b binary"), "far-links", folder)


def _only_shared(prefixes: DataFrame, shared: DataFrame) -> DataFrame:
    """(blk, token): the tokens of `prefixes` (blk, prefix) without most of those that are not in `shared`.

    Tokens are hashes, so two runs of their bits are their places in a bit table of fixed
    size.  The table may let a token pass that is not shared, so a join must follow.
    """
    mask = (1 << FILTER_BITS) - 1
    spots = F.array(F.col("token").bitwiseAND(mask), F.shiftrightunsigned("token", FILTER_BITS).bitwiseAND(mask))
    bits = bit_table(shared.select(F.explode(spots).alias("at")))

    def keep(batches):
        for batch in batches:
            lists = batch.column(1)
            tokens = lists.flatten().to_numpy()
            blks = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
            found = np.ones(len(tokens), bool)
            for at in (tokens & mask, tokens >> FILTER_BITS & mask):
                found &= (bits.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array(blks[found]), pa.array(tokens[found])], ["blk", "token"])

    arrow_limits(prefixes.sparkSession)
    return prefixes.mapInArrow(keep, "blk long, token long")


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str, k: int, threshold: tuple[int, int], folder: str, name: str, split=spaced_words) -> DataFrame:
    """Those pairs (a, b) of classes whose whole sets reach the threshold, as a stage."""
    pairs = write_stage(pairs, f"{name}-pairs", folder)
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct().join(classes.select("cls", "rep"), "cls")
    wanted = write_stage(wanted, f"{name}-wanted", folder)
    texts = write_stage(_fetch(wanted, docs, doc_id, text).select("cls", "packed").dropDuplicates(["cls"]), f"{name}-texts", folder)

    def linked(batches):
        import zstandard

        unpack, spans = zstandard.ZstdDecompressor().decompress, Spans()

        @lru_cache(maxsize=64)
        def tokens(packed):
            return _tokens(spans, unpack(packed), k, split)

        for batch in batches:
            out = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = tokens(x), tokens(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(threshold[1] * both >= threshold[0] * (len(x) + len(y) - both))
            batch = batch.filter(pa.array(out, pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])

    sides = pairs.join(texts.select(F.col("cls").alias("b"), F.col("packed").alias("y")), "b").join(texts.select(F.col("cls").alias("a"), F.col("packed").alias("x")), "a")
    arrow_limits(docs.sparkSession)
    return write_stage(sides.select("a", "b", "x", "y").mapInArrow(linked, "a binary, b binary"), f"{name}-links", folder)


def jaccard_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD,
    split=spaced_words,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    A text with fewer than `words` words is one shingle; null texts and texts without words have
    none, link to nothing and are their own component.  Equal texts always link.  Null ids
    take part but never name a component, unless all of its ids are null.  Rows with a
    repeated id are kept; they link by their texts alone.  Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "ngram-join")
    told = write_stage(describe(docs, rarity(docs, text, words, split), doc_id, text, words, threshold, split), "told", folder)
    classes = told.filter("cls is not null").groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("rep"),
        F.first("n").alias("n"),
        F.first("keys").alias("keys"),
    )
    classes = write_stage(classes, "classes", folder)

    # Groups: classes with an equal key are compared with the first of them.
    keyed = classes.select("cls", "n", F.explode("keys").alias("key"))
    first = keyed.groupBy("key").agg(F.min(F.struct("cls", "n")).alias("first"), F.max("cls").alias("last"), F.count("*").alias("times")).filter("first.cls <> last")
    keyed = write_stage(keyed.join(first.select("key", "first", "times"), "key"), "keyed", folder)
    near = keyed.filter((F.col("cls") != F.col("first.cls")) & _sized("n", "first.n", threshold))
    near = near.select(F.col("cls").alias("a"), F.col("first.cls").alias("b")).distinct()
    links = verify(near, classes, docs, doc_id, text, words, threshold, folder, "near", split)
    grouped = components(links, f"{folder}/groups")

    # Groups: large components, else the classes that share their most frequent key; then blocks of them.
    # Only narrow rows of classes that share a key take part; any other class is a group of its own.
    sizes = grouped.groupBy("component").agg(F.count("*").alias("size"))
    linked = grouped.join(sizes, "component").select(F.col("node").alias("cls"), F.xxhash64("component").alias("comp"), (F.col("size") >= BLOCK).alias("wide"))
    usual = keyed.groupBy("cls").agg(F.first("n").alias("n"), F.max(F.struct("times", "key")).alias("usual"))
    placed = usual.join(linked, "cls", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
    placed = placed.withColumn("of", F.when(F.col("wide"), F.col("comp")).otherwise(F.xxhash64("usual.key", F.lit(1))))
    placed = write_stage(placed.drop("usual"), "placed", folder)
    parts = placed.groupBy("of").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_TOKENS)).alias("parts"))
    blk = F.xxhash64("of", F.pmod(F.xxhash64("cls"), "parts"))
    placed = placed.join(parts, "of").withColumn("blk", blk).select("cls", "comp", "wide", "blk", F.when(F.col("wide"), F.col("of")).otherwise(F.col("blk")).alias("grp"))
    # A partner's set has at least threshold * n tokens, so this overlap of prefixes is sure.
    bound = F.greatest(F.lit(1), F.least(F.lit(OVERLAP), F.floor(F.col("n") * threshold[0] ** 2 / threshold[1] ** 2))).cast("int")
    alone = F.xxhash64("cls")
    info = classes.select("cls", "n", "rep").join(placed, "cls", "left")
    info = info.select("cls", "n", "rep", "comp", bound.alias("bound"), F.coalesce("wide", F.lit(False)).alias("wide"), F.coalesce("blk", alone).alias("blk"), F.coalesce("grp", alone).alias("grp"))
    info = write_stage(info, "info", folder)
    # The prefixes move once, spread by the document that stands for its class.
    reps = info.select(F.col("cls").alias("r_cls"), F.col("rep.doc_id").alias("r_id"), F.col("rep.tid").alias("r_tid"), "blk", "grp")
    prefixes = told.join(reps, (F.col("cls") == F.col("r_cls")) & F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("tid") == F.col("r_tid")))
    prefixes = write_stage(prefixes.select("grp", "blk", "prefix"), "prefixes", folder)

    # The token-group matrix, of prefix tokens that lie in several groups.  Only hashes go through its two large shuffles.
    shared = prefixes.select("grp", F.explode("prefix").alias("token")).groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low <> high").select("token")
    shared = write_stage(shared, "shared", folder)
    held = _only_shared(prefixes.select("blk", "prefix"), shared).join(shared, "token").distinct()
    blocks = info.groupBy("blk").agg(F.first("grp").alias("grp"), F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.min("bound").alias("bound"), F.first("wide").alias("wide"), F.count("*").alias("size"), ((F.count("comp") == F.count("*")) & (F.min("comp") == F.max("comp"))).alias("done"))
    blocks = write_stage(blocks, "blocks", folder)
    entries = write_stage(held.join(blocks.drop("size", "done"), "blk"), "entries", folder)
    matrix = entries.groupBy("token", "grp").agg(F.min("least_n").alias("least_n"), F.max("most_n").alias("most_n"), F.min("bound").alias("bound"), F.first("wide").alias("wide"))
    matrix = write_stage(matrix, "matrix", folder)

    def meet(x: DataFrame, y: DataFrame, on: list[str], names: tuple[str, str]) -> DataFrame:
        """Pairs of rows with enough tokens in common, whose sizes can reach the threshold."""
        y = y.select(*on, F.col(names[1]).alias("b"), F.col("least_n").alias("b_least"), F.col("most_n").alias("b_most"), F.col("bound").alias("b_bound"), F.col("wide").alias("b_wide"))
        fits = (F.col("most_n") * threshold[1] >= F.col("b_least") * threshold[0]) & (F.col("b_most") * threshold[1] >= F.col("least_n") * threshold[0])
        met = x.withColumnRenamed(names[0], "a").join(y, on).filter(fits & (F.col("a") < F.col("b")) if len(on) == 1 else fits)
        need = F.min(F.greatest("bound", "b_bound")).alias("need")
        return met.groupBy("a", "b").agg(F.count("*").alias("overlap"), need, F.first(F.col("wide") | F.col("b_wide")).alias("wide")).filter("overlap >= need")

    opened = write_stage(meet(matrix, matrix, ["token"], ("grp", "grp")).select("a", "b", "wide"), "opened", folder)
    # Groups of many blocks: the bound again, for their blocks.
    many = opened.filter("wide").select(F.col("a").alias("grp"), F.col("b").alias("with"))
    some = meet(entries.join(many, "grp"), entries.withColumnRenamed("grp", "with"), ["token", "with"], ("blk", "blk"))
    own = blocks.filter("not wide and size > 1 and not done").select(F.col("blk").alias("a"), F.col("blk").alias("b"))
    pairs = opened.filter("not wide").select("a", "b").unionByName(some.select("a", "b")).unionByName(own)
    more = open_blocks(pairs, info.select("cls", "blk"), classes, docs, doc_id, text, words, threshold, folder, split)

    whole = components(links.unionByName(more), f"{folder}/components")
    member = classes.select("cls", F.col("rep.doc_id").alias("first_id")).join(whole.select(F.col("node").alias("cls"), "component"), "cls", "left")
    least = member.filter("component is not null").groupBy("component").agg(F.min("first_id").alias("least_id"))
    named = member.join(least, "component", "left").select("cls", F.coalesce("least_id", "first_id").alias("component_id"))
    out = told.select("doc_id", "n", "cls").join(named, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """`docs` with all their columns, with one document of each component: the one with the smallest id.

    Documents without shingles stay, and so do rows without id.  Rows that repeat an id
    are one document: they stay or go together.
    """
    found = jaccard_components(docs, doc_id, text, words, threshold)
    ids = found.filter("doc_id = component_id").select(F.col("doc_id").alias("_keep")).distinct()
    kept = docs.join(ids, F.col(doc_id) == F.col("_keep"), "left_semi")
    return kept.unionByName(docs.filter(F.col(doc_id).isNull()))
