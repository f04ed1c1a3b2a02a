"""Document fingerprints: invertible Bloom lookup tables over paragraph digests.

A text is cut into paragraphs: lines, cut again behind a sentence and, without one,
after `PIECE` characters.  The digests of its distinct paragraphs are put into a table
of cells, three cells per digest, one in each of three subtables; a cell holds a count,
the exclusive or of its digests and that of their checks.  The tables of two versions
subtract cell by cell, so that common paragraphs vanish.  Peeling then recovers the
differing digests: a cell with one digest left gives it away, and taking that digest
out of its other cells uncovers more.  A pair whose table does not peel empty is tried
again with four times the cells.

Everything is DataFrame operations.  Cells are rows (pair, cell); they stay in the
partition of their document, so that building, subtracting and peeling need no shuffle.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweft.operators.staging import scratch_path, write_stage

PIECE = 160
PARAGRAPH = rf"[^\n.!?;:|]{{1,{PIECE}}}[.!?;:|]*|[.!?;:|]+"
SUBTABLES = 3
SWEEPS = 4
BASE_CELLS = 4  # cells of a subtable in the printed fingerprint
GROWTH = 4
#: Bits of an id that are resolved at each level of the search for the next id.
LEVELS = (10, 18, 18)
#: Characters of text in a partition: the cells of its documents' tables must fit a task's memory.
PARTITION_CHARS = 8_000_000


def digests(text: Column) -> Column:
    """64-bit digests of a text's distinct paragraphs, blanks at either end aside."""
    pieces = F.filter(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_distinct(F.transform(pieces, lambda x: F.xxhash64(x)))


def _place(digest: Column, subtable: int, cells: Column) -> Column:
    """Number of a digest's cell in a subtable, counted over all subtables."""
    return (F.pmod(F.xxhash64(digest, F.lit(subtable + 1)), cells) + subtable * cells).cast("int")


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(97))


def _keeping(place, at: int):
    """A step that adds a digest by exclusive or if its place is `at`."""
    return lambda acc, d: F.when(place(d) == at, acc.bitwiseXOR(d)).otherwise(acc)


def printed(values: Column) -> Column:
    """The smallest table of some digests as text: their number and each cell's digests, in hexadecimal."""
    cells = []
    for at in range(SUBTABLES * BASE_CELLS):
        place = partial(_place, subtable=at // BASE_CELLS, cells=F.lit(BASE_CELLS))
        held = F.aggregate(values, F.lit(0).cast("long"), _keeping(place, at))
        cells.append(F.lpad(F.hex(held), 16, "0"))
    return F.lower(F.concat(F.hex(F.size(values)), F.lit("-"), *cells))


def following(ids: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(id, next): the next smaller of some distinct whole numbers, and the largest behind the smallest.

    Numbers that share all but their last bits are ordered together, at most 2 ** bits
    of them; the step from one such range to the next is the same question about the
    ranges' numbers.  So no task orders more than a range, wherever the numbers lie.
    """
    if not levels:
        w = Window.orderBy(F.desc("id"))
        return ids.select("id", F.coalesce(F.lead("id").over(w), F.max("id").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    ranged = ids.select("id", F.shiftright("id", levels[0]).alias("rng"))
    tops = ranged.groupBy("rng").agg(F.max("id").alias("top"))
    steps = following(tops.select(F.col("rng").alias("id")), levels[1:]).select(F.col("id").alias("rng"), F.col("next").alias("next_rng"))
    entry = steps.join(tops.select(F.col("rng").alias("next_rng"), "top"), "next_rng").select("rng", "top")
    inside = ranged.select("id", "rng", F.lead("id").over(Window.partitionBy("rng").orderBy(F.desc("id"))).alias("next"))
    return inside.join(entry, "rng").select("id", F.coalesce("next", "top").alias("next"))


_PAIR = ["doc_id", "kind", "cells"]


def _summed(cells: DataFrame) -> DataFrame:
    """One row per cell that is not empty.  Cells below 0 count what was recovered."""
    rows = cells.groupBy(*_PAIR, "cell").agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check"))
    return rows.filter("cell < 0 or n <> 0 or digest <> 0 or check <> 0")


def subtract(pairs: DataFrame, attempt: int) -> DataFrame:
    """The cells of the difference of pairs (doc_id, kind, one, two) of digest arrays.

    A table has, at the first attempt, at least as many cells per subtable as the two
    sides have digests.
    """
    total = F.size("one") + F.size("two")
    cells = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(4), total).cast("double")))).cast("long") * GROWTH**attempt
    signed = F.concat(
        F.transform("one", lambda d: F.struct(d.alias("digest"), F.lit(1).cast("long").alias("n"))),
        F.transform("two", lambda d: F.struct(d.alias("digest"), F.lit(-1).cast("long").alias("n"))),
    )
    rows = pairs.select("doc_id", "kind", cells.alias("cells"), F.explode(signed).alias("x")).select(*_PAIR, "x.digest", "x.n", _check(F.col("x.digest")).alias("check"))
    # Digests that both sides have cancel here, before they are put into cells.
    places = F.array(*(_place(F.col("digest"), k, F.col("cells")) for k in range(SUBTABLES)))
    return _summed(rows.select(*_PAIR, "digest", "n", "check", F.explode(places).alias("cell")))


def peel(cells: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """(doc_id, kind, only_one, only_two, left): digests recovered on either side, and cells that stay filled.

    A digest lies in one cell of each subtable, so a round that looks at one subtable
    finds each digest once.
    """
    for subtable in list(range(SUBTABLES)) * sweeps:
        mine = (F.col("cell") >= subtable * F.col("cells")) & (F.col("cell") < (subtable + 1) * F.col("cells"))
        pure = mine & (F.abs("n") == 1) & (F.col("check") == _check(F.col("digest")))
        entry = lambda cell, n, digest, check: F.struct(cell.alias("cell"), n.alias("n"), digest.alias("digest"), check.alias("check"))
        zero = F.lit(0).cast("long")
        taken = [entry(_place(F.col("digest"), k, F.col("cells")), -F.col("n"), F.col("digest"), F.col("check")) for k in range(SUBTABLES) if k != subtable]
        counted = entry(F.when(F.col("n") > 0, F.lit(-1)).otherwise(F.lit(-2)), F.lit(1).cast("long"), zero, zero)
        own = entry(F.col("cell"), F.col("n"), F.col("digest"), F.col("check"))
        cells = cells.select(*_PAIR, F.explode(F.when(pure, F.array(*taken, counted)).otherwise(F.array(own))).alias("x"))
        cells = _summed(cells.select(*_PAIR, "x.cell", "x.n", "x.digest", "x.check"))
    count = lambda cell: F.coalesce(F.sum(F.when(F.col("cell") == cell, F.col("n"))), F.lit(0))
    return cells.groupBy("doc_id", "kind").agg(count(-1).alias("only_one"), count(-2).alias("only_two"), F.count(F.when(F.col("cell") >= 0, 1)).alias("left"))


def _likeness(size_one: Column, size_two: Column, only_one: Column) -> Column:
    """Jaccard likeness from the sizes of two sets and how many of the first lack in the second."""
    common = size_one - only_one
    return F.when(size_one + size_two == 0, 1.0).otherwise(common / (size_one + size_two - common)).cast("double")


def _attempt(docs: DataFrame, order: DataFrame, attempt: int) -> DataFrame:
    """Fingerprints and likenesses of the documents in `order`, with `left` > 0 where a table did not peel."""
    chars = order.agg(F.sum("n_chars")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // PARTITION_CHARS))
    docs, order = docs.repartition(parts, "id"), order.repartition(parts, "id")
    # Each document's head and digests go to the document that it follows.
    follower = order.select(F.col("next").alias("id"), F.col("id").alias("doc_id"), "n_chars").repartition(parts, "id")
    heads = docs.join(follower, "id").select("doc_id", F.substring(F.col("text"), F.lit(1), F.floor(F.col("n_chars") / 3).cast("int")).alias("head"), digests(F.col("text")).alias("following"))
    own = docs.join(order.select("id", "n_chars"), "id").select(F.col("id").alias("doc_id"), "text", "n_chars")
    joined = own.join(heads.repartition(parts, "doc_id"), "doc_id")
    keep = (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int")
    texts = joined.select("doc_id", "n_chars", "text", F.concat(F.substring(F.col("text"), F.lit(1), keep), "head").alias("edited"), "following")
    sets = texts.select("doc_id", digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"), "following")
    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("changed").alias("two")), F.struct(F.lit(1).alias("kind"), F.col("following").alias("two")))
    pairs = sets.select("doc_id", F.col("own").alias("one"), F.explode(both).alias("x")).select("doc_id", "x.kind", "one", "x.two")
    peeled = peel(subtract(pairs, attempt))
    of = lambda c, kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col(c))), F.lit(0))
    peeled = peeled.groupBy("doc_id").agg(of("only_one", 0).alias("lacks_0"), of("only_one", 1).alias("lacks_1"), F.sum("left").alias("left"))
    told = texts.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"), F.size("following").alias("n_next"))
    told = told.select("doc_id", "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"), printed(F.col("changed")).alias("edited_fingerprint"), F.size("own").alias("n_own"), F.size("changed").alias("n_changed"), "n_next")
    return told.join(peeled, "doc_id", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        _likeness(F.col("n_own"), F.col("n_changed"), F.coalesce("lacks_0", F.lit(0))).alias("near_edited"),
        _likeness(F.col("n_own"), F.col("n_next"), F.coalesce("lacks_1", F.lit(0))).alias("near_next"),
        F.coalesce("left", F.lit(0)).alias("left"),
    )


def fingerprint_versions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third of code points (rounded down) replaced by as many
    from the start of the next document (or all of it) in descending order of ids; the
    last document is followed by the first.  Likeness is that of the sets of paragraphs,
    with the differing ones recovered from the tables; two texts without paragraphs
    are alike (1).  Null texts count as empty.  Rows without id have no place in the
    order and are left out; rows with a repeated id are one document with the greatest of
    their texts.  A single document is its own next.  Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "fingerprints")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).filter("id is not null")
    sizes = write_stage(rows.select("id", F.char_length("text").cast("long").alias("n_chars")), "sizes", folder)
    if sizes.groupBy("id").count().filter("count > 1").isEmpty():
        unique = rows
    else:
        unique = rows.groupBy("id").agg(F.max("text").alias("text"))
        sizes = write_stage(unique.select("id", F.char_length("text").cast("long").alias("n_chars")), "sizes-unique", folder)
    order = write_stage(following(sizes.select("id")).join(sizes, "id"), "order", folder)
    done, attempt = None, 0
    while True:
        found = write_stage(_attempt(unique, order, attempt), f"attempt-{attempt}", folder)
        whole = found.filter("left = 0").drop("left")
        done = whole if done is None else done.unionByName(whole)
        failed = found.filter("left > 0").select(F.col("doc_id").alias("id"))
        if failed.isEmpty():
            return done
        attempt += 1
        order = write_stage(order.join(failed, "id"), f"order-{attempt}", folder)
