"""The Merkle manifest against a tree built level by level in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from crawlweft.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[n] for n in FIELDS)))


def climb(nodes, fanout):
    """Root, and per leaf the steps (before, after), by the definition."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // fanout * fanout
            steps[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + fanout])))
        at = [k // fanout for k in at]
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], steps


def expected(rows, fanout):
    """(doc_id, leaf, subroot, root, proof) of each row."""
    named = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]
    groups = {}
    for r in named:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g])], fanout) for g in order}
    root, top = climb([trees[g][0] for g in order], fanout) if order else (None, [])
    out = []
    for g, upper in zip(order, top, strict=True):
        for (known, key, h), lower in zip(sorted(groups[g]), trees[g][1], strict=True):
            out.append((key if known else None, h, trees[g][0], root, tuple(lower + upper)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(tuple(x) for x in r["proof"])) for r in df.collect()), key=str)


def rows_of(n, langs):
    return [(i, f"text {i} é" * (i % 3), langs[i % len(langs)], None if i % 5 == 0 else "s", i if i % 4 else None) for i in range(n)]


@pytest.mark.parametrize(
    ("rows", "fanout", "levels"),
    [
        (rows_of(1, ["en"]), 2, 2),
        (rows_of(2, ["en", None]), 2, 2),
        (rows_of(57, ["en", "en", "en", "fr", "én", None]), 2, 2),  # several blocks, a ragged last subtree
        (rows_of(64, ["en"]), 2, 3),  # whole subtrees
        (rows_of(65, ["en"]), 2, 2),  # a last block of one leaf
        (rows_of(100, ["en", "en", "de"]), 3, 1),
        (rows_of(83, ["en", "en", "en", ""]), 4, 1),
        ([(None, "a", "en", "s", 1), (None, None, "en", None, None), (3, "x", "en", "s", 1), (3, "x", "en", "s", 1), (3, "y", "en", "s", 2)] * 3, 2, 1),  # null ids, ties, repeated rows
    ],
)
def test_proofs(spark, rows, fanout, levels):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("leaf", F.lit("a clash")).withColumn("root", F.lit(1))
    proved = merkle.manifest(docs, FIELDS, fanout=fanout, levels=levels)
    assert found(proved) == expected(rows, fanout)
    assert proved.filter("not verified").isEmpty()


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA), FIELDS).collect() == []


def test_tampered_rows_fail(spark):
    rows = rows_of(120, ["en", "de", None])
    docs = spark.createDataFrame(rows, SCHEMA)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(docs, FIELDS, changed={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, levels=3).collect()
    by_id = {r[0]: r for r in rows}
    for r in got:
        tampered = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and by_id[r["doc_id"]][4] is not None
        assert r["verified"] != tampered
        node = leaf(dict(zip(("doc_id", "text", "lang", "source", "n_chars"), by_id[r["doc_id"]], strict=True)) | ({"n_chars": by_id[r["doc_id"]][4] + 1} if tampered else {}))
        for before, after in r["proof"]:
            node = sha(before + node + after)
        assert r["folded_root"] == node


def test_one_block_holds_the_root_of_all(spark):
    """Every block ends with the same subroot, without any pass back down."""
    state = spark.createDataFrame([("g", b, 11, sha(str(b))) for b in range(11)] + [("h", 0, 1, sha("h"))], "_group string, _block long, _blocks long, _node string")
    state = state.withColumn("_steps", F.array().cast(merkle.STEPS))
    out = merkle._exchange(state, 2, 4, merkle.scratch_path(spark, "test")).collect()
    root, steps = climb([sha(str(b)) for b in range(11)], 2)
    for r in out:
        assert r["_node"] == (root if r["_group"] == "g" else sha("h"))
        assert [tuple(x) for x in r["_steps"]] == (steps[r["_block"]] if r["_group"] == "g" else [])


def test_production_levels(spark):
    """The registered parameters, over more than one block."""
    rows = [(i, None, "en", None, None) for i in range(2**merkle.LEVELS + 5)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), FIELDS)
    root, steps = climb([leaf(dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True))) for r in rows], 2)
    assert got.select("root").distinct().collect()[0][0] == root
    some = {r["doc_id"]: [tuple(x) for x in r["proof"]] for r in got.filter("doc_id % 997 = 0 or doc_id > 4095").collect()}
    assert some and all(some[i] == steps[i] for i in some)
