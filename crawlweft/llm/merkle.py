"""Merkle manifest of a table: every row's proof up to one root, by a butterfly exchange.

Rows are leaves.  Per group, leaves stand in order; every `fanout` consecutive nodes become
their parent until one is left, the group's subroot, and the subroots become the root in
the same way.

1. Leaves are sorted by range, and ranks follow from the row counts of the parts, so a group
   that holds most rows is spread over many parts.
2. Every group is cut into aligned blocks of `fanout ** levels` leaves.  A task hashes a block
   up to its top node, in bounded memory.
3. The blocks then swap nodes round by round.  In round r, `fanout` blocks whose numbers differ
   in digit r alone form a group: each sends the others its own ancestor and hashes the parent
   for itself.  All blocks below a node so hold that node, and after the last round every block
   holds the subroot and the siblings on its way there; nothing is sent down again.  Where
   the last subtree has fewer blocks than its neighbours, these ask its blocks in turn.
4. The subroots of the groups are leaves of one more such tree.

A round moves one short row for each block; there are as many rounds as the logarithm
of the largest group's blocks.  Each round is a table in the shared folder, so a lost executor
costs a part of one round.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweft.operators.staging import broadcast_if_small, scratch_path, write_stage

FANOUT = 2
#: Levels of the tree inside a block: 2 ** 12 leaves and about 1 MB of digests.
LEVELS = 12
STEPS = "array<struct<before:string,after:string>>"


def field_code(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value, so that no two rows read alike."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    """Lower-case hex SHA-256 of the codes of a row's fields."""
    return F.sha2(F.concat(*(field_code(c) for c in fields)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof, concatenated level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def _parent(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def block_tree(leaves: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """Nodes by level, leaves first: up to a single node, or exactly `levels` levels above the leaves."""
    out = [leaves]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([_parent(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return out


def block_steps(tree: list[list[str]], fanout: int) -> pa.Array:
    """Per leaf of a block the siblings (before, after) on the way to the block's top node."""
    sides = []
    for nodes in tree[:-1]:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        sides.append([("".join(run[:k]), "".join(run[k + 1 :])) for run in runs for k in range(len(run))])
    flat = [side[i // fanout**level] for i in range(len(tree[0])) for level, side in enumerate(sides)]
    steps = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], pa.string()) for k in (0, 1)], ["before", "after"])
    return pa.ListArray.from_arrays(pa.array(range(0, len(tree[0]) * len(sides) + 1, len(sides)) if sides else [0] * (len(tree[0]) + 1), pa.int32()), steps)


def _placed(leaves: DataFrame, folder: str) -> DataFrame:
    """Add `_pos`, a leaf's place in its group from 0, and `_total`, the group's leaves."""
    leaves = write_stage(leaves, "leaves", folder)  # the range sampling reads it once more
    ordered = leaves.repartitionByRange(F.col("_group"), F.col("_order").asc_nulls_first(), F.col("_leaf"))
    ordered = ordered.sortWithinPartitions(F.col("_group"), F.col("_order").asc_nulls_first(), F.col("_leaf"))
    ordered = write_stage(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered", folder)
    part, index = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy("_group", part.alias("_part")).agg(F.count("*").alias("_n"), F.min(index).alias("_first"))
    # A row for each part of a group: a handful, or as many as there are parts for a large one.
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_group", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("_total"))
    counts = write_stage(counts, "counts", folder)
    found = ordered.withColumn("_part", part).join(broadcast_if_small(counts), ["_group", "_part"])
    return found.withColumn("_pos", index + F.col("_shift")).drop("_at", "_part", "_shift")


def _exchange(state: DataFrame, fanout: int, rounds: int, folder: str) -> DataFrame:
    """All rounds over blocks (_group, _block, _blocks, _node, _steps)."""
    for r in range(rounds):
        span = fanout**r
        digit = F.expr(f"_block div {span}") % fanout
        start = F.col("_block") - F.col("_block") % (span * fanout)
        peers = []
        for d in range(fanout):
            first = start + d * span
            # The same place in the peer's subtree; a shorter last subtree is asked in turn.
            place = F.col("_block") % F.least(F.lit(span), F.col("_blocks") - first)
            peers.append(F.when((digit != d) & (first < F.col("_blocks")), F.struct(F.lit(d).alias("d"), (first + place).alias("peer"))))
        asked = state.filter(F.col("_blocks") > span).select("_group", "_block", F.explode(F.array_compact(F.array(*peers))).alias("ask"))
        held = state.select("_group", F.col("_block").alias("peer"), F.col("_node").alias("got"))
        got = asked.select("_group", "_block", "ask.d", "ask.peer").join(held, ["_group", "peer"])
        got = got.groupBy("_group", "_block").agg(F.sort_array(F.collect_list(F.struct("d", "got"))).alias("_got"))  # fewer than fanout
        joined = state.join(got, ["_group", "_block"], "left").withColumn("_got", F.coalesce("_got", F.array().cast("array<struct<d:int,got:string>>")))
        before, after = (F.array_join(F.transform(F.filter("_got", test), lambda x: x["got"]), "") for test in (lambda x: x["d"] < digit, lambda x: x["d"] > digit))
        joined = joined.withColumns({"_before": before, "_after": after})
        goes_on = F.col("_blocks") > span
        state = joined.select(
            "_group",
            "_block",
            "_blocks",
            F.when(goes_on, F.sha2(F.concat("_before", "_node", "_after"), 256)).otherwise(F.col("_node")).alias("_node"),
            F.when(goes_on, F.concat("_steps", F.array(F.struct(F.col("_before").alias("before"), F.col("_after").alias("after"))))).otherwise(F.col("_steps")).alias("_steps"),
        )
        state = write_stage(state, f"round-{r}", folder)
    return state


def _prove_groups(leaves: DataFrame, fanout: int, levels: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """(rows with `_steps` up to their group's subroot, (_group, _node) of subroots) of rows (_group, _order, _leaf, ...)."""
    size = fanout**levels
    placed = _placed(leaves, folder).withColumn("_block", F.expr(f"_pos div {size}")).withColumn("_blocks", F.expr(f"(_total + {size - 1}) div {size}"))
    placed = write_stage(placed, "placed", folder)

    def tree(table: pa.Table) -> list[list[str]]:
        lift = levels if table.column("_blocks")[0].as_py() > 1 else None
        return block_tree(table.column("_leaf").to_pylist(), fanout, lift)

    def top(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        row = {n: table.column(n)[:1] for n in ("_group", "_block", "_blocks")}
        return pa.table(row | {"_node": [tree(table)[-1][0]]})

    narrow = placed.select("_group", "_block", "_blocks", "_pos", "_leaf")
    tops = narrow.groupBy("_group", "_block").applyInArrow(top, "_group string, _block long, _blocks long, _node string")
    state = write_stage(tops.withColumn("_steps", F.array().cast(STEPS)), "blocks", folder)
    most, rounds = state.agg(F.max("_blocks")).first()[0] or 1, 0
    while fanout**rounds < most:
        rounds += 1
    state = _exchange(state, fanout, rounds, folder)

    def steps(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        return table.append_column("_steps", block_steps(tree(table), fanout))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    proved = placed.groupBy("_group", "_block").applyInArrow(steps, f"{kinds}, _steps {STEPS}")
    upper = state.select("_group", "_block", F.col("_steps").alias("_upper"))
    proved = proved.join(broadcast_if_small(upper, max_rows=10_000), ["_group", "_block"]).withColumn("_steps", F.concat("_steps", "_upper"))
    return proved.drop("_upper", "_block", "_blocks", "_pos", "_total"), state.filter("_block = 0").select("_group", "_node")


def prove(leaves: DataFrame, group: str, order: str, leaf: str, fanout: int = FANOUT, levels: int = LEVELS, folder: str | None = None) -> DataFrame:
    """`leaves` with all their columns, and `subroot`, `root` and `proof`.

    Rows stand by `order` (nulls first, ties by their digest) within their `group`; groups by
    UTF-8 bytes, null first.  `leaf` holds hex digests.  `proof` has a step for each level, with the
    digests of the siblings before and after; `fold` leads from a leaf to the root with it.
    A run of one node is hashed by itself and its step is empty; a lone leaf is its own
    subroot, a lone subroot the root.  Repeated rows are leaves each.  No rows give no rows.
    Names that start with an underscore are taken.
    """
    folder = folder or scratch_path(leaves.sparkSession, "merkle")
    rows = leaves.select(
        F.struct(*(F.col(f"`{n}`") for n in leaves.columns)).alias("_row"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("_group"),
        F.col(f"`{order}`").alias("_order"),
        F.col(f"`{leaf}`").alias("_leaf"),
    )
    proved, subroots = _prove_groups(rows, fanout, levels, f"{folder}/rows")
    top = subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_order"), F.col("_node").alias("_leaf"))
    tops, roots = _prove_groups(top, fanout, levels, f"{folder}/groups")
    tops = tops.join(F.broadcast(roots.select("_group", F.col("_node").alias("root"))), "_group")  # one row
    tops = write_stage(tops.select(F.col("_order").alias("_group"), F.col("_leaf").alias("subroot"), "root", F.col("_steps").alias("_top")), "tops", folder)
    found = proved.join(broadcast_if_small(tops, max_rows=10_000), "_group")
    return found.select("_row.*", "subroot", "root", F.concat("_steps", "_top").alias("proof"))


def manifest(docs: DataFrame, fields: tuple[str, ...], group: str = "lang", order: str = "doc_id", changed: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row of `docs`: order and group column, leaf, subroot, root, proof, folded_root, verified.

    `changed` gives fields as they are found later, after tampering; `folded_root` is folded from
    these with the siblings of the original, and `verified` says whether it is the root.
    Nulls in any field have a code of their own.  Other columns are ignored.
    """
    now = [(changed or {}).get(n, F.col(f"`{n}`")) for n in fields]
    leaves = docs.select(F.col(f"`{order}`"), F.col(f"`{group}`"), leaf_hash(*(F.col(f"`{n}`") for n in fields)).alias("leaf"), leaf_hash(*now).alias("leaf_now"))
    proved = prove(leaves, group, order, "leaf", fanout, levels).withColumn("folded_root", fold(F.col("leaf_now"), F.col("proof")))
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
