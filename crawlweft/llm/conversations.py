"""Conversation repair: the cheapest edits that make a conversation well-formed, by iterative-deepening A*.

A conversation is well-formed if its roles read `(system? (user assistant)+)?`.  Edits go along its
rows: Keep, Delete, Rerole to the role that is due, Insert an empty message.  Blank rows
and rows that repeat an earlier one must be deleted; truncated rows that stay cost extra.
The search is depth-first in the ASCII order of the edits' initials (D, I, K, R) under a
cost bound; the bound starts at a lower bound of the cost and rises to the least cost that went
beyond it.  A table of failed states (row, role due, budget left) stops second visits.  The
first path that is accepted is so the cheapest one, and of these the least in ASCII order.

Rows are sorted by range over (conversation, turn, role, text), so a conversation that
holds most rows is spread over many tasks.  A task cuts long conversations, and those
that may go on in the next task, into pieces of at most `PIECE` rows and searches each piece
for every role that may be due before and after it.  Costs of pieces add up; as every such path ends
with a row's edit, none is the start of another of the same rows, so ranks of paths inside
a piece are all it takes to find the least of the whole.  Pieces are first joined
inside a task's part and then over parts: a dozen numbers for each.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from crawlweft.llm.texts import arrow_limits
from crawlweft.operators.staging import broadcast_if_small, scratch_path, write_stage

#: Rows of a piece; the search of a piece takes time with its square.
PIECE = 64
# What the edits cost, and what a truncated row adds that is not deleted.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
BLANK_BYTES = "\\x20\\x09-\\x0D"

# What may come next: 0 anything that starts, 1 after system, 2 after user, 3 after assistant.
STATES = range(4)
_DUE = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: Inserts that end a conversation in each state.
_TAIL = {0: 0, 1: 2, 2: 1, 3: 0}
_LEGAL = {"su", "ua", "au"}
FORCED, TRUNC, SOUND = 0, 1, 2


def search(rows: list[tuple[str, int, int]], entry: int, goal: int | None) -> tuple[int, str] | None:
    """Least cost and the ASCII-least edits of that cost over rows (initial, kind, count), from state `entry`.

    `goal` is the state after the last row's edit, or None for a well-formed end, with
    inserts behind the last row where needed.  None if there is no way.  Rows of kind
    `FORCED` stand for `count` deletions.
    """
    n = len(rows)
    least = [0] * (n + 1)
    starts = [False] * (n + 1)  # whether a row that can start with `system` follows
    for i in range(n - 1, -1, -1):
        initial, kind, count = rows[i]
        least[i] = least[i + 1] + (DELETE * count if kind == FORCED else TRUNCATED if kind == TRUNC else 0)
        starts[i] = starts[i + 1] or (kind != FORCED and initial == "s")

    def bound_of(i: int, state: int) -> int | None:
        """A lower bound of what is left to pay; None where the goal is out of reach."""
        if goal is None:
            return least[i] + (INSERT * _TAIL[state] if i == n else 0)
        if i == n:
            return 0 if state == goal else None
        if goal < 2 and state != goal and (state > 0 or not starts[i]):
            return None
        return least[i]

    def moves(i: int, state: int):
        """(initial, cost, edits, next row, next state) in ASCII order."""
        due = _DUE[state][1]
        if i == n:
            if goal is None:
                yield INSERT, "I", i, due
            return
        initial, kind, count = rows[i]
        yield (DELETE * count, "D" * count, i + 1, state) if kind == FORCED else (DELETE, "D", i + 1, state)
        yield INSERT, "I", i, due
        if kind != FORCED:
            more = TRUNCATED if kind == TRUNC else 0
            if (state, initial) in _KEEP:
                yield more, "K", i + 1, _KEEP[state, initial]
            yield REROLE + more, "R", i + 1, due

    limit = bound_of(0, entry)
    while limit is not None:
        failed: dict[tuple[int, int], int] = {}
        beyond = None
        path: list[str] = []
        # Each frame: row, state, budget left, moves not tried yet.
        stack = [(0, entry, limit, moves(0, entry))]
        if n == 0 and (entry == goal or goal is None and not _TAIL[entry]):
            return limit, ""
        while stack:
            i, state, budget, rest = stack[-1]
            for cost, edits, j, then in rest:
                left, need = budget - cost, bound_of(j, then)
                if need is None:
                    continue
                if left < need:
                    beyond = limit - left + need if beyond is None else min(beyond, limit - left + need)
                elif failed.get((j, then), -1) < left:
                    path.append(edits)
                    if j == n and (then == goal or goal is None and not _TAIL[then]):
                        return limit - left, "".join(path)
                    stack.append((j, then, left, moves(j, then)))
                    break
            else:
                failed[i, state] = max(failed.get((i, state), -1), budget)
                stack.pop()
                if path:
                    path.pop()
        limit = beyond
    return None


def ways(rows: list[tuple[str, int, int]]) -> tuple[list[int | None], list[int], list[str | None]]:
    """Costs, ranks and edits of a piece for each pair of states before and behind it; ranks order the edits from one state."""
    costs, ranks, edits = [], [], []
    for entry in STATES:
        found = [search(rows, entry, goal) for goal in STATES]
        order = sorted(x[1] for x in found if x)
        costs += [x[0] if x else None for x in found]
        edits += [x[1] if x else None for x in found]
        ranks += [order.index(x[1]) if x else 4 for x in found]
    return costs, ranks, edits


def _extended(best: dict[int, tuple], costs: list[int | None], ranks: list[int]) -> dict[int, tuple]:
    """`best` (state: cost, rank, state before) over one more piece."""
    out = {}
    for goal in STATES:
        options = [(c + costs[4 * s + goal], r, s) for s, (c, r, _) in best.items() if costs[4 * s + goal] is not None]
        if options:
            cost, rank, before = min(options)
            out[goal] = (cost, (rank, ranks[4 * before + goal]), before)
    order = sorted(rank for _, rank, _ in out.values())
    return {s: (cost, order.index(rank), before) for s, (cost, rank, before) in out.items()}


def joined(pieces: list[tuple[list, list]]) -> tuple[list[int | None], list[int]]:
    """Costs and ranks of consecutive pieces as one."""
    costs, ranks = [], []
    for entry in STATES:
        best = {entry: (0, 0, entry)}
        for c, r in pieces:
            best = _extended(best, c, r)
        costs += [best[s][0] if s in best else None for s in STATES]
        ranks += [best[s][1] if s in best else 4 for s in STATES]
    return costs, ranks


def states_between(pieces: list[tuple[list, list]], entry: int, goal: int | None) -> list[int]:
    """The states before, between and behind consecutive pieces on the best way; with no goal to a well-formed end."""
    steps = [{entry: (0, 0, entry)}]
    for c, r in pieces:
        steps.append(_extended(steps[-1], c, r))
    last = steps[-1]
    at = goal if goal is not None else min((last[s][0] + INSERT * _TAIL[s], last[s][1], s) for s in last)[2]
    out = [at]
    for step in reversed(steps[1:]):
        at = step[at][2]
        out.append(at)
    return out[::-1]


def edit(messages: list[tuple[str, str]], edits: str, state: int) -> list[dict[str, str]]:
    """The messages after `edits`, from `state` on; rows that stand for several give one `D` each."""
    out, rows = [], iter(messages)
    for e in edits:
        role, text = ("", "") if e == "I" else next(rows)
        if e != "D":
            due, then = _DUE[state]
            state = _KEEP[state, role[:1]] if e == "K" else then
            out.append({"role": role if e == "K" else due, "text": text})
    return out


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) after the damage that the CRC-32 of `conv_id:turn` modulo 20 picks.

    0 drops a row, 1 empties its text, 2 takes its `.!?` out, 3 repeats it, 4 makes its role user.
    Nulls count as one blank, except in the ids and turns that are returned.
    """

    def said(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said(conv_id), F.lit(":"), said(turn)).cast("binary")) % 20
    rows = rows.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), said(role).alias("role"), said(text).alias("text"), kind.alias("kind"))
    return rows.filter("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _faulty(rows: DataFrame, folder: str) -> DataFrame:
    """Distinct rows with how often they occur (`copies`) and the first one's `fault`."""
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    at, same = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")), F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    # Only messages that recur at a later turn; usually few.
    seen = rows.select("key", same.alias("same"), at.alias("at")).groupBy("key", "same").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    seen = write_stage(seen.filter("first <> last").select("key", "same", "first"), "seen", folder)
    whole = rows.groupBy("key", "conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    whole = whole.withColumns({"same": same, "at": at}).join(broadcast_if_small(seen), ["key", "same"], "left")
    blank = ~F.col("text").rlike(f"[^{BLANK_BYTES}]")
    fault = F.when(blank, "blank").when(F.coalesce(F.col("at") > F.col("first"), F.lit(False)), "duplicate").when(~F.col("text").rlike(f"[.!?][{BLANK_BYTES}]*\\z"), "truncated")
    return write_stage(whole.select("key", "conv_id", "turn", "role", "text", "copies", fault.alias("fault")), "faulty", folder)


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_MESSAGES = "array<struct<role:string,text:string>>"


class _Piece:
    """Consecutive rows of one conversation."""

    def __init__(self, key, conv_id):
        self.key, self.conv_id, self.messages, self.rows = key, conv_id, [], []
        self.turns = []
        self.count = dict.fromkeys(_COUNTS, 0)

    def add(self, turn, role, text, copies, fault):
        kind = FORCED if fault in ("blank", "duplicate") else TRUNC if fault else SOUND
        initial = role[:1]
        if self.rows and self.last + initial not in _LEGAL:
            self.count["illegal"] += 1
        self.count["illegal"] += copies - 1
        self.count[fault or "truncated"] += 0 if not fault else copies if kind == FORCED else 1
        if kind == FORCED:
            self.rows.append((initial, FORCED, copies))
        else:
            self.count["duplicate"] += copies - 1
            self.rows.append((initial, kind, 1))
            if copies > 1:
                self.rows.append((initial, FORCED, copies - 1))
        self.messages.append((role, text, copies))
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.first, self.last = (self.first if len(self.messages) > 1 else initial), initial

    def out(self, part, index, whole):
        row = {"key": self.key, "conv_id": self.conv_id, "part": part, "piece": index, "first": self.first, "last": self.last}
        row |= {"first_turn": self.turns[0] if self.turns else None, "last_turn": self.turns[-1] if self.turns else None, "turns": len(self.turns)} | self.count
        if whole:
            cost, audit = search(self.rows, 0, None)
            return row | {"cost": cost, "audit": audit, "repaired": edit(self.expanded(self.messages), audit, 0)}
        costs, ranks, edits = ways(self.rows)
        return row | {"costs": costs, "ranks": ranks, "edits": edits, "messages": [{"role": r, "text": t, "copies": c} for r, t, c in self.messages]}

    @staticmethod
    def expanded(messages):
        return ((r, t) for r, t, copies in messages for _ in range(copies))


def _pieces(rows: DataFrame, piece: int, folder: str) -> DataFrame:
    """One row for each conversation that a task sees whole, and one for each piece of the others."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    by = ("key", F.col("turn").asc_nulls_first(), "role", "text")
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    counts = ", ".join(f"{n} long" for n in _COUNTS)
    schema = (
        f"key string, conv_id {kind}, part int, piece int, first string, last string, first_turn long, last_turn long, turns long, {counts}, cost long, audit string, "
        f"repaired {_MESSAGES}, costs array<long>, ranks array<int>, edits array<string>, messages array<struct<role:string,text:string,copies:long>>"
    )
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        part, index, now, runs, out = TaskContext.get().partitionId(), 0, None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["key"] != now.key:
                    if now is not None:
                        out.append(now.out(part, index, whole=runs > 1 and index == 0))
                    now, index, runs = _Piece(row["key"], row["conv_id"]), 0, runs + 1
                elif len(now.messages) >= piece:
                    out.append(now.out(part, index, whole=False))
                    now, index = _Piece(row["key"], row["conv_id"]), index + 1
                now.add(row["turn"], row["role"], row["text"], row["copies"], row["fault"])
            if out:
                yield pa.RecordBatch.from_pylist(out, wanted)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.out(part, index, whole=False)], wanted)

    arrow_limits(rows.sparkSession)
    return write_stage(ordered.select("key", "conv_id", "turn", "role", "text", "copies", "fault").mapInArrow(run, schema), "pieces", folder)


def _summed(rows: list[dict]) -> dict:
    """Counts of consecutive pieces of a conversation as one."""
    out = {n: sum(r[n] for r in rows) for n in (*_COUNTS, "turns")} | {"first": rows[0]["first"], "last": rows[-1]["last"]}
    out["illegal"] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(rows, rows[1:], strict=False))
    known = [r for r in rows if r["turns"]]
    out["turns"] -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(known, known[1:], strict=False))
    return out | {"first_turn": known[0]["first_turn"] if known else None, "last_turn": known[-1]["last_turn"] if known else None}


_SUMS = "first string, last string, first_turn long, last_turn long, turns long, " + ", ".join(f"{n} long" for n in _COUNTS)
_WAYS = "costs array<long>, ranks array<int>"


def _in_order(table: pa.Table, *by: str) -> list[dict]:
    return table.sort_by([(n, "ascending") for n in by]).to_pylist()


def _decide(pieces: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Over the pieces of cut conversations: (key, sums, cost, tail), and (key, part, piece, entry, goal)."""
    names = [*(x.split()[0] for x in _SUMS.split(", ")), "costs", "ranks"]
    narrow = pieces.select("key", "part", "piece", *names)
    run = f"key string, part int, {_SUMS}, {_WAYS}"
    decided = "key string, part int, entry int, goal int, cost long, tail int, " + _SUMS
    placed = "key string, part int, piece int, entry int, goal int"
    run_kind, decided_kind, placed_kind = (to_arrow_schema(StructType.fromDDL(x)) for x in (run, decided, placed))

    def run_of(table: pa.Table) -> pa.Table:
        rows = _in_order(table, "piece")
        costs, ranks = joined([(r["costs"], r["ranks"]) for r in rows])
        return pa.Table.from_pylist([{"key": rows[0]["key"], "part": rows[0]["part"], "costs": costs, "ranks": ranks} | _summed(rows)], run_kind)

    def whole_of(table: pa.Table) -> pa.Table:
        rows = _in_order(table, "part")
        runs = [(r["costs"], r["ranks"]) for r in rows]
        at = states_between(runs, 0, None)
        cost = sum(c[4 * a + b] for (c, _), a, b in zip(runs, at, at[1:], strict=False)) + INSERT * _TAIL[at[-1]]
        total = _summed(rows) | {"cost": cost, "tail": _TAIL[at[-1]]}
        nothing = dict.fromkeys(total)
        return pa.Table.from_pylist([{"key": r["key"], "part": r["part"], "entry": a, "goal": b} | (nothing if k else total) for k, (r, a, b) in enumerate(zip(rows, at, at[1:], strict=False))], decided_kind)

    def way_of(table: pa.Table) -> pa.Table:
        rows = _in_order(table, "piece")
        at = states_between([(r["costs"], r["ranks"]) for r in rows], rows[0]["entry"], rows[0]["goal"])
        return pa.Table.from_pylist([{"key": r["key"], "part": r["part"], "piece": r["piece"], "entry": a, "goal": b} for r, a, b in zip(rows, at, at[1:], strict=False)], placed_kind)

    runs = narrow.groupBy("key", "part").applyInArrow(run_of, run)
    choice = write_stage(runs.groupBy("key").applyInArrow(whole_of, decided), "decided", folder)
    told = narrow.select("key", "part", "piece", "costs", "ranks").join(choice.select("key", "part", "entry", "goal"), ["key", "part"])
    return choice.filter("cost is not null").drop("part", "entry", "goal"), write_stage(told.groupBy("key", "part").applyInArrow(way_of, placed), "chosen", folder)


def _edited(pieces: DataFrame) -> DataFrame:
    """(key, part, piece, audit, repaired) of pieces whose states before and behind are decided."""
    schema = f"key string, part int, piece int, audit string, repaired {_MESSAGES}"
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit = r["edits"][4 * r["entry"] + r["goal"]]
                messages = _Piece.expanded((m["role"], m["text"], m["copies"]) for m in r["messages"])
                out.append({"key": r["key"], "part": r["part"], "piece": r["piece"], "audit": audit, "repaired": edit(messages, audit, r["entry"])})
            yield pa.RecordBatch.from_pylist(out, wanted)

    return pieces.select("key", "part", "piece", "entry", "goal", "edits", "messages").mapInArrow(run, schema)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """Per conversation what is wrong and how it is repaired, and the repaired messages in pieces.

    First (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), second
    (conv_id, part, piece, whole, repaired): the messages (role, text) of a conversation in the order
    of part and piece.  `whole` conversations have a single piece.

    Rows stand by turn, nulls first; ties by role and text.  Null roles and texts count as one
    blank; a null conversation id is one conversation.  A role is known by its first letter, so
    rows with other, or empty, roles can only be deleted or given the role that is due.
    Equal rows stand next to each other, and all but the first are duplicates; `copies` names a
    column that says how often a row occurs.  A table without rows has no conversations.
    Other columns are ignored.
    """
    folder = scratch_path(rows.sparkSession, "conversations")
    blank = F.lit(" ")
    rows = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text"),
        (F.col(f"`{copies}`").cast("long") if copies else F.lit(1).cast("long")).alias("copies"),
    )
    pieces = _pieces(_faulty(rows, folder), piece, folder)
    cut = pieces.filter("costs is not null")
    totals, chosen = _decide(cut, folder)
    edited = write_stage(_edited(cut.join(broadcast_if_small(chosen), ["key", "part", "piece"])), "edited", folder)
    ids = cut.groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    # The audit is one value of the result; its parts are one letter for each row.
    audits = edited.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "piece", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    totals = totals.join(audits, "key").join(ids, "key").withColumn("audit", F.concat("audit", F.repeat(F.lit("I"), F.col("tail"))))
    fields = ["conv_id", "first_turn", "last_turn", "turns", *_COUNTS, "cost", "audit"]
    uncut = pieces.filter("costs is null")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0).cast("long"))
    report = uncut.select(*fields).unionByName(totals.select(*fields)).select("conv_id", gaps.alias("gaps"), *_COUNTS, "cost", "audit")
    tail = F.expr("transform(filter(array('user', 'assistant'), (x, i) -> i >= 2 - tail), x -> struct(x AS role, '' AS text))")
    ends = totals.filter("tail > 0").select("key", F.lit((1 << 31) - 1).alias("part"), F.lit(0).alias("piece"), tail.cast(_MESSAGES).alias("repaired"))
    rest = edited.select("key", "part", "piece", "repaired").unionByName(ends).join(ids, "key")
    shown = ("conv_id", "part", "piece", "whole", "repaired")
    return report, uncut.withColumn("whole", F.lit(True)).select(*shown).unionByName(rest.withColumn("whole", F.lit(False)).select(*shown))


def _lines(messages: Column) -> Column:
    return F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["text"]))


def digests(report: DataFrame, messages: DataFrame) -> DataFrame:
    """`report` with `repaired_sha256`: SHA-256 of the repaired `role:text` lines, joined by newlines.

    A digest is taken over one text from its start to its end.  Whole conversations are hashed
    where they are; the pieces of the others pass one task in order, a batch at a time.
    """
    kind = messages.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, repaired_sha256 string"
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        now, state, empty = None, None, True
        for batch in batches:
            for conv, rows in groupby(batch.to_pylist(), key=lambda r: r["conv_id"]):
                if state is None or conv != now:
                    if state is not None:
                        yield pa.RecordBatch.from_pylist([{"conv_id": now, "repaired_sha256": state.hexdigest()}], wanted)
                    now, state, empty = conv, hashlib.sha256(), True
                for row in rows:
                    for line in row["lines"]:
                        state.update((line if empty else "\n" + line).encode())
                        empty = False
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": now, "repaired_sha256": state.hexdigest()}], wanted)

    arrow_limits(messages.sparkSession)
    rest = messages.filter("not whole").select("conv_id", "part", "piece", _lines(F.col("repaired")).alias("lines"))
    rest = rest.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").select("conv_id", "lines").mapInArrow(run, schema)
    sums = messages.filter("whole").select("conv_id", F.sha2(F.array_join(_lines(F.col("repaired")), "\n"), 256).alias("repaired_sha256")).unionByName(rest)
    sums = sums.withColumnRenamed("conv_id", "_id")
    return report.join(sums, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")
