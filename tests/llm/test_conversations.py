"""Conversation repair against a plain shortest-path search over whole conversations."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from crawlweft.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string"
WELL_FORMED = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, repaired) over rows (role, text, fault): Dijkstra by cost, then audit."""
    due = {"": ("user", "u"), "s": ("user", "u"), "a": ("user", "u"), "u": ("assistant", "a")}
    heap, done, n = [(0, "", 0, "", ())], set(), len(rows)
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == n and last in ("", "a"):
            return cost, audit, list(out)
        role, then = due[last]
        heapq.heappush(heap, (cost + 3, audit + "I", i, then, (*out, (role, ""))))
        if i < n:
            own, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                if (own[:1] == "s" and not last) or (own[:1] == "u" and last != "u") or (own[:1] == "a" and last == "u"):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, own[:1], (*out, (own, text))))
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, then, (*out, (role, text))))


def fault_of(role, text, seen):
    if not re.search(r"[^\x20\x09-\x0D]", text):
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return None if re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] in ".!?" else "truncated"


def expected(rows):
    """Report rows by conversation, of rows (conv_id, turn, role, text) as they are."""
    out = {}
    blank = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for c in {r[0] for r in blank}:
        own = sorted(((t is not None, t or 0, r.encode(), x.encode(), r, x) for k, t, r, x in blank if k == c))
        seen, told = set(), []
        for *_, role, text in own:
            told.append((role, text, fault_of(role, text, seen)))
            seen.add((role, text))
        turns = [x[1] for x in own if x[0]]
        cost, audit, repaired = cheapest(told)
        initials = [r[:1] for r, _, _ in told]
        out[c] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{n: sum(f == n for *_, f in told) for n in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{x}" for r, x in repaired).encode()).hexdigest(),
        }
    return out


def found(report):
    return {r["conv_id"]: {n: r[n] for n in r.asDict() if n != "conv_id"} for r in report.collect()}


def some_rows(rng, convs, longest):
    roles, texts = ["system", "user", "assistant", "assistant", "user", "tool", "", None], ["Yes.", "No", "Why?\n", " \t", "", None, "a! ", "é. "]
    rows = []
    for c in [*range(convs), None]:
        turn = 0
        for _ in range(rng.randrange(1, longest)):
            turn += rng.choice([0, 1, 1, 1, 2])
            text = rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randrange(10**6)}" + rng.choice([".", "", "!"])
            rows.append((c, None if rng.random() < 0.05 else turn, rng.choice(roles) if rng.random() < 0.5 else ("user", "assistant")[turn % 2], text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_search_finds_the_least_path(seed):
    rng = random.Random(seed)
    for _ in range(300):
        rows = [(rng.choice("suaauat"), rng.choice([conv.FORCED, conv.TRUNC, conv.SOUND, conv.SOUND]), 1) for _ in range(rng.randrange(9))]
        plain = [(r, "", {conv.FORCED: "blank", conv.TRUNC: "truncated", conv.SOUND: None}[k]) for r, k, _ in rows]
        assert conv.search(rows, 0, None) == cheapest(plain)[:2]


def test_pieces_join_to_the_whole():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice("suauat"), rng.choice([conv.FORCED, conv.TRUNC, conv.SOUND, conv.SOUND]), 1) for _ in range(rng.randrange(1, 14))]
        cuts = sorted(rng.sample(range(1, len(rows)), rng.randrange(0, len(rows)))) if len(rows) > 1 else []
        parts = [rows[a:b] for a, b in itertools.pairwise([0, *cuts, len(rows)])]
        found = [conv.ways(p) for p in parts]
        at = conv.states_between([w[:2] for w in found], 0, None)
        audit = "".join(w[2][4 * a + b] for w, a, b in zip(found, at, at[1:], strict=False)) + "I" * {0: 0, 1: 2, 2: 1, 3: 0}[at[-1]]
        assert audit == conv.search(rows, 0, None)[1]
        # Two steps of joining choose the same.
        half = len(found) // 2
        runs = [x for x in (found[:half], found[half:]) if x]
        upper = conv.states_between([conv.joined([w[:2] for w in run]) for run in runs], 0, None)
        below = [conv.states_between([w[:2] for w in run], a, b) for run, a, b in zip(runs, upper, upper[1:], strict=False)]
        assert [s for run in below for s in run[:-1]] + [below[-1][-1]] == at


def test_unreachable_states():
    rows = [("u", conv.SOUND, 1)] * 30
    assert conv.search(rows, 0, 1) is None
    assert conv.search(rows, 2, 0) is None
    assert conv.search(rows, 0, 0) == (120, "D" * 30)
    assert conv.search([], 0, None) == (0, "")


@pytest.mark.parametrize("piece", [1, 4, 64])
def test_repair(spark, piece):
    rng = random.Random(piece)
    rows = some_rows(rng, 25, 14)
    rows += rng.choices(rows, k=40)  # repeated rows, also with equal turns
    rows += [(7, t, ("user", "assistant")[t % 2], f"turn {t}." if t % 9 else "turn") for t in range(150)]  # most rows in one conversation
    df = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumns({"key": F.lit("clash"), "cost": F.lit(1), "audit": F.lit("x")})
    assert found(conv.digests(*conv.repair(df, piece=piece))) == expected(rows)


def test_very_long_text_and_hot_copies(spark):
    rows = [(1, 0, "user", "long " * 200_000 + "."), (1, 1, "assistant", "Yes.")] + [(2, 3, "user", "again.")] * 300
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = found(conv.digests(*conv.repair(df)))
    assert got == expected(rows)
    assert got[2]["audit"] == "K" + "D" * 299 + "I"


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conv.digests(*conv.repair(empty)).collect() == []
    assert conv.damage(empty).collect() == []


def test_query_over_damaged_rows(spark, tmp_path):
    from crawlweft.llm.queries import op13_conversations

    rng = random.Random(11)
    rows = list(dict.fromkeys(some_rows(rng, 60, 8)))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    damaged = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = {1: "", 2: re.sub("[.!?]", "", x)}.get(kind, x)
        damaged += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    nothing = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    want = {c: nothing for c, *_ in rows} | expected(damaged)
    assert found(op13_conversations(spark, str(tmp_path))) == want
