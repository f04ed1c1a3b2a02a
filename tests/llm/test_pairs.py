"""Operators on pairs of documents, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from crawlweft.llm import fingerprints, ngram_join, substrings
from crawlweft.llm.components import components
from crawlweft.llm.texts import Spans

DOCS = "doc_id long, text string, n_words string, component int, cls string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], DOCS)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, ws, edits):
    ws = list(ws)
    for _ in range(edits):
        ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**6)}"
    return ws


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark, tmp_path):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000, k) for k in range(1001, 1200)] + [(k, k + 1) for k in range(2000, 2060)] + [(5, 5)]
    edges = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(edges, str(tmp_path / "some")).collect()}
    want = roots({x for e in links for x in e}, links)
    assert got == {n: r for n, r in want.items() if any(n in e and e[0] != e[1] for e in links)}
    assert components(edges.limit(0), str(tmp_path / "none")).count() == 0


def shingle_set(text, k):
    ws = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


@pytest.mark.parametrize(("k", "threshold"), [(4, (85, 100)), (5, (80, 100))])
def test_ngram_join(spark, k, threshold):
    rng = random.Random(k)
    rows = []
    for _ in range(60):
        base = prose(rng, rng.choice([2, 4, 7, 30, 120, 400]))
        rows.append(base)
        for _ in range(rng.choice([0, 0, 1, 3])):
            rows.append(edited(rng, base, rng.choice([0, 1, 1, 2, 4, 8])))
    hot = prose(rng, 150)
    rows += [edited(rng, hot, rng.choice([0, 1, 2, 3])) for _ in range(80)] + [hot] * 30  # one large group
    passage = prose(rng, 60)
    rows += [passage + prose(rng, rng.randint(5, 80)) for _ in range(40)]  # tokens that many share
    texts = [" ".join(x) for x in rows] + [None, "", "  ", "One", "one", "a b", "A  b", "NO ID"]
    rng.shuffle(texts)
    ids = [k * 3 for k in range(len(texts))]
    docs = documents(spark, [(None if t == "NO ID" else i, t) for i, t in zip(ids, texts, strict=True)] + [(ids[0], texts[0])])
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, words=k, threshold=threshold).collect()]
    sets = {i: shingle_set(t, k) for i, t in zip(ids, texts, strict=True) if t != "NO ID"}
    links = []
    keys = sorted(sets)
    for x, a in enumerate(keys):
        for b in keys[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and threshold[1] * both >= threshold[0] * len(sets[a] | sets[b]) and sets[b]:
                links.append((a, b))
    root = roots(keys, links)
    want = [(i, len(sets[i]), root[i]) for i in keys] + [(ids[0], len(sets[ids[0]]), root[ids[0]])] * (ids[0] in sets) + [(None, 1, None)]
    order = lambda rows: sorted(rows, key=str)
    assert order(got) == order(want)
    kept = ngram_join.drop_copies(docs, words=k, threshold=threshold)
    assert kept.columns == docs.columns
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == sorted({i for i in keys if root[i] == i})


def test_ngram_join_of_nothing(spark):
    assert ngram_join.jaccard_components(documents(spark, [])).count() == 0
    rows = ngram_join.jaccard_components(documents(spark, [(1, None), (2, "")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [(1, 0, 1), (2, 0, 2)]


def test_order_of_tokens_does_not_matter(spark):
    rng = random.Random(12)
    base = prose(rng, 200)
    docs = documents(spark, [(k, " ".join(edited(rng, base, k % 12))) for k in range(60)])
    flat = ngram_join.rarity(docs, "text", 5)
    assert flat.max() > 0  # frequent tokens are seen
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    sets = {k: shingle_set(r.text, 5) for k, r in enumerate(sorted(docs.collect(), key=lambda r: r.doc_id))}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert got == roots(sets, links)


def test_counts_hold_a_byte_a_place_and_are_exact():
    counts, rng = ngram_join._Counts(4 * ngram_join.CHUNK), np.random.default_rng(5)
    places = [np.concatenate((rng.integers(0, 4 * ngram_join.CHUNK, 5000), np.full(n, ngram_join.CHUNK + 7))).astype(np.uint64) for n in (3, 255, 70_000, 1)]
    for x in places:
        counts.add(x)
    assert counts.low.nbytes == 4 * ngram_join.CHUNK  # four times as much before
    got = np.concatenate([counts.chunk(k * ngram_join.CHUNK) for k in range(4)])
    assert (got == np.bincount(np.concatenate(places).astype(np.int64), minlength=len(got))).all()


def test_sliding_minima():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 50, 500).astype(np.uint64)
    for width in (1, 2, 46, 500):
        want = [values[k : k + width].min() for k in range(500 - width + 1)]
        assert substrings.sliding_minima(values, width).tolist() == want


def test_compact_windows_cover_every_passage():
    rng = np.random.default_rng(4)
    tokens = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    keys, first, last = substrings.compact_windows(tokens, 46)
    starts = np.zeros(len(tokens), int)
    for a, b in zip(first, last, strict=True):
        assert b - a >= 45
        starts[a : b - 44] += 1
    assert (starts[: 400 - 45] == 1).all()  # each passage lies in one window
    other = np.concatenate((rng.integers(1, 1 << 63, 30).astype(np.uint64), tokens[100:170], rng.integers(1, 1 << 63, 30).astype(np.uint64)))
    assert set(keys.tolist()) & set(substrings.compact_windows(other, 46)[0].tolist())


def covered(rows, length=50):
    """For each document, its words that lie in a run of `length` words of an earlier one."""
    seen, out = {}, {}
    for i, ws in sorted(rows.items()):
        mask = [False] * len(ws)
        for k in range(len(ws) - length + 1):
            if seen.get(tuple(ws[k : k + length]), i) < i:
                mask[k : k + length] = [True] * length
        for k in range(len(ws) - length + 1):
            seen.setdefault(tuple(ws[k : k + length]), i)
        out[i] = mask
    return out


def passage_rows(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n, 10**6) for n in (51, 60, 75, 120, 300)]
    rows = {}
    for k in range(120):
        ws = prose(rng, rng.randint(0, 60), 10**6)
        for _ in range(rng.choice([0, 0, 1, 2])):
            ws += (passages[rng.randrange(5)] if k % 3 else passages[0]) + prose(rng, rng.randint(1, 60), 10**6)
        rows[k] = ws
    return rows


def test_substrings(spark):
    rows = passage_rows(5)
    docs = documents(spark, [(i, " ".join(ws)) for i, ws in rows.items()] + [(500, None), (501, ""), (None, " ".join(rows[1]))])
    got = {r.doc_id: r for r in substrings.passage_report(docs).collect() if r.doc_id is not None}
    want = covered(rows)
    links = set()
    for i in rows:
        mask = [False] * len(rows[i])
        for a, b in got[i].spans:
            mask[a:b] = [True] * (b - a)
        assert all(m or not w for m, w in zip(mask, want[i], strict=True))  # every verbatim repeat is found
        assert not any(mask) or any(want[i])  # and only in documents that have one
        links |= {(lead, i) for lead in got[i].leaders}
    assert got[500].n_repeated == got[501].n_repeated == 0
    assert any(any(m) for m in want.values())
    root = roots(rows, links)
    assert {i: got[i].component_id for i in rows} == root


def test_near_passages(spark):
    rng = random.Random(6)
    passage = prose(rng, 150, 10**6)
    changed = list(passage)
    changed[70] = "other"
    docs = documents(spark, [(1, " ".join(prose(rng, 40, 10**6) + passage)), (2, " ".join(changed + prose(rng, 40, 10**6)))])
    (row,) = substrings.duplicate_passages(docs).collect()
    assert (row.doc_id, row.leader) == (2, 1)
    assert row.passages[0][0] == 0 and row.passages[-1][1] >= 140


def test_edited_passages_are_found(spark):
    rng = random.Random(16)
    rows, hashed, pairs = {}, {}, []
    for n, edits in ((52, 1), (55, 1), (60, 1), (60, 2), (80, 3)):
        for _ in range(60):
            passage = prose(rng, n, 10**6)
            a = len(rows)
            for copy in (passage, edited(rng, passage, edits)):
                ws = prose(rng, 60, 10**6) + copy + prose(rng, 60, 10**6)
                hashed[len(rows)] = Spans().shingles([w.encode() for w in ws], 5)
                rows[len(rows)] = " ".join(ws)
            if substrings.shared_passages(hashed[a + 1], hashed[a], 50, 5, 0.8):  # brute force: the whole texts
                pairs.append((a + 1, a))
    got = {(r.doc_id, r.leader) for r in substrings.duplicate_passages(documents(spark, rows.items())).collect()}
    assert len(pairs) > 250
    assert len(got & set(pairs)) >= 0.99 * len(pairs)
    assert got <= set(pairs)


@pytest.mark.parametrize("few", [substrings.FEW, 0])  # at once, or by the rounds alone
def test_leader_without_the_passage_hides_no_copy(spark, monkeypatch, few):
    monkeypatch.setattr(substrings, "FEW", few)
    rng = random.Random(17)
    rows, pairs, spans = {}, [], {}
    for k in range(60):
        other, passage = prose(rng, 60, 10**6), prose(rng, 50, 10**6)
        shared = other if k % 2 else []  # the leader shares another passage, or none
        for part in (passage[:45], passage, passage):
            spans[len(rows)] = [len(shared) + 30, len(shared) + 80]
            rows[len(rows)] = [*shared, *prose(rng, 30, 10**6), *part, *prose(rng, 30, 10**6)]
        pairs.append((3 * k + 2, 3 * k + 1))
    got = {(r.doc_id, r.leader): r.passages for r in substrings.duplicate_passages(documents(spark, [(i, " ".join(ws)) for i, ws in rows.items()])).collect()}
    assert set(pairs) <= set(got)
    assert all(spans[i] in got[i, lead] for i, lead in pairs)


@pytest.mark.parametrize("places", [substrings.PLACES, 8])  # at once, or dealt over blocks
def test_edited_passages_at_keys_of_many_documents(spark, monkeypatch, places):
    monkeypatch.setattr(substrings, "PLACES", places)
    rng = random.Random(31)
    rows = {}
    for _ in range(4):
        passage = prose(rng, 60, 10**6)  # edited so often that few documents share it, though all share its keys
        for _ in range(4 * substrings.FEW):
            rows[len(rows)] = prose(rng, 30, 10**6) + edited(rng, passage, 2) + prose(rng, 30, 10**6)
    hashed = {i: Spans().shingles([w.encode() for w in ws], 5) for i, ws in rows.items()}
    shared = {(i, j): substrings.shared_passages(hashed[i], hashed[j], 50, 5, 0.8) for i in rows for j in rows if j < i}  # brute force
    pairs = {x for x, found in shared.items() if found}
    got = {(r.doc_id, r.leader) for r in substrings.duplicate_passages(documents(spark, [(i, " ".join(ws)) for i, ws in rows.items()])).collect()}
    assert len(pairs) > 1000 and got <= pairs
    assert len(got) >= 0.97 * len(pairs)


@pytest.mark.parametrize("places", [substrings.PLACES, 8])
def test_words_that_the_leader_lacks(spark, monkeypatch, places):
    monkeypatch.setattr(substrings, "PLACES", places)
    rng = random.Random(32)
    rows = {}
    for _ in range(12):
        passage = prose(rng, 70, 10**6)
        for k in range(substrings.FEW + 4):
            rows[len(rows)] = prose(rng, 30, 10**6) + passage[0 if k else 1 : 70 if k else 69] + prose(rng, 30, 10**6)
    got = {r.doc_id: r.spans for r in substrings.passage_report(documents(spark, [(i, " ".join(ws)) for i, ws in rows.items()])).collect()}
    for i, mask in covered(rows).items():
        assert not any(mask) or [sum(mask)] == [b - a for a, b in got[i]]


def test_alike():
    rng = np.random.default_rng(33)
    ids = np.array([4, 4, 5, 6, 7, 7, 8, 9])
    mine = np.array([True, False, False, True, False, True, False, False])
    for least in (1, 3, 9, 40):
        tokens = [rng.integers(0, 40, rng.integers(0, 30)).astype(np.uint32) for _ in ids]
        is_open = [rng.random(len(x)) < 0.3 for x in tokens]
        want = set()
        for a, b in ((a, b) for a in np.flatnonzero(mine) for b in np.flatnonzero(~mine) if ids[a] != ids[b]):
            x, y = np.isin(tokens[a], tokens[b]), np.isin(tokens[b], tokens[a])
            if max(x.sum(), y.sum()) >= least and (x & is_open[a]).any():
                want.add((ids[a], ids[b]))
        row = np.repeat(np.arange(len(ids)), [len(x) for x in tokens])
        got = substrings.alike(ids, row, np.concatenate(tokens), np.concatenate(is_open), mine, least)
        assert set(map(tuple, got.tolist())) == want


def test_cut_passages(spark):
    rows = passage_rows(7)
    text = lambda ws: "Start. " + ", ".join(ws) + "!"
    docs = documents(spark, [(i, text(ws)) for i, ws in rows.items()] + [(500, None), (501, ""), (None, text(rows[1]))])
    cut = substrings.cut_passages(docs)
    assert cut.columns == docs.columns
    got = {r.doc_id: r.text for r in cut.collect()}
    left = {i: re.findall(r"[a-z0-9]+", lower(t)) for i, t in got.items() if t and i is not None}
    assert not any(any(m) for m in covered(left).values())
    gone = covered({i: ["start", *ws] for i, ws in rows.items()})
    for i, ws in rows.items():
        if not any(gone[i]):
            assert got[i] == text(ws)  # clean documents stay as they are
        elif i in left:
            assert [w for w, g in zip(["start", *ws], gone[i], strict=True) if not g][:1] == left[i][:1]
    assert got[500] is None and got[501] == "" and got[None] == text(rows[1])
    assert substrings.cut_passages(docs.limit(0)).count() == 0


def test_repeated_ids_and_long_texts_in_stretches(spark, monkeypatch):
    rng = random.Random(23)
    passage = prose(rng, 60, 10**6)
    first, second = " ".join(prose(rng, 20, 10**6) + passage), " ".join(passage + prose(rng, 30, 10**6))
    clean = " ".join(prose(rng, 70, 10**6))
    rows = [(1, first), (2, second), (2, None), (2, "short"), (2, clean), (2, second), (3, None)]
    docs = documents(spark, rows)
    got = sorted((r.doc_id, r.n_repeated, r.component_id) for r in substrings.passage_report(docs).collect())
    assert got == [(1, 0, 1), (2, 0, 1), (2, 0, 1), (2, 0, 1), (2, 60, 1), (2, 60, 1), (3, 0, 3)]
    texts = sorted((r.doc_id, r.text or "") for r in substrings.cut_passages(docs).collect())
    assert texts == sorted([(1, first), (2, ""), (2, "short"), (2, clean), (2, " ".join(second.split()[60:])), (2, " ".join(second.split()[60:])), (3, "")])
    tokens = Spans().shingles([w.encode() for w in prose(rng, 3000, 500)], 5)
    whole = substrings._anchored_windows(tokens, 46, 2, 1)
    monkeypatch.setattr(substrings, "_stretches", lambda tokens, width: ((at, tokens[at : at + 400 + width - 1]) for at in range(0, len(tokens) - width + 1, 400)))
    cut = substrings._anchored_windows(tokens, 46, 2, 1)
    spread = lambda w: {(k, i, a, b) for k, s, e, a, b in zip(*(x.tolist() for x in w), strict=True) for i in range(s, e - 44)}
    assert {x[:2] for x in spread(cut)} == {x[:2] for x in spread(whole)}


def test_copies_of_a_text_are_compared_once(spark, tmp_path):
    rng = random.Random(29)
    passage, own = prose(rng, 60, 10**6), prose(rng, 70, 10**6)
    rows = {3: prose(rng, 20, 10**6) + passage, 5: own + passage, 1: prose(rng, 49, 10**6)}
    rows |= {k: rows[5] for k in (8, 9, 12)} | {7: rows[1], 10: passage + prose(rng, 9, 10**6), 11: prose(rng, 90, 10**6)}
    docs = documents(spark, [(i, " ".join(ws)) for i, ws in rows.items()] + [(9, " ".join(rows[11])), (12, None)])
    source = docs.selectExpr("doc_id AS id", "xxhash64(text) AS tid", "cast(text AS binary) AS text").filter("text is not null")
    copies, told = substrings._copies(source, str(tmp_path))
    assert sorted((r.id, r.leader, r.n_words) for r in copies.collect()) == [(7, 1, 49), (8, 5, 130), (9, 5, 130), (11, 9, 90), (12, 5, 130)]
    moved = {r.id for r in substrings._windows(source, 50, 5, 2, 6, copies=told).collect()}
    assert moved == {3, 5, 9, 10}  # texts of 50 words or more, each under its smallest id
    got = {(r.doc_id, r.leader): sorted(map(list, r.passages)) for r in substrings.duplicate_passages(docs).collect()}
    assert got.keys() >= {(5, 3), (10, 3), *((k, x) for k in (8, 9, 12) for x in (3, 5)), (11, 9)}
    assert all(got[k, 5] == [[0, 130]] and got[k, 3] == got[5, 3] == [[70, 130]] for k in (8, 9, 12))
    assert got[11, 9] == [[0, 90]] and not any(7 in x or 1 in x for x in got)


def test_common_keys(spark):
    rng = random.Random(24)
    rows = {i: " ".join(prose(rng, 200, 10**6)) for i in range(40)}
    rows |= {100: rows[3] + " tail", 101: rows[3]}
    source = documents(spark, rows.items()).selectExpr("doc_id AS id", "cast(text AS binary) AS text").repartition(9)
    common = substrings.common_keys(source, 50, 5, 2, 6)
    every = substrings._windows(source, 50, 5, 2, 6).collect()
    ids = {}
    for r in every:
        ids.setdefault(r.key, set()).add(r.id)
    kept = {r.key for r in substrings._windows(source, 50, 5, 2, 6, common=common).collect()}
    assert {k for k, x in ids.items() if len(x) > 1} <= kept
    assert len(kept) < 0.35 * len(ids)


def test_common_keys_of_a_task_that_sends_in_parts(spark, monkeypatch):
    rng = random.Random(25)
    rows = {i: " ".join(prose(rng, 200, 10**6)) for i in range(40)}
    rows |= {100: rows[3] + " tail", 101: rows[39]}
    source = documents(spark, rows.items()).selectExpr("doc_id AS id", "cast(text AS binary) AS text").repartition(2)
    whole = substrings.common_keys(source, 50, 5, 2, 6).value.copy()
    monkeypatch.setattr(substrings, "HELD_KEYS", 97)  # no task holds more places than these
    assert (substrings.common_keys(source, 50, 5, 2, 6).value == whole).all() and whole.any()


def test_cut_words():
    assert substrings.cut_words("Aa bb, cc. Dd ee!", [[1, 3]]) == "Aa\n\nDd ee!"
    assert substrings.cut_words("é a b", [[0, 3]]) == ""


def paragraphs(text):
    return {x.strip(" ") for x in re.findall(fingerprints.PARAGRAPH, text)} - {""}


@pytest.mark.parametrize("sweeps", [fingerprints.SWEEPS, 1])  # one sweep leaves more tables to retry
def test_fingerprints(spark, monkeypatch, sweeps):
    monkeypatch.setattr(fingerprints.peel, "__defaults__", (sweeps,))
    rng = random.Random(8)
    texts = ["\n".join(" ".join(prose(rng, rng.randint(1, 30))) + rng.choice([".", "!", ""]) for _ in range(rng.randint(0, 25))) for _ in range(60)]
    texts += ["", None, "x", "é\U0001f600" * 500, "same", "same", "...", " | " * 9]
    ids = rng.sample(range(-5000, 10**12, 7), len(texts))
    rows = dict(zip(ids, texts, strict=True))
    docs = documents(spark, [*rows.items(), (None, "no place"), (ids[0], texts[0])])
    got = {r.doc_id: r for r in fingerprints.fingerprint_versions(docs).collect()}
    order = sorted(rows, reverse=True)
    assert sorted(got) == sorted(rows)
    for k, i in enumerate(order):
        t, n = rows[i] or "", rows[order[(k + 1) % len(order)]] or ""
        third = len(t) // 3
        e = t[: len(t) - third] + n[:third]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert r.near_edited == pytest.approx(near(paragraphs(t), paragraphs(e)))
        assert r.near_next == pytest.approx(near(paragraphs(t), paragraphs(n)))
        assert (r.fingerprint == r.edited_fingerprint) == (paragraphs(t) == paragraphs(e))
    prints = {}
    for i, t in rows.items():
        prints.setdefault(t or "", set()).add(got[i].fingerprint)
    assert all(len(x) == 1 for x in prints.values())


def test_fingerprints_of_few(spark):
    assert fingerprints.fingerprint_versions(documents(spark, [])).count() == 0
    (row,) = fingerprints.fingerprint_versions(documents(spark, [(3, "a\nb\nc")])).collect()
    assert (row.near_next, row.n_chars) == (1.0, 5)


def test_following(spark):
    rng = random.Random(9)
    ids = sorted({rng.choice([rng.randrange(50), rng.randrange(10**6), -rng.randrange(10**15), rng.randrange(1 << 62)]) for _ in range(300)}, reverse=True)
    got = {r["id"]: r["next"] for r in fingerprints.following(spark.createDataFrame([(i,) for i in ids], "id long")).collect()}
    assert got == {a: b for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_blocks_of_large_groups(spark, monkeypatch):
    """Groups dealt over several blocks, some linked throughout and some just below the threshold."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(21)
    loose, tight = prose(rng, 200), prose(rng, 160)
    rows = [edited(rng, loose, rng.randint(2, 6)) for _ in range(90)]  # look alike, few link
    rows += [edited(rng, tight, rng.randint(0, 2)) for _ in range(60)]  # a component of many blocks
    rows += [tight[:120] + prose(rng, n) for n in (5, 10, 20, 30, 40)] + [prose(rng, 100) for _ in range(20)]
    texts = [" ".join(x) for x in rows]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(documents(spark, list(enumerate(texts)))).collect()}
    sets = {k: shingle_set(t, 5) for k, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert got == roots(sets, links)


def test_common_tokens_and_forest():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (1, 40, 3000, 6000, 6000)]
    want = [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets]
    assert ngram_join.common_tokens(sets, sets[2:]).tolist() == want
    assert ngram_join.common_tokens(sets[:1], sets[1:2]).shape == (1, 1)
    near = rng.random((60, 60)) < 0.02
    near |= near.T
    links = list(zip(*np.nonzero(near), strict=True))
    edges = ngram_join.forest(near)
    assert len(edges) < 60 and roots(range(60), edges) == roots(range(60), links)
