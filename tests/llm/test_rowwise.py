"""Operators that judge each document by itself, against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlweft.llm import decontaminate, language_id, licences, packing, quality, toxicity
from crawlweft.llm.queries import VOCABULARY_JSON, VOCABULARY_PATTERN, VOCABULARY_RANKS
from crawlweft.llm.samples import labelled_texts
from crawlweft.llm.texts import Spans, spaced_words, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_words string, label int"  # clashing names beside the two that count


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return WORD.findall(lower(text))


def documents(spark, texts, first=0):
    return spark.createDataFrame([(None if t == "NO ID" else k, t, "x", 1) for k, t in enumerate(texts, first)], DOCS)


ODD = [None, "", " \n\t", "Äé Ü b", "a" * 3000, "x y " * 40000, "NO ID", "end of line", "\U0001f600 A1b_c-d", "A\x00B"]


@pytest.mark.parametrize("text", [t for t in ODD if t])
def test_words(text):
    assert [w.decode() for w in words(text.encode())] == plain_words(text)
    assert [w.decode() for w in spaced_words(text.encode())] == re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def test_shingles():
    spans = Spans(keep=64)  # so that longer texts take the other way
    rng = random.Random(1)
    ws = [rng.choice([b"a", b"bb", b"ccc", "é".encode()]) for _ in range(300)]
    for k in (1, 3, 5):
        got = spans.shingles(ws, k)
        runs = [tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)]
        assert len(got) == len(runs)
        assert len(set(got.tolist())) == len(set(runs))
        assert len({(r, h) for r, h in zip(runs, got.tolist(), strict=True)}) == len(set(runs))
    assert len(spans.shingles(ws[:2], 5)) == 1
    assert spans.shingles(ws[:2], 5)[0] != spans.shingles(ws[:3], 5)[0]
    assert len(spans.shingles([], 5)) == 0


def hit(text, items, window=10):
    ws, mask, found = plain_words(text), [False] * len(plain_words(text)), set()
    for item, t in items:
        if item is None:
            continue
        iw = plain_words(t)
        for k in range(max(1, len(iw) - window + 1) if iw else 0):
            w = iw[k : k + window]
            for at in range(len(ws) - len(w) + 1):
                if ws[at : at + len(w)] == w:
                    found.add(str(item))
                    mask[at : at + len(w)] = [True] * len(w)
    return len(ws), sum(mask), sorted(found)


@pytest.mark.parametrize("block_bytes", [10**6, 60])
def test_decontamination(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    rng = random.Random(2)
    some = lambda n: " ".join(rng.choice(["alpha", "beta", "Gamma", "x", "y", "ünï", "7"]) for _ in range(n))
    items = [(k, some(rng.choice([1, 2, 9, 10, 11, 25]))) for k in range(12)] + [(12, None), (13, ""), (None, "alpha beta"), (3, "repeated id words"), (14, "x")]
    texts = [some(rng.randint(0, 60)) for _ in range(60)] + ODD
    texts += [f"{some(3)}, {items[k][1]}! {some(4)}" for k in range(12)] + [items[5][1]] * 3
    docs = documents(spark, texts).unionByName(documents(spark, texts[:5]))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated, r.n_items) for r in decontaminate.search_items(docs, bench).collect() if r.doc_id is not None)
    want = []
    for k, t in [*enumerate(texts), *enumerate(texts[:5])]:
        if t != "NO ID":
            n, h, ids = hit(t, items)
            want.append((k, n, h, ids, h > 0, len(ids)))
    assert got == sorted(want)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(w[0] for w in want if not w[4])


def test_decontamination_of_nothing(spark):
    none = documents(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.search_items(none, bench).count() == 0
    rows = decontaminate.search_items(documents(spark, ["a b"]), bench).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in rows] == [(2, 0, False)]


def test_packing(spark):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(VOCABULARY_JSON)
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["word", "другой", "日本", "Ünïcode", "x1", "\n"]) for _ in range(rng.choice([0, 3, 50, 400, 2000]))) for _ in range(80)]
    texts += [t for t in ODD if t != "NO ID"] + ["a <|endoftext|> b", texts[0], texts[0]]
    docs = documents(spark, texts).coalesce(2)
    rows = packing.pack(docs, VOCABULARY_JSON, VOCABULARY_RANKS, VOCABULARY_PATTERN, shelf_tokens=30_000, with_ids=True).collect()
    ids = {k: [*exact.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    of_doc, of_sequence, groups = {}, {}, {}
    for r in rows:
        of_doc.setdefault(r.doc_id, []).append(r)
        of_sequence.setdefault(r.sequence_id, []).append(r)
        groups.setdefault(r.step_group, set()).add(r.sequence_length)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert r.length == len(r.ids)
    for doc, want in ids.items():
        pieces = sorted(of_doc[doc], key=lambda r: r.start)
        assert [x for r in pieces for x in r.ids] == want
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        assert {r.doc_tokens for r in pieces} == {len(want)}
    for pieces in of_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        total = sum(r.length for r in pieces)
        assert {r.sequence_length for r in pieces} == {total}
        assert total <= 2048 and total & (total - 1) == 0  # nothing is padded
    assert all(len(lengths) == 1 for lengths in groups.values())
    assert packing.pack(documents(spark, []), VOCABULARY_JSON, VOCABULARY_RANKS, VOCABULARY_PATTERN).count() == 0


def test_steps_are_balanced():
    rng = random.Random(4)
    shelf = packing.Shelf([rng.randint(1, 5000) for _ in range(2000)])
    cost, tokens = {}, {}
    for (tier, pieces), step in zip(shelf.windows, shelf.steps(), strict=True):
        if tier == 2048:
            cost[step] = cost.get(step, 0) + sum(n * n for _, _, n in pieces)
            tokens[step] = tokens.get(step, 0) + tier
    assert max(cost.values()) < 1.2 * min(cost.values())
    assert max(tokens.values()) - min(tokens.values()) <= 2048


def places(text, phrase):
    ws, ps = plain_words(text), phrase.split()
    return [k for k in range(len(ws) - len(ps) + 1) if ws[k : k + len(ps)] == ps]


def test_licences(spark):
    rng = random.Random(5)
    vocabulary = ["cc", "by", "CC", "By", "general", "public", "License", "all", "rights", "reserved", "nc", "x", "é"]
    texts = [", ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80))) for _ in range(200)] + ODD + ["cc by cc by", "All rights reserved. CC-BY"]
    got = {r.doc_id: r for r in licences.scan_licences(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        if t == "NO ID":
            continue
        starts = sorted(at for phrase in licences.BASE for at in places(t, phrase))
        labels = sorted({label for phrase, label in licences.BASE.items() if places(t, phrase)})
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(plain_words(t)), len(starts), starts[0] if starts else None, starts[-1] if starts else None, labels)
        assert set(labels) <= set(r.labels) and 0 <= r.score <= 1
    assert licences.scan_licences(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("line", "postfix", "freedom"),
    [
        ("MIT", "MIT", 0.9),
        ("MIT OR GPL-2.0-only AND BSD-3-Clause", "MIT GPL-2.0-only BSD-3-Clause AND OR", 0.9),
        ("(MIT or GPL-2.0) and BSD-3-Clause", "MIT GPL-2.0 or BSD-3-Clause and".upper(), 0.9),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0 AND MIT", "GPL-2.0-or-later Classpath-exception-2.0 WITH MIT AND", 0.5),
        ("MIT the rest of a line", "MIT", 0.9),
        ("(MIT AND (GPL-3.0 OR", "MIT GPL-3.0 AND", 0.4),
        ("MIT) OR X", "MIT", 0.9),
        ("AND MIT", None, None),
        ("", None, None),
    ],
)
def test_expressions(line, postfix, freedom):
    parsed = licences.parse_expression(line)
    if postfix is None:
        assert parsed is None
    else:
        assert [x.upper() for x in parsed.postfix] == postfix.upper().split()
        assert parsed.freedom == pytest.approx(freedom)


def test_tags(spark):
    texts = ["// SPDX-License-Identifier: (MIT OR Apache-2.0) */\ncode", "License expression: GPL-2.0-only WITH Classpath-exception-2.0"]
    first, second = sorted(licences.scan_licences(documents(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert (first.labels, first.expressions) == (["apache", "mit"], ["MIT Apache-2.0 OR"])
    assert (second.labels, second.score) == (["gpl"], pytest.approx(0.5))


def prose(rng, stems, n):
    return " ".join(rng.choice(stems) + rng.choice(stems) for _ in range(n))


def test_language(spark):
    rng = random.Random(6)
    stems = {"aa": ["tor", "mel", "wig", "dun"], "bb": ["pli", "qua", "zer", "oni"], "cc": ["жук", "мир", "лес", "дом"]}
    rows = [(g, prose(rng, s, rng.randint(20, 200))) for g, s in stems.items() for _ in range(40)]
    train = spark.createDataFrame([*rows[::2], (None, "no language"), ("dd", None)], "lang string, text string")
    dictionaries = language_id.train_dictionaries(train)
    assert sorted(dictionaries) == ["aa", "bb", "cc"]
    texts = [t for _, t in rows] + [None, "", "12 34 !?", "x"]
    got = {r.doc_id: r for r in language_id.identify(documents(spark, texts), dictionaries).collect()}
    assert [got[k].lang_pred for k in range(len(rows))] == [g for g, _ in rows]
    assert [got[k].lang_pred for k in range(len(rows), len(rows) + 3)] == ["und"] * 3
    assert got[len(rows) + 3].lang_pred in dictionaries
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language_id.identify(documents(spark, ["abc"]), {}).collect()} == {"und"}
    assert language_id.train_dictionaries(train.limit(0)) == {}


def test_copies_displace_no_text_of_the_samples(spark):
    rng = random.Random(16)
    copy = prose(rng, ["pli", "qua"], 50)
    texts = [f"{k} {prose(rng, ['tor', 'mel', 'wig'], 50)}" for k in range(30)]
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 30, F.element_at(F.array(*map(F.lit, texts)), (F.col("id") + 1).cast("int"))).otherwise(copy).alias("text"))
    (dictionary,) = language_id.train_dictionaries(rows.withColumn("lang", F.lit("aa"))).values()
    assert all(language_id._form(t).encode() in dictionary for t in [*texts, copy])
    found, counts = labelled_texts(rows, rows.select("doc_id", F.lit(1).alias("toxic")), "toxic", {1: 100, 0: 100})
    assert (sorted(found[1]), counts) == (sorted([*texts, copy]), {1: 40_000, 0: 0})


def test_toxicity(spark):
    rng = random.Random(7)
    stems = ["tor", "mel", "wig", "dun", "pli", "qua", "zer", "oni"]
    rows = []
    for k in range(400):
        ws = prose(rng, stems, rng.randint(60, 200)).split()
        if k % 4 == 0:
            for at in range(0, len(ws), 25):
                ws[at] = rng.choice(["grumblefuzz", "snarkbile", "vileblot"])
        rows.append((k, " ".join(ws), int(k % 4 == 0)))
    docs = documents(spark, [t for _, t, _ in rows] + [None, ""])
    labels = spark.createDataFrame([(k, y, None) for k, _, y in rows if k < 300] + [(None, 1, 1), (7, None, 1)], "doc_id long, toxic int, text string")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    rest = [(got[k].predicted, y) for k, _, y in rows if k >= 300]
    assert sum(p == y for p, y in rest) >= 0.97 * len(rest)
    assert got[400].predicted == got[401].predicted == 0
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.score < 0.5}
    assert toxicity.train(docs, labels.limit(0)) is None
    assert [r.score for r in toxicity.score_toxicity(docs, None).limit(1).collect()] == [0.0]


def test_rare_toxic_words_count(spark):
    rng = random.Random(18)
    stems = ["tor", "mel", "wig", "dun", "pli", "qua", "zer", "oni"]
    marks = ["".join(rng.choice("bcdfghjk") + rng.choice("aeiou") for _ in range(5)) + "x" for _ in range(60)]
    rows = []
    for k in range(2400):
        ws = prose(rng, stems, rng.randint(60, 200)).split()
        if k % 3 == 0:
            for at in range(0, len(ws), 40):
                ws[at] = rng.choice(marks)  # each in about 5 % of toxic texts
        rows.append((k, " ".join(ws), int(k % 3 == 0)))
    docs = documents(spark, [t for _, t, _ in rows])
    model = toxicity.train(docs, spark.createDataFrame([(k, y) for k, _, y in rows if k < 1800], "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum(got[k] == y for k, _, y in rows if k >= 1800) >= 0.95 * 600
    assert sum(got[k] for k, _, y in rows if k >= 1800 and y) >= 0.95 * 200


def test_toxic_phrases_of_usual_words_count(spark):
    rng = random.Random(19)
    stems = ["tor", "mel", "wig", "dun", "pli", "qua", "zer", "oni"]
    phrases = [prose(rng, stems, 12).split() for _ in range(4)]
    rows = []
    for k in range(1200):
        ws = prose(rng, stems, rng.randint(60, 200)).split()
        for at in range(0, len(ws) - 12, 30):
            phrase = list(rng.choice(phrases))
            if k % 3:
                rng.shuffle(phrase)  # the same words in ordinary texts, in another order
            ws[at : at + 12] = phrase
        rows.append((k, " ".join(ws), int(k % 3 == 0)))
    docs = documents(spark, [t for _, t, _ in rows])
    model = toxicity.train(docs, spark.createDataFrame([(k, y) for k, _, y in rows if k < 900], "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum(got[k] == y for k, _, y in rows if k >= 900) >= 0.95 * 300


def test_quality(spark):
    rng = random.Random(8)
    stems = ["tor", "mel", "wig", "dun", "pli", "qua", "zer", "oni"]
    texts = []
    for k in range(1500):
        t = prose(rng, stems, rng.randint(30, 200)).capitalize() + "."
        if k % 5 == 0:
            t = rng.choice([t.upper() + "!!", " | ".join(t.split()), " ".join([t.split()[0]] * 90)])
        texts.append(t)
    docs = documents(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(0, 1500, 2)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert 0.7 < model.prior < 0.9
    got = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert sum(got[k].predicted == int(k % 5 > 0) for k in range(1, 1500, 2)) >= 0.96 * 750
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == 1502
    assert quality.train(docs, labels.filter("quality = 0")) is None


def test_prior():
    rng = np.random.default_rng(9)
    good, bad = rng.normal(3, 1, 4000), rng.normal(-3, 1, 1500)
    assert quality.estimate_prior(good[:1000], np.r_[good[1000:], bad]) == pytest.approx(3000 / 4500, abs=0.05)


def test_fit_ignores_held_out_rows(spark):
    from crawlweft.llm.samples import learnable

    ids = spark.range(50).select(F.col("id").alias("doc_id"))
    got = {r.doc_id for r in ids.filter(learnable("doc_id", 3, 1)).collect()}
    assert got == {k for k in range(50) if zlib.crc32(str(k).encode()) % 3 != 1}
