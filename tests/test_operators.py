import hashlib
import math
import re
from collections import Counter

import pytest
from helpers import record, records
from pyspark.sql import functions as F

from crawlweft.operators import groups, language, lookup, media_types, simhash, terms
from crawlweft.operators.default_rules import SECTIONS
from crawlweft.operators.staging import broadcast_if_small, write_stage
from crawlweft.sources import records as source


@pytest.fixture(scope="module")
def rules(spark):
    table = media_types.rules(spark, SECTIONS)
    known = table.filter("section = 'CommonMediaTypes'").select("value")
    return media_types.close_over_known_types(table, known).persist()


@pytest.mark.parametrize("known", [False, True])
def test_decision(spark, rules, known):
    expected = {
        "message/dummy": "yes",
        "pdf": "yes",
        "PDF": "yes",
        "text/plain": "yes",
        "application/vnd.ms-powerpoint.presentation.macroenabled.12": "yes" if known else "unknown",
        "audio/dummy": "no",
        "audio": "no",
        "application/vnd.adobe.air-application-installer-package+zip": "no",
        "application/octet-stream": "no",
        "dummy/dummy": "unknown",
        None: "no",
    }
    table = rules if known else media_types.rules(spark, SECTIONS)
    rows = spark.createDataFrame([(k,) for k in expected], "header_media_type string")
    got = {r["header_media_type"]: r["decision"] for r in media_types.decide(rows, table).collect()}
    assert got == expected


def test_common(spark, rules):
    expected = {
        "application/vnd.ms-excel": True,
        "application/vnd.ms-excel2": False,
        "Application/vnd.ms-excel": False,
        "application/octet-stream": True,
        None: False,
    }
    rows = spark.createDataFrame([(k,) for k in expected], "media_type string")
    got = {r["media_type"]: r["is_common_type"] for r in media_types.flag_common(rows, rules).collect()}
    assert got == expected


def members(spark, rules, *rows):
    return media_types.decide(source.typed(records(spark, *rows)), rules)


def test_rollup(spark, rules):
    rows = members(
        spark,
        rules,
        record("b", fetched="20", content_type="audio/x", original="a", content_length="7", googlebot_exclusion_reasons='["r"]'),
        record("a", fetched="10", content_type="image/x", content_length="5", content_language="DE"),
        record("c", fetched="30", content_type="text/plain; charset=l1", original="a"),
        record("d", fetched="40", content_type="text/html", original="a"),
        record("e", fetched="50", content_type=None),
        record("x", "f2", content_type="audio/x", fetched="1"),
        record("y", "f2", content_type=None, fetched="2"),
        record("z", "f3", original="a"),
        record("n", None),
    )
    got = {r["fingerprint"]: r.asDict() for r in groups.rollup(rows).collect()}
    assert set(got) == {"f1", "f2"}  # f3 has no original
    one = got["f1"]
    assert (one["item_name"], one["fetched_num"], one["n_records"], one["indexable"]) == ("e", 50.0, 5, True)
    assert (one["header_media_type"], one["header_charset"]) == ("text/plain", "l1")
    assert (one["base_url"], one["content_length"], one["header_language"]) == ("http://a.example/a", "5", "de")
    assert one["googlebot_blocked"] and not one["malformed"]
    assert (got["f2"]["indexable"], got["f2"]["header_media_type"]) == (False, "audio/x")


@pytest.mark.parametrize("part_rows", [1000, 10])
def test_pack_lists_keeps_hot_groups_whole(spark, rules, part_rows):
    """Also when the hot group has no original."""
    rows = [
        record(f"i{i}", "hot" if i % 3 == 0 else f"f{i}", original="x" if i % 3 == 0 else "self", fetched=str(1000 + i), url=f"http://a.example/{i % 7}/{i // 2}.html",
               last_modified=None if i % 2 else "1994-11-15T08:12:31Z")
        for i in range(300)
    ]
    typed = members(spark, rules, *rows)
    lists = groups.pack_lists(typed, part_rows=part_rows).collect()
    hot = [r for r in lists if r["fingerprint"] == "hot"]
    assert len({(r["fingerprint"], r["part"]) for r in lists}) == len(lists)
    if part_rows == 10:
        assert len(hot) > 5 and all(len(r["url"]) < 40 for r in hot)
    else:
        assert len(hot) == 1 and hot[0]["date_fetched"] == sorted(hot[0]["date_fetched"])
    assert len(lists) - len(hot) == 200
    want = [r for r in rows if r[2] == "hot"]
    assert sorted(u for r in hot for u in r["url"]) == sorted(r[5] for r in want)
    assert sum(len(r["date_modified"]) for r in hot) == sum(r[7] is not None for r in want)
    names = [n for r in hot for n in r["filename"]]
    assert sorted(names) == sorted({r[5].split("/", 3)[3] for r in want})  # a set over all parts


def test_grouped_records(spark):
    rows = records(spark, record("a", "f1"), record("b", "f1", original="a"), record("c", "f2"), record("d", None))
    fresh = rows.filter("item_name = 'a'")
    assert sorted(r["item_name"] for r in groups.grouped_records(rows, fresh).collect()) == ["a", "b"]
    assert sorted(r["item_name"] for r in groups.grouped_records(rows).collect()) == ["a", "b", "c"]


TEXTS = [
    (1, "en", "The cat and the dog. The end of THE story"),
    (2, "de", "Der Hund und die Katze über den Zaun"),
    (3, "en", "then there was the other thing"),
    (4, None, "12345 !!"),
    (5, "de", "und der das die"),
]


def grams(text):
    for word in re.findall(r"[^\W\d_]+", text):
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                if padded[i : i + n] != " ":
                    yield n, padded[i : i + n]


def test_profiles_and_detection_against_brute_force(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, lang string, text string")
    counts, totals = Counter(), Counter()
    for _, lang, text in TEXTS:
        if lang:
            for n, g in grams(text):
                counts[lang, n, g] += 1
                totals[lang, n] += 1
    profiles = language.train_profiles(docs, min_share=0.02).persist()
    got = {(r["lang"], r["n"], r["ngram"]): (r["count"], r["total"]) for r in profiles.collect()}
    want = {k: (c, totals[k[0], k[1]]) for k, c in counts.items() if c > 0.02 * totals[k[0], 1]}
    assert got == want and len(want) < len(counts)
    expected = {}
    for key, _, text in TEXTS:
        scores = {}
        for n, g in grams(text):
            if any((lang, n, g) in want for lang in ("de", "en")):
                for lang in ("de", "en"):
                    c, t = want.get((lang, n, g), (0, 1))
                    scores[lang] = scores.get(lang, 0) + math.log(0.5 / 10000 + c / t)
        if scores:
            expected[key] = max(sorted(scores), key=scores.get)
    found = {r["doc_id"]: r["detected"] for r in language.detect(docs, profiles).collect()}
    assert found == expected and 4 not in found and found[2] == "de" and found[1] == "en"


def test_detection_without_broadcast_agrees(spark, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "doc_id long, lang string, text string")
    profiles = write_stage(language.train_profiles(docs), "profiles")
    want = sorted(map(tuple, language.detect(docs, profiles).collect()))
    monkeypatch.setattr(language, "MAX_WEIGHT_BYTES", 0)
    merged = language.detect(docs, profiles)
    assert "ResolvedHint" not in merged._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, merged.collect())) == want


def test_detection_looks_frequent_words_up_whole(spark, monkeypatch):
    docs = spark.createDataFrame([*TEXTS, (9, None, "der die das the der die das"), (9, None, "and the")], "doc_id long, lang string, text string")
    profiles = write_stage(language.train_profiles(docs), "profiles")
    want = sorted(map(tuple, language.detect(docs, profiles).collect()))
    monkeypatch.setattr(language, "OFTEN", 2)
    found = language.detect(docs, profiles)
    assert found._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 4  # one by word
    assert sorted(map(tuple, found.collect())) == want


def test_detection_does_not_shuffle_ngrams(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, lang string, text string")
    profiles = write_stage(language.train_profiles(docs), "profiles")
    plan = language.detect(docs, profiles)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan


@pytest.mark.parametrize(
    "lang, analyzer",
    [("en", "english"), ("de-at", "german"), ("zh-cn", "chinese"), ("xx", "english"), (None, "english"), ("pt-br", "brazilian"),
     ("pt", "portuguese"), ("ja", "cjk"), ("e", "english")],
)
def test_analyzer_lookup(spark, lang, analyzer):
    row = spark.createDataFrame([(lang,)], "lang string")
    assert language.with_analyzer(row, F.col("lang"), language.analyzer_map(spark)).first()["analyzer"] == analyzer


def brute_simhash(words):
    votes = [0] * 64
    for w in words:
        h = int(hashlib.md5(w.encode()).hexdigest()[:16], 16)
        for i in range(64):
            votes[i] += 1 if h >> i & 1 else -1
    out = sum(1 << i for i in range(64) if votes[i] > 0)
    return out - (1 << 64) if out >= 1 << 63 else out


def test_simhash_against_brute_force(spark):
    texts = [(i, " ".join(f"w{(i * j) % 13}" for j in range(1, 40 + i))) for i in range(20)] + [(99, "?!")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r[0]: r[1] for r in simhash.similarity_hash(docs, word_hash=simhash.md5_hash).collect()}
    assert got == {k: brute_simhash(t.split()) for k, t in texts if k != 99}


def test_simhash_follows_the_language(spark):
    docs = spark.createDataFrame([(1, "漢字仮名 abc"), (2, "漢字仮名 abc"), (3, "one two")], "doc_id long, text string")
    tags = spark.createDataFrame([(1, "ja"), (2, "en"), (3, "ja")], "doc_id long, lang string")
    got = dict(map(tuple, simhash.similarity_hash_by_language(docs, tags, word_hash=simhash.md5_hash).collect()))
    assert got[1] == brute_simhash(["漢字", "字仮", "仮名", "ab", "bc"])
    assert got[2] == brute_simhash(["漢字仮名", "abc"])
    assert got[3] == brute_simhash(["one", "two"])


def test_near_copies_have_near_hashes(spark):
    base = [f"word{i}" for i in range(400)]
    texts = [(1, " ".join(base)), (2, " ".join(base[:-2] + ["x", "y"])), (3, " ".join(f"else{i}" for i in range(400)))]
    got = dict(map(tuple, simhash.similarity_hash(spark.createDataFrame(texts, "doc_id long, text string")).collect()))
    apart = lambda a, b: bin((got[a] ^ got[b]) & (2**64 - 1)).count("1")
    assert apart(1, 2) < 8 < apart(1, 3)


TOKEN_TEXTS = [(1, "The rain, the Rain in  Spain."), (2, "rain the rain"), (3, " "), (4, "über-rain 42")]


def test_term_vectors_against_brute_force(spark):
    docs = spark.createDataFrame(TOKEN_TEXTS, "doc_id long, text string")
    got = sorted(tuple(r) for r in terms.term_vectors(docs, "doc_id", "body", "text").collect())
    want = sorted(
        (k, "body", m.group().lower(), i, m.start(), m.end())
        for k, t in TOKEN_TEXTS
        for i, m in enumerate(re.finditer(r"[^\W_]+", t))
    )
    assert got == want


def test_term_vectors_of_long_texts_and_repeated_keys(spark):
    long = " ".join(f"word{i % 7}, {i}" for i in range(200))
    rows = [*TOKEN_TEXTS, (5, long), (6, "a b"), (6, "a b"), (7, None), (8, ""), (None, "c, d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = terms.term_vectors(docs, "doc_id", "body", "text")
    # Only documents that share a key meet a window.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Union") >= 1
    got = sorted(tuple(r)[2:] for r in found.filter("doc_id = 5").collect())
    assert got == sorted((m.group(), i, m.start(), m.end()) for i, m in enumerate(re.finditer(r"[^\W_]+", long)))
    got = sorted(tuple(r)[2:] for r in found.filter("doc_id = 6").collect())  # the pieces of both, by place
    assert got == [("a", 0, 0, 1), ("a", 1, 1, 2), ("b", 2, 4, 5), ("b", 3, 5, 6)]
    assert [tuple(r)[2:] for r in found.filter("doc_id IS NULL").orderBy("position").collect()] == [("c", 0, 0, 1), ("d", 1, 3, 4)]


def test_document_postings_agree_with_grouped_tokens(spark):
    rows = [*TOKEN_TEXTS, (6, "a b a"), (6, "b a"), (7, None), (8, ""), (None, "c d c"), (None, "c")]
    docs = spark.createDataFrame(rows, "id long, text string")
    want = terms.postings(terms.tokenize(docs, "id", "body", "text", "standard"), "id")
    got = terms.document_postings(docs, "id", "body", "text", "standard")
    key = lambda r: (str(r[0]), r[2])
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    # Tokens of documents with keys of their own are grouped in their row: only the others meet an aggregate.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("collect_list(position") == 1


def test_postings_and_dictionary(spark):
    docs = spark.createDataFrame(TOKEN_TEXTS, "id long, text string")
    tokens = terms.tokenize(docs.repartition(3, "id"), "id", "body", "text", "standard")
    posted = terms.postings(tokens, "id")
    assert posted._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # the repartition itself
    got = {(r["id"], r["term"]): (r["tf"], r["positions"]) for r in posted.collect()}
    assert got[1, "rain"] == (2, [1, 3]) and got[2, "rain"] == (2, [0, 2]) and got[4, "42"] == (1, [2])
    words = {r["term"]: (r["df"], r["cf"]) for r in terms.dictionary(posted).collect()}
    assert words["rain"] == (3, 5) and words["the"] == (2, 3)


def test_index_tokens(spark):
    docs = spark.createDataFrame(
        [("d", 0, "english", "The Rain", "the end", ["http://a.example/x", "http://b.example"], "text/html", ["en", "fr"], ["Jo Do", None])],
        "id string, part int, analyzer string, title string, body string, url array<string>, media_type string, language array<string>, authors array<string>",
    )
    stop = spark.createDataFrame([("english", "the"), ("german", "end")], "analyzer string, term string")
    rows = {}
    for r in terms.index_tokens(docs, stop).orderBy("field", "position").collect():
        rows.setdefault(r["field"], []).append((r["term"], r["position"]))
    assert rows == {
        "title": [("rain", 1)],
        "title.default": [("the", 0), ("rain", 1)],
        "title.bigram": [("the rain", 0)],
        "body": [("end", 1)],
        "body.default": [("the", 0), ("end", 1)],
        "body.bigram": [("the end", 0)],
        "url": [("a", 1), ("example", 2), ("x", 3), ("b", 105), ("example", 106)],
        "media_type": [("text/html", 0)],
        "language": [("en", 0), ("fr", 101)],
        "authors": [("jo", 0), ("do", 1)],
    }


def test_default_stop_words(spark):
    words = terms.default_stop_words(spark)
    assert words.filter("analyzer = 'german' AND term = 'und'").count() == 1
    assert words.filter("analyzer = 'english' AND term = 'the'").count() == 1
    assert words.filter("analyzer = 'brazilian' AND term = 'para'").count() == 1
    assert words.filter("term LIKE '%''%'").count() == 0


def test_phrases_stay_inside_values_and_parts(spark):
    long = " ".join(f"w{k}" for k in range(150))
    docs = spark.createDataFrame(
        [("d", 0, "english", [long, "beta gamma"], "alpha"), ("d", 1, "english", [], "beta")],
        "id string, part int, analyzer string, misc array<string>, body string",
    )
    rows = terms.index_tokens(docs, terms.default_stop_words(spark))
    assert lookup.phrase(rows, "misc", ["w149", "beta"]).count() == lookup.phrase(rows, "misc", ["w99", "beta"]).count() == 0
    assert lookup.phrase(rows, "misc", [f"w{k}" for k in range(150)]).count() == 1
    assert lookup.phrase(rows, "misc", ["beta", "gamma"]).collect() == [("d", 0, 250)]
    assert lookup.phrase(rows, "body.default", ["alpha", "beta"]).count() == 0
    posted = terms.postings(rows.filter("field = 'body.default'"))
    assert sorted((r["part"], r["term"]) for r in posted.collect()) == [(0, "alpha"), (1, "beta")]


def test_lookups(spark):
    docs = spark.createDataFrame(TOKEN_TEXTS + [(5, "a b a b a"), (6, "b a a b")], "id long, text string")
    tokens = terms.tokenize(docs, "id", "body", "text", "standard")
    found = lambda df: sorted(map(tuple, df.collect()))
    assert found(lookup.all_terms(tokens, "body", ["rain", "the"])) == [(1, 4), (2, 3)]
    assert lookup.query_terms(spark, "The RAIN, rain") == ["the", "rain", "rain"]
    assert found(lookup.all_terms(tokens, "body", lookup.query_terms(spark, "Rain THE"))) == [(1, 4), (2, 3)]
    counted = terms.count_terms(docs, "body", "text", "standard").collect()
    posted = terms.dictionary(terms.postings(tokens, "id")).collect()
    assert sorted(map(tuple, counted)) == sorted(map(tuple, posted))
    assert found(lookup.all_terms(tokens, "title", ["rain"], "id")) == []
    assert found(lookup.phrase(tokens, "body", ["the", "rain"], "id")) == [(1, 0), (1, 2), (2, 1)]
    assert found(lookup.phrase(tokens, "body", ["a", "b", "a"], "id")) == [(5, 0), (5, 2)]
    assert found(lookup.phrase(tokens, "body", ["a", "a"], "id")) == [(6, 1)]


def test_broadcast_only_after_counting(spark):
    df = spark.range(100)
    hint = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hint(broadcast_if_small(df, 100)) and not hint(broadcast_if_small(df, 99))
