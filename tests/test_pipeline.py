import os
import re

import pytest
from helpers import record, records
from pyspark.sql import functions as F

from crawlweft import schemas
from crawlweft.operators import language, media_types
from crawlweft.operators.default_rules import SECTIONS
from crawlweft.operators.staging import write_stage
from crawlweft.plans.pipeline import build_documents
from crawlweft.sources import records as source
from crawlweft.streaming import ingest

PAGE = """<html lang="en"><head><title>The title</title><meta name="author" content="Jo"><meta name="keywords" content="k">
<meta name="last-modified" content="2001-02-03T04:05:06Z"></head>
<body><p>the story of the thing and the other</p><a href="/next">go</a> jo@a.example http://b.example/x.</body></html>"""


@pytest.fixture(scope="module")
def parts(spark):
    docs = spark.createDataFrame(
        [("en", "the story of the thing and the other there then"), ("de", "der die das und nicht ein wort über den zaun")],
        "lang string, text string",
    )
    return {
        "rule_table": media_types.rules(spark, SECTIONS),
        "profiles": write_stage(language.train_profiles(docs), "profiles"),
        "analyzers": language.analyzer_map(spark),
    }


def bodies(spark, **content):
    return spark.createDataFrame(list(content.items()), schemas.BODY)


def test_one_document(spark, parts):
    rows = records(
        spark,
        record("?www.a.example/p.html/", fetched="1366200000.25", content_length="10", content_language="FR", discovered="1366100000"),
        record(
            "copy", original="x", fetched="1366200060", googlebot_exclusion_reasons='["robots"]',
            content_disposition='attachment; filename="p.doc"', last_modified="Tue, 15 Nov 1994 08:12:31 GMT",
        ),
    )
    body = spark.createDataFrame([("www.a.example/p.html", PAGE)], schemas.BODY)
    documents, rejects, _ = build_documents(rows, body, **parts)
    assert documents.schema.names == [*schemas.TEXT_DOCUMENT.names, "version"]
    (doc,) = [r.asDict() for r in documents.collect()]
    assert rejects.count() == 0
    text = "the story of the thing and the other\ngo jo@a.example http://b.example/x."
    assert (doc["id"], doc["part"], doc["title"], doc["body"]) == ("f1", 0, "The title", text)
    assert doc["url"] == ["http://a.example/?www.a.example/p.html/", "http://a.example/copy"]
    assert doc["filename"] == ["p.doc"]
    assert doc["out_links"] == ["http://a.example/next", "http://b.example/x"]
    assert doc["email_addresses"] == ["jo@a.example"]
    assert doc["language"] == ["en", "fr"] and doc["analyzer"] == "english"
    assert doc["authors"] == ["Jo", None, None, None] and doc["misc"] == [None, None, None, "k"]
    assert (doc["media_type"], doc["charset"], doc["googlebot_blocked"]) == ("text/html", "utf-8", True)
    assert (doc["text_length"], doc["size"]) == (len(text), len(PAGE)) and doc["is_common_type"]
    assert [d.isoformat() for d in doc["date_modified"]] == ["1994-11-15T08:12:31", "2001-02-03T04:05:06"]
    assert [d.isoformat() for d in doc["date_discovered"]] == ["2013-04-16T08:13:20", "2013-04-17T12:01:00"]
    assert doc["date_created"] == [] and doc["similarity_hash_digest"] != 0


def test_every_way_to_fail(spark, parts):
    rows = records(
        spark,
        record("ok", "f1"),
        record("gone", "f2"),
        record("sound", "f3", content_type="audio/x", content_length="77"),
        record("odd", "f4", content_type="dummy/x"),
        record("bad", "f5", googlebot_exclusion_reasons="bad"),
        record("nowhere", "f6", url=None),
        record("sheet", "f7", content_type="application/doc"),
        record("digits", "f8", content_type="text/plain", content_language="SV"),
        record("blank", "f9", content_type="text/plain"),
        record("lonely", "f10", original="x"),
    )
    body = bodies(spark, ok=PAGE, sheet="...", digits=" 12 345 ", blank=" \n", bad=PAGE, nowhere=PAGE)
    documents, rejects, _ = build_documents(rows, body, **parts)
    docs = {r["id"]: r for r in documents.collect()}
    assert set(docs) == {"f1", "f3", "f4", "f7", "f8", "f9"}
    assert {(r["item_name"], r["stage"], r["reason"]) for r in rejects.collect()} == {
        ("gone", "body", "no body stored"),
        ("odd", "media_type", "unknown media type"),
        ("bad", "attributes", "malformed exclusion reasons"),
        ("nowhere", "validity", "no address"),
        ("sheet", "parse", "unsupported media type"),
        ("digits", "language", "no language detected"),
    }
    assert (docs["f3"]["analyzer"], docs["f3"]["size"], docs["f3"]["body"]) == (None, 77, None)
    assert docs["f7"]["analyzer"] is None and docs["f7"]["authors"] is None
    assert (docs["f8"]["body"], docs["f8"]["language"], docs["f8"]["analyzer"]) == ("12 345", ["sv"], "swedish")
    assert docs["f8"]["similarity_hash_digest"] != 0 and docs["f8"]["size"] == 8
    assert (docs["f9"]["body"], docs["f9"]["text_length"], docs["f9"]["similarity_hash_digest"]) == ("", 0, 0)
    assert docs["f9"]["analyzer"] == "english" and docs["f9"]["language"] == []


def test_bodies_as_bytes(spark, parts):
    rows = records(
        spark,
        record("k", "f1", content_type="text/plain; charset=windows-1252"),
        record("x", "f2", content_type="text/plain; charset=x-unheard-of"),
    )
    body = spark.createDataFrame([("k", bytearray("der zaun ist grün €".encode("cp1252"))), ("x", bytearray(b"abc"))], "content_key string, bytes binary")
    documents, rejects, _ = build_documents(rows, body, **parts)
    docs = {r["id"]: r for r in documents.collect()}
    assert (docs["f1"]["body"], docs["f1"]["size"], docs["f1"]["charset"]) == ("der zaun ist grün €", 19, "windows-1252")
    assert docs["f2"]["body"] is None
    assert [(r["item_name"], r["stage"], r["reason"]) for r in rejects.collect()] == [("x", "parse", "charset")]


def test_a_hot_group_is_whole_over_its_parts(spark, parts):
    hot = [record(f"h{i}", "hot", fetched=str(1000 + i), original="self" if i == 0 else "h0") for i in range(120)]
    cold = [record(f"c{i}", f"f{i}", content_type="audio/x") for i in range(60)]
    documents, _, _ = build_documents(records(spark, *hot, *cold), bodies(spark, h0=PAGE), part_rows=10, **parts)
    rows = documents.filter("id = 'hot'").collect()
    assert len(rows) > 5 and len({r["part"] for r in rows}) == len(rows)
    assert sorted(u for r in rows for u in r["url"]) == sorted(r[5] for r in hot)
    assert [r["title"] for r in rows if r["part"] == 0] == ["The title"]
    assert all(r["title"] is None and r["language"] == [] for r in rows if r["part"] > 0)
    assert documents.filter("id <> 'hot'").count() == 60


def test_stream_matches_batch_and_survives_a_repeated_batch(spark, parts, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    first = [record("a", "f1", fetched="100"), record("b", "f2", fetched="200"), record("a2", "f1", fetched="150", original="a")]
    second = [record("c", "f1", fetched="300"), record("late", "f3", fetched="200"), record("d", "f4", fetched="400")]
    body = bodies(spark, a=PAGE, b="<html><p>der zaun", c=PAGE, d="<html><p>the end", late=PAGE)

    def build(fresh):
        return build_documents(source.read_records(spark, folder), body, fresh=fresh, **parts)

    def drain():
        ingest.start(spark, folder, target, build, poll=None).awaitTermination()

    def state():
        docs = {r["id"]: (sorted(r["url"]), r["version"]) for r in ingest.current_documents(spark, target).collect()}
        return docs, sorted((r["item_name"], r["stage"]) for r in ingest.rejects(spark, target).collect())

    records(spark, *first).coalesce(1).write.parquet(folder)
    stages = os.path.join(spark.conf.get("spark.checkpoint.dir"), "crawlweft")
    runs = lambda: [d for d in os.listdir(stages) if d.startswith("run-")]
    before = runs()
    drain()
    assert runs() == before  # a batch leaves no stages behind
    assert ingest.saved_mark(spark, target) == 200.0
    assert state()[0] == {
        "f1": (["http://a.example/a", "http://a.example/a2"], 100.0),
        "f2": (["http://a.example/b"], 200.0),
    }
    records(spark, *second).coalesce(1).write.mode("append").parquet(folder)
    drain()
    expected = (
        {
            "f1": (["http://a.example/a", "http://a.example/a2", "http://a.example/c"], 300.0),
            "f2": (["http://a.example/b"], 200.0),
            "f4": (["http://a.example/d"], 400.0),
        },
        [("late", "late")],
    )
    assert state() == expected and ingest.saved_mark(spark, target) == 400.0
    drain()  # nothing new
    assert state() == expected
    # A batch whose outputs were written but not committed is run again with the same rows.
    ingest.run_batch(records(spark, *second), 1, target, build)
    assert state() == expected and ingest.saved_mark(spark, target) == 400.0


def test_documents_are_joined_by_part(spark, parts):
    """No join after the lists are packed may key on the fingerprint alone: that would undo the spreading."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents, _, _ = build_documents(records(spark, record("a")), bodies(spark, a=PAGE), **parts)
        plan = documents._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and "part#" in line]
    assert len(joins) == 3 and all(re.search(r"\[fingerprint#\d+, part#\d+\], \[fingerprint#\d+, part#\d+\]", j) for j in joins)
    assert documents.select(F.col("id")).count() == 1
