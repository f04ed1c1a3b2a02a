"""Archives: exact round trips."""

import base64
import gzip
import hashlib
import random
import zlib

import pytest

from crawlweft.llm import warc

PAGES = "page_id long, url string, html string, record_type string, salt int"


def test_round_trip(spark, tmp_path):
    rng = random.Random(1)
    htmls = [rng.choice(["<p>", "é", "\r\n\r\n", "WARC/1.1\r\n", "x" * 5000, "\n"]) * rng.randint(1, 50) for _ in range(50)] + [None, "", "", "same", "same", "same"]
    rows = [(k, f"http://a/{k}\r\nX: y" if k % 7 else None, h, "zz", 3) for k, h in enumerate(htmls)]
    pages = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r for r in warc.round_trip(pages, folder=str(tmp_path)).collect()}
    best = {}
    for k, h in enumerate(htmls):
        best[h or ""] = k
    assert sorted(got) == list(range(len(htmls)))
    for k, h in enumerate(htmls):
        raw = (h or "").encode()
        r = got[k]
        refers = best[h or ""] if best[h or ""] != k else None
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == ("revisit" if refers is not None else "response", refers)


def test_small_payloads_are_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.round_trip(pages, least_bytes=4, folder=str(tmp_path)).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_no_pages_and_no_ids(spark, tmp_path):
    pages = spark.createDataFrame([(None, None, "a"), (None, "u", "a"), (5, "u", "a"), (5, "u", "a")], "page_id long, url string, html string")
    got = [(r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(pages, folder=str(tmp_path / "some")).collect()]
    assert sorted(got, key=str) == sorted([(None, "response", None)] * 2 + [(5, "response", None)] * 2, key=str)
    assert warc.round_trip(pages.limit(0), folder=str(tmp_path / "none")).count() == 0


def test_normalised_archives(spark, tmp_path):
    pages = spark.createDataFrame([(k, "http://a", f"page {k} " * k) for k in range(40)], "page_id long, url string, html string")
    warc.write_monolithic(warc.records(pages.coalesce(1)), str(tmp_path / "one"))
    (source,) = (tmp_path / "one").glob("*.gz")
    whole = gzip.decompress(source.read_bytes())
    assert b"\x1f\x8b" not in source.read_bytes()[2:20]
    index = warc.normalise(spark, str(tmp_path / "one"), str(tmp_path / "many"))
    rows = index.persist().orderBy("record").collect()
    raw = open(rows[0].archive, "rb").read() if "://" not in rows[0].archive else open(rows[0].archive.removeprefix("file://"), "rb").read()
    assert gzip.decompress(raw) == whole
    at = 0
    for r in rows:
        assert r.offset == at
        member = zlib.decompressobj(31)
        assert member.decompress(raw[at : at + r.length]).startswith(b"WARC/1.1")
        assert member.eof and not member.unused_data
        at += r.length
    assert at == len(raw) and len(rows) == 40
    assert len(open(rows[0].archive.removeprefix("file://") + ".idx").read().splitlines()) == 40


def test_streams():
    record = b"WARC/1.1\r\nContent-Length: 4\r\n\r\nab\r\n\r\n\r\n"
    parts = [record[k : k + 3] for k in range(0, len(record), 3)] * 2
    assert [(f["content-length"], r) for f, r in warc.split_records(iter(parts))] == [("4", record[:-4])] * 2
    two = gzip.compress(record) + gzip.compress(record)
    assert b"".join(warc.inflate(two[k : k + 5] for k in range(0, len(two), 5))) == record * 2
    big = bytes(5_000_000)
    assert b"".join(warc.inflate(iter([gzip.compress(big)]))) == big
    assert list(warc.split_records(iter([]))) == []
    for bad in (record[:-8], record[:12], b"WARC/1.1\r\nA: b\r\n\r\n"):
        with pytest.raises(ValueError, match="record|header|length"):
            list(warc.split_records(iter([bad])))
