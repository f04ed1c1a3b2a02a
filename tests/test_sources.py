import gzip
import json
import os

import pytest
from helpers import record, records
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from crawlweft import schemas
from crawlweft.sources import bodies, lists
from crawlweft.sources import records as source


def test_from_attributes_last_value_wins(spark):
    rows = [
        ("a", 1, "url", "old"),
        ("a", 3, "url", "new"),
        ("a", 2, "content-type", "text/html"),
        ("a", 4, "unheard-of", "x"),
        ("b", 1, "fingerprint", "f"),
    ]
    wide = source.from_attributes(spark.createDataFrame(rows, schemas.ATTRIBUTE_ROW))
    assert wide.schema.names == schemas.CRAWL_RECORD.names
    got = {r["item_name"]: (r["url"], r["content_type"], r["fingerprint"]) for r in wide.collect()}
    assert got == {"a": ("new", "text/html", None), "b": (None, None, "f")}


def test_originals_compare_numbers(spark):
    rows = records(
        spark,
        record("a", fetched="999.5"),
        record("b", fetched="1000.25"),
        record("c", fetched="1000.75"),
        record("d", fetched="2000", original="x"),
        record("e", fetched=None),
        record("f", fingerprint=None, fetched="2000"),
    )
    names = lambda df: [r["item_name"] for r in df.orderBy("item_name").collect()]
    assert names(source.originals(rows)) == ["a", "b", "c"]
    assert names(source.originals(rows, 1000.25)) == ["c"]
    assert names(source.late_records(rows, 1000.25)) == ["a", "b"]
    assert source.high_water_mark(rows).first()["mark"] == 1000.75
    assert [r["item_name"] for r in source.originals_by_time(rows).collect()] == ["a", "b", "c"]


def test_original_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "records")
    records(spark, record("a"), record("b", original="x")).write.parquet(path)
    plan = source.originals(source.read_records(spark, path)).select("fingerprint")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(original,self)" in plan and "IsNotNull(fingerprint)" in plan
    assert "raw_url" not in plan.split("ReadSchema")[1]


def test_gzip_and_binary_bodies(spark, tmp_path):
    for key, text in {"a.example/x y": "one\ntwo", "b+c": "grün"}.items():
        file = tmp_path / "gz" / f"{key}.gz"
        os.makedirs(file.parent, exist_ok=True)
        file.write_bytes(gzip.compress(text.encode()))
    got = {r["content_key"]: bytes(r["bytes"]).decode() for r in bodies.read_gzip_bodies(spark, str(tmp_path / "gz")).collect()}
    assert got == {"a.example/x y": "one\ntwo", "b+c": "grün"}
    file.write_bytes(gzip.compress("grün".encode("latin-1")))  # bytes of other charsets stay as they are
    got = {r["content_key"]: bytes(r["bytes"]) for r in bodies.read_gzip_bodies(spark, str(tmp_path / "gz")).collect()}
    assert got["b+c"] == b"gr\xfcn"
    os.makedirs(tmp_path / "raw")
    (tmp_path / "raw" / "k").write_bytes("grün".encode("utf-16"))
    raw = bodies.read_binary_bodies(spark, str(tmp_path / "raw"))
    assert raw.select("content_key", F.decode("bytes", "utf-16").alias("t")).collect() == [("k", "grün")]


def test_gzip_bodies_are_written_without_a_folder_for_each_key(spark, tmp_path):
    rows = [(f"k{i}", f"text {i}".encode()) for i in range(600)] + [("k1", b"more"), (None, b"x"), ("none", None)]
    path = f"{tmp_path}/gz"
    bodies.write_gzip_bodies(spark.createDataFrame(rows, "k string, v binary").repartition(3, "k"), path)
    assert len(os.listdir(path)) <= bodies.FOLDERS
    read = bodies.read_gzip_bodies(spark, path).select(F.regexp_extract("content_key", "/([^/=]+)=", 1).alias("k"), "bytes")
    got = {r["k"]: bytes(r["bytes"]) for r in read.collect()}
    assert len(got) == 601 and got["k7"] == b"text 7\n" and got["none"] == b"\n"
    assert sorted(got["k1"].split(b"\n")) == [b"", b"more", b"text 1"]


def test_gzip_bodies_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bodies, "BATCH_ROWS", 7)
    monkeypatch.setattr(bodies, "LISTED_ROWS", 5)
    folder, want = tmp_path / "a b%20c+d", {}
    for i in range(60):
        key = f"{'/'.join('xyz'[: i % 4])}/k {i}%2B+é".lstrip("/")
        want[key] = f"text {i}\r\n\0".encode("utf-16") * (i % 3)
        (folder / key).parent.mkdir(parents=True, exist_ok=True)
        (folder / f"{key}.gz").write_bytes(gzip.compress(want[key]))
    (folder / "x" / "twice.gz").write_bytes(gzip.compress(b"one") + gzip.compress(b"two"))
    (folder / "x" / "plain").write_bytes(b"as it is")
    for name in ("x/empty.gz", ".hidden.gz", "_hidden.gz", "x/part.gz._COPYING_"):
        (folder / name).write_bytes(b"")
    (folder / "_folder").mkdir()
    (folder / "_folder" / "k.gz").write_bytes(gzip.compress(b"hidden"))
    (folder / "_k=1.gz").write_bytes(gzip.compress(b"seen"))
    want |= {"x/twice": b"onetwo", "x/plain": b"as it is", "_k=1": b"seen"}
    got = bodies.read_gzip_bodies(spark, f"{folder}/")
    assert not [x for x in got.inputFiles() if "/k%20" in x]  # no list of the files on the driver
    assert sorted((r["content_key"], bytes(r["bytes"])) for r in got.collect()) == sorted(want.items())
    assert got.columns == ["content_key", "bytes"]
    monkeypatch.setattr(bodies, "_is_open_folder", lambda uri: False)  # by Spark's own reader
    assert sorted((r["content_key"], bytes(r["bytes"])) for r in bodies.read_gzip_bodies(spark, str(folder)).collect()) == sorted(want.items())


def test_gzip_bodies_of_patterns_and_missing_folders(spark, tmp_path):
    for key in ("a/one", "b/two"):
        (tmp_path / key).parent.mkdir(exist_ok=True)
        (tmp_path / f"{key}.gz").write_bytes(gzip.compress(b"x"))
    (tmp_path / "none").mkdir()
    assert bodies.read_gzip_bodies(spark, f"{tmp_path}/[ab]").count() == 2
    assert bodies.read_gzip_bodies(spark, f"file:{tmp_path}").count() == 2
    assert bodies.read_gzip_bodies(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(AnalysisException):
        bodies.read_gzip_bodies(spark, f"{tmp_path}/missing")


def test_rule_list(spark, tmp_path):
    file = tmp_path / "rules.txt"
    file.write_text("<> note\n[IndexableMediaTypes]\ntext/*\npdf\n\n[NonIndexableMediaTypes]\n<> more\naudio/*\n[CommonMediaTypes]\npdf\n")
    got = sorted(map(tuple, lists.read_rule_list(spark, str(file)).collect()))
    assert got == [
        ("CommonMediaTypes", "exact", "pdf"),
        ("IndexableMediaTypes", "exact", "pdf"),
        ("IndexableMediaTypes", "primary", "text"),
        ("NonIndexableMediaTypes", "primary", "audio"),
    ]


def test_profile_files(spark, tmp_path):
    (tmp_path / "en").write_text(json.dumps({"freq": {"a": 5, "th": 3, "the": 2}, "n_words": [50, 30, 20], "name": "en"}))
    got = sorted(map(tuple, lists.read_profiles(spark, str(tmp_path)).collect()))
    assert got == [("en", 1, "a", 5, 50), ("en", 2, "th", 3, 30), ("en", 3, "the", 2, 20)]


@pytest.mark.parametrize(
    ("raw", "header", "text"),
    [
        (b'<html><meta charset="iso-8859-1">gr\xfcn', "utf-8", '<html><meta charset="iso-8859-1">grün'),
        (b"gr\xfcn", "ISO-8859-1", "grün"),
        ("grün".encode(), None, "grün"),
        ("\ufeffgrün".encode("utf-16-le"), "utf-8", "grün"),
        (b"gr\xfcn", None, "gr\ufffdn"),
    ],
)
def test_body_text(spark, raw, header, text):
    rows = spark.createDataFrame([(bytearray(raw), header)], "b binary, h string")
    assert rows.select(bodies.body_text(F.col("b"), F.col("h")).alias("t")).first()["t"] == text


@pytest.mark.parametrize("few", [True, False])
def test_attach_bodies(spark, monkeypatch, few):
    monkeypatch.setattr(bodies, "is_small", lambda df: few)
    pages = source.typed(records(spark, record("?a/"), record("b", content_type="text/plain; charset=koi8-r"), record("gone")))
    stored = spark.createDataFrame(
        [("a", bytearray("grün".encode())), ("b", bytearray("мир".encode("koi8-r"))), ("other", bytearray(b"x"))],
        "content_key string, bytes binary",
    )
    got = {r["item_name"]: (r["content"], r["n_bytes"], r["has_body"]) for r in bodies.attach_bodies(pages, stored).collect()}
    assert got == {"?a/": ("grün", 5, True), "b": ("мир", 3, True), "gone": (None, None, False)}
    assert [r["item_name"] for r in bodies.missing_bodies(pages, stored).collect()] == ["gone"]
