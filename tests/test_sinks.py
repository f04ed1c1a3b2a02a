import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweft import schemas
from crawlweft.sinks import index

VERSION = T.StructType.fromDDL("id string, part int, body string, version double")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_validity(spark):
    groups = spark.createDataFrame(
        [("f", 1, 1), ("", 1, 1), ("g", 0, 1), ("h", 1, 0), (None, 1, 1)], "fingerprint string, n_urls int, n_raw_urls int"
    )
    assert rows(index.valid_groups(groups)) == [("f", 1, 1)]
    assert index.invalid_groups(groups).count() == 4


def test_strict_refuses_unknown_columns(spark):
    df = spark.createDataFrame([("d", 3)], "id string, text_length bigint")
    with pytest.raises(ValueError, match="extra"):
        index.strict(df.withColumn("extra", F.lit(1)))
    out = index.strict(df)
    assert out.schema.names == schemas.TEXT_DOCUMENT.names
    assert out.schema["text_length"].dataType == T.IntegerType()
    assert out.first()["title"] is None


def test_latest_keeps_all_parts_of_the_newest_version(spark):
    df = spark.createDataFrame(
        [("a", 0, "old", 1.0), ("a", 1, "old", 1.0), ("a", 0, "new", 2.0), ("a", 1, "new", 2.0), ("b", 0, "x", 1.0)], VERSION
    )
    assert rows(index.latest(df, "id", "version")) == [("a", 0, "new", 2.0), ("a", 1, "new", 2.0), ("b", 0, "x", 1.0)]


def test_upsert_replaces_whole_documents(spark):
    old = spark.createDataFrame([("a", 0, "old", 1.0), ("a", 1, "old", 1.0), ("b", 0, "x", 1.0)], VERSION)
    new = spark.createDataFrame([("a", 0, "new", 2.0), ("c", 0, "y", 2.0)], VERSION)
    assert rows(index.upsert(old, new, "id")) == [("a", 0, "new", 2.0), ("b", 0, "x", 1.0), ("c", 0, "y", 2.0)]


def test_batches_and_compaction(spark, tmp_path):
    path, target = str(tmp_path / "table"), str(tmp_path / "compact")
    assert index.read_batches(spark, path, VERSION).count() == 0
    index.write_batch(spark.createDataFrame([("a", 0, "old", 1.0), ("b", 0, "x", 1.0)], VERSION), path, 0)
    index.write_batch(spark.createDataFrame([("a", 0, "lost", 2.0)], VERSION), path, 1)
    index.write_batch(spark.createDataFrame([("a", 0, "new", 2.0)], VERSION), path, 1)  # the batch is run again
    assert index.read_batches(spark, path, VERSION).count() == 3
    index.compact(spark, path, target, VERSION, "id", "version", "batch_id")
    assert rows(index.read_batches(spark, target, VERSION)) == [("a", 0, "new", 2.0, 0), ("b", 0, "x", 1.0, 0)]


def test_stored_view_and_json(spark):
    df = spark.createDataFrame([("d", None, ["m"])], "id string, body string, misc array<string>")
    assert index.stored_view(df).columns == ["id", "body"]
    assert json.loads(index.to_json(df).first()["json"]) == {"id": "d", "misc": ["m"]}
