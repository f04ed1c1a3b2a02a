"""The pipeline and the registered queries of the package, over the smallest data set."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from crawlweft.llm.queries import ORACLES, QUERIES

SMALL = entry.SMALL


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, SMALL).toPandas()
    key, table = {"op8": ("page_id", "pages"), "op13": ("conv_id", "conversations")}.get(name.split("_")[0], ("doc_id", "documents"))
    assert set(rows[key]) == {r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()}
    assert name.startswith("op5") or not rows[key].duplicated().any()


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = docs
    before = {r.doc_id: r.text for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        seen = stage(spark, seen, SMALL)
        assert seen.columns == docs.columns
        after = {r.doc_id: r.text for r in seen.collect()}
        assert set(after) <= set(before)
        if k != 2:
            assert all(before[i] == t for i, t in after.items())
        before = after
    items = [tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r.text.lower())) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = {w[k : k + 10] for w in items for k in range(len(w) - 9)}
    for t in before.values():
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        assert not any(tuple(ws[k : k + 10]) in windows for k in range(len(ws) - 9))
    packed = corpus_pipeline.STAGES[-1][1](spark, seen, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(before)
    assert corpus_pipeline.run(spark, SMALL).count() == packed.count()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_and_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got, want = check.normal(QUERIES[name](spark, SMALL).toPandas()), check.normal(con.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)
