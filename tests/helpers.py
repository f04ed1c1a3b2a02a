"""Crawl records for tests."""

from crawlweft import schemas


def record(item_name, fingerprint="f1", **fields):
    row = dict.fromkeys(schemas.CRAWL_RECORD.names)
    row.update(
        item_name=item_name,
        original="self",
        fingerprint=fingerprint,
        fetched="1366200000.25",
        url=f"http://a.example/{item_name}",
        raw_url=f"http://a.example/{item_name}",
        content_type="text/html; charset=utf-8",
        googlebot_exclusion_reasons="[]",
    )
    row.update(fields)
    return tuple(row[n] for n in schemas.CRAWL_RECORD.names)


def records(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.CRAWL_RECORD)
