"""Time the headline queries; prints one JSON line.

`BENCH_SF_DIR` names the data (default sf0.1), `BENCH_CPUS` the local cores.
Results go to Spark's no-op sink, so every row is computed and none is collected.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "dup_groups",
    "packed_groups",
    "incremental_members",
    "attribute_pivot",
    "media_type_decision",
    "text_dates",
    "type_charset_resolution",
    "page_text",
    "out_links_html",
    "emails",
    "language_profile",
    "language_detect",
    "simhash_words",
    "tokens_word_bigram",
    "tokens_language",
    "index_fields",
    "term_vectors",
    "postings",
    "dictionary",
    "match_all_terms",
    "phrase_match",
    "body_join",
    "upsert_latest",
    "full_pipeline",
    "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("crawlweft-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="crawlweft-bench-"))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from crawlweft.plans.queries import QUERIES

    for table in ("documents", "pages"):  # start the executors and the file cache
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
