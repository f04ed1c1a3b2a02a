"""Crawl records and bodies derived from the given tables, for the registered queries.

`documents` and `pages` hold contents but no crawl headers, so each source of
`documents` is read as one web host that answers with its own kind of headers:
plain, wrongly typed, unreadable, missing.  Rows and texts are used whole.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft import schemas

# Content type that each source answers with; src19 answers with none.
CONTENT_TYPE_OF = {
    "src0": "text/html; charset=utf-8",
    "src1": "text/plain",
    "src2": 'TEXT/PLAIN; charset="ISO-8859-1"',
    "src3": "application/pdf",
    "src4": "text/html",
    "src5": "text/html;charset=UTF-8",
    "src6": "text/csv; header=present",
    "src7": "text/plain",
    "src8": "application/vnd.ms-excel",
    "src9": "text/plain;charset=utf-8",
    "src10": "text/plain; Charset = utf-8",
    "src11": "text/plain; charset=us-ascii",
    "src12": "Text/HTML",
    "src13": "application/xhtml+xml",
    "src14": " text/plain ;",
    "src15": "audio/mpeg",
    "src16": "application/zip",
    "src17": "application/json",
    "src18": "dummy/unknown",
}

FIRST_FETCH = 1366200000
FIRST_PAGE_FETCH = 1366100000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core work when the input has fewer splits than there are cores.

    An input of more splits, which is any large one, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", *(columns or ("text",)))
    return spread(df, "doc_id")


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


_seconds = f"({FIRST_FETCH} + doc_id * 60)"
_fetch = f"timestamp_seconds({_seconds})"


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One crawl record per document."""
    types = F.create_map(*[F.lit(x) for pair in CONTENT_TYPE_OF.items() for x in pair])
    return (
        table(spark, sf_dir, "documents")
        .withColumn("content_type", types[F.col("source")])
        .selectExpr(
            "concat('?', source, '.example.com/', lang, '/', doc_id, '/') AS item_name",
            "CASE WHEN source = 'src18' THEN 'copy' ELSE 'self' END AS original",
            "CASE WHEN source <> 'src19' THEN md5(text) END AS fingerprint",
            f"CASE WHEN source <> 'src17' THEN concat({_seconds}, '.25') END AS fetched",
            f"CASE WHEN lang <> 'de' THEN concat({_seconds} - 3600, '.5') END AS discovered",
            """CASE WHEN source = 'src16' THEN NULL
                    WHEN source = 'src15' THEN 'not an address'
                    WHEN source = 'src14' THEN 'http://src14.example.com/'
                    ELSE concat('http://', source, '.example.com/', lang, '/', doc_id, '.html?n=', n_chars) END AS url""",
            "concat('HTTP://', upper(source), '.Example.com/', lang, '/', doc_id, '.html') AS raw_url",
            f"""CASE WHEN source = 'src13' THEN 'some day'
                     WHEN lang = 'en' THEN date_format({_fetch}, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
                     WHEN lang = 'de' THEN date_format({_fetch}, "EEEE, dd-MMM-yy HH:mm:ss 'GMT'")
                     WHEN lang = 'fr' THEN date_format({_fetch}, "EEE MMM d HH:mm:ss yyyy")
                     ELSE date_format({_fetch}, "yyyy-MM-dd'T'HH:mm:ss'Z'") END AS last_modified""",
            "CASE WHEN source = 'src12' THEN concat(n_chars, 'x') ELSE cast(n_chars AS string) END AS content_length",
            "content_type",
            """CASE WHEN source = 'src12' THEN upper(lang) WHEN source = 'src11' THEN NULL
                    WHEN source = 'src10' THEN 'pt-BR' WHEN source = 'src9' THEN 'xx' ELSE lang END AS content_language""",
            """CASE WHEN source = 'src8' THEN concat('attachment; filename="report ', doc_id, '.xls"')
                    WHEN source = 'src7' THEN concat('inline; filename=notes', doc_id, '; x=1') END AS content_disposition""",
            """CASE WHEN lang = 'fr' THEN '["robots","noindex"]' WHEN source = 'src6' THEN NULL
                    WHEN source = 'src5' THEN 'bad' ELSE '[]' END AS googlebot_exclusion_reasons""",
        )
        .select(*schemas.CRAWL_RECORD.names)
    )


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One crawl record per page."""
    seconds = f"({FIRST_PAGE_FETCH} + page_id * 60)"
    return table(spark, sf_dir, "pages").selectExpr(
        "concat('/', page_id, '.', regexp_replace(url, '^https?://', ''), '?') AS item_name",
        "'self' AS original",
        "md5(html) AS fingerprint",
        f"concat({seconds}, '.5') AS fetched",
        "cast(NULL AS string) AS discovered",
        "url",
        "url AS raw_url",
        "cast(NULL AS string) AS last_modified",
        "cast(NULL AS string) AS content_length",
        "'text/html; charset=utf-8' AS content_type",
        "cast(NULL AS string) AS content_language",
        "cast(NULL AS string) AS content_disposition",
        "'[]' AS googlebot_exclusion_reasons",
    )


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_records(spark, sf_dir).unionByName(page_records(spark, sf_dir))


def document_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(content_key, content); host src4 stored none."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat(source, '.example.com/', lang, '/', doc_id) AS content_key", "text AS content", "source"
    ).filter("source <> 'src4'").drop("source")


def all_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").selectExpr(
        "trim(BOTH '?/' FROM concat(page_id, '.', regexp_replace(url, '^https?://', ''))) AS content_key",
        "html AS content",
    )
    return document_bodies(spark, sf_dir).unionByName(pages)


def meta_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose head also carries author, description, keywords and dates."""
    head = """concat('<head><meta name="author" content="', split_part(split_part(url, '//', 2), '.', 1), '">',
        '<meta content=''page ', page_id, ' &amp; more'' name=description>',
        '<meta name="keywords" content="k', page_id, ', crawl"/>',
        '<meta property="article:published_time" content="2013-04-17T12:00:', lpad(cast(page_id % 60 AS string), 2, '0'), 'Z">',
        '<meta name="last-modified" content="Wed, 17 Apr 2013 13:00:00 GMT">')"""
    return html_pages(spark, sf_dir).selectExpr("page_id", "url", f"replace(html, '<head>', {head}) AS html")
