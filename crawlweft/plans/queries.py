"""Registered queries: each reads whole tables, with the SQL that checks it."""

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft.functions import charsets, dates, headers, html, textscan, tokens
from crawlweft.operators import extract, groups, language, lookup, media_types, simhash, terms
from crawlweft.operators.default_rules import SECTIONS
from crawlweft.operators.staging import scratch_path, write_stage
from crawlweft.plans import derived as d
from crawlweft.plans import oracle_parts as o
from crawlweft.plans import pipeline
from crawlweft.schemas import ATTRIBUTE_COLUMNS, CRAWL_RECORD
from crawlweft.sinks import index
from crawlweft.sources import bodies as body_source
from crawlweft.sources import records as record_source
from crawlweft.sources.lists import fixed_table, read_profiles, read_rule_list
from crawlweft.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The mark that the incremental queries start from.
MARK = 1366206000.0


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # dates are compared as UTC text
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def rules(spark: SparkSession) -> DataFrame:
    """The default rules, with the common types as the known types."""
    table = media_types.rules(spark, SECTIONS)
    known = table.filter((F.col("section") == media_types.COMMON)).select("value")
    return media_types.close_over_known_types(table, known)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_types.decide(record_source.typed(d.document_records(spark, sf_dir)), rules(spark))


_TYPED = f"WITH t AS ({o.typed(o.DOCUMENT_RECORDS)})"
_ROLLED = f"{_TYPED}, g AS ({o.rolled('t')})"
_IS_ORIGINAL = "original = 'self' AND fingerprint IS NOT NULL AND fetched IS NOT NULL"


def joined(c: str | Column, sep: str = "|") -> Column:
    return F.array_join(c, sep)


# --- duplicate groups -------------------------------------------------------


@query(f"{_ROLLED} SELECT * FROM g")
def dup_groups(spark, sf_dir):
    return groups.rollup(members(spark, sf_dir))


@query(
    _TYPED
    + """ SELECT fingerprint, field, value, item_name FROM (
      SELECT fingerprint, 'url' AS field, url AS value, item_name FROM t
      UNION ALL SELECT fingerprint, 'raw_url', raw_url, item_name FROM t
      UNION ALL SELECT fingerprint, 'date_fetched', strftime(fetched_at, '%Y-%m-%d %H:%M:%S.%g'), item_name FROM t
      UNION ALL SELECT fingerprint, 'date_discovered', strftime(discovered_at, '%Y-%m-%d %H:%M:%S.%g'), item_name FROM t
      UNION ALL SELECT fingerprint, 'date_modified', strftime(modified_at, '%Y-%m-%d %H:%M:%S.%g'), item_name FROM t)
    WHERE fingerprint IS NOT NULL AND value IS NOT NULL"""
)
def dup_group_values(spark, sf_dir):
    rows = groups.group_values(members(spark, sf_dir))
    is_date = F.col("field").startswith("date_")
    value = F.when(is_date, F.date_format(F.col("value").try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS"))
    return rows.select("fingerprint", "field", F.coalesce(value, "value").alias("value"), "item_name")


@query(f"{_TYPED} SELECT DISTINCT fingerprint, filename FROM t WHERE fingerprint IS NOT NULL AND filename IS NOT NULL")
def dup_group_filenames(spark, sf_dir):
    return groups.group_sets(members(spark, sf_dir))


@query(
    _TYPED
    + """ SELECT fingerprint, 0 AS part,
      coalesce(string_agg(url, '|' ORDER BY fetched_num NULLS FIRST, url, item_name), '') AS urls,
      coalesce(string_agg(raw_url, '|' ORDER BY fetched_num NULLS FIRST, url NULLS FIRST, item_name), '') AS raw_urls,
      coalesce(string_agg(DISTINCT filename, '|' ORDER BY filename), '') AS filenames,
      CAST(count(fetched_at) AS INTEGER) AS n_fetched, CAST(count(discovered_at) AS INTEGER) AS n_discovered, CAST(count(modified_at) AS INTEGER) AS n_modified
    FROM t WHERE fingerprint IS NOT NULL GROUP BY fingerprint"""
)
def packed_groups(spark, sf_dir):
    lists = groups.pack_lists(members(spark, sf_dir))
    return lists.select(
        "fingerprint",
        "part",
        joined("url").alias("urls"),
        joined("raw_url").alias("raw_urls"),
        joined("filename").alias("filenames"),
        F.size("date_fetched").alias("n_fetched"),
        F.size("date_discovered").alias("n_discovered"),
        F.size("date_modified").alias("n_modified"),
    )


@query(
    f"""{_TYPED} SELECT fingerprint, item_name FROM t WHERE fingerprint IN (
      SELECT fingerprint FROM t WHERE {_IS_ORIGINAL} AND fetched_num > {MARK})"""
)
def incremental_members(spark, sf_dir):
    """Every record of the groups that an incremental run has to rebuild."""
    records = d.document_records(spark, sf_dir)
    fresh = record_source.originals(records, MARK)
    return groups.grouped_records(records, fresh).select("fingerprint", "item_name")


@query(f"{_ROLLED} SELECT fingerprint, filename_hint FROM g WHERE filename_hint IS NOT NULL")
def filename_hint(spark, sf_dir):
    """The first file name with a dot in each group."""
    rolled = groups.rollup(members(spark, sf_dir))
    return rolled.filter(F.col("filename_hint").isNotNull()).select("fingerprint", "filename_hint")


# --- scans and state --------------------------------------------------------


@query(f"{_TYPED} SELECT item_name, fetched, fingerprint FROM t WHERE {_IS_ORIGINAL} ORDER BY fetched_num, item_name")
def originals_by_time(spark, sf_dir):
    return record_source.originals_by_time(d.document_records(spark, sf_dir))


@query(f"{_TYPED} SELECT item_name, fetched, fingerprint FROM t WHERE {_IS_ORIGINAL} AND fetched_num > {MARK}")
def incremental_originals(spark, sf_dir):
    return record_source.originals(d.document_records(spark, sf_dir), MARK).select("item_name", "fetched", "fingerprint")


@query(f"{_TYPED} SELECT item_name, 'late' AS stage FROM t WHERE {_IS_ORIGINAL} AND fetched_num <= {MARK}")
def late_rows(spark, sf_dir):
    late = record_source.late_records(d.document_records(spark, sf_dir), MARK)
    return index.reject(late, "late", "fetched at or before the mark").select("item_name", "stage")


@query(f"{_TYPED} SELECT max(fetched_num) AS mark FROM t WHERE {_IS_ORIGINAL}")
def high_water_mark(spark, sf_dir):
    return record_source.high_water_mark(d.document_records(spark, sf_dir))


@query("SELECT event_id, ts, user_id FROM events WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 1")
def ordered_limit(spark, sf_dir):
    events = d.table(spark, sf_dir, "events")
    return events.filter("event_type = 'error'").select("event_id", "ts", "user_id").orderBy("ts", "event_id").limit(1)


@query(f"SELECT {', '.join(CRAWL_RECORD.names)} FROM ({o.DOCUMENT_RECORDS})")
def attribute_pivot(spark, sf_dir):
    """Records unpivoted to attribute rows, each with a stale earlier value, and back."""
    records = d.document_records(spark, sf_dir)
    rows = [
        F.struct(F.lit(seq).cast("bigint").alias("seq"), F.lit(name).alias("attribute"), value.alias("value"))
        for name, column in ATTRIBUTE_COLUMNS.items()
        for seq, value in ((1, F.when(F.col(column).isNotNull(), "stale")), (2, F.col(column)))
    ]
    narrow = records.select("item_name", F.explode(F.array(*rows)).alias("a")).select("item_name", "a.*")
    return record_source.from_attributes(narrow.filter("value IS NOT NULL"))


# --- scalar fields ----------------------------------------------------------


@query(
    """SELECT user_id, bool_or(CASE WHEN r LIKE '[%]' THEN json_array_length(r) > 0 ELSE false END)
      AS googlebot_blocked,
      count(*) FILTER (r NOT LIKE '[%]') AS n_malformed
    FROM (SELECT user_id, CASE event_type WHEN 'error' THEN '[' || props || ']' WHEN 'view' THEN '[]' WHEN 'click' THEN props
        WHEN 'purchase' THEN '[' || props END AS r FROM events) GROUP BY user_id"""
)
def json_flag(spark, sf_dir):
    reasons = F.expr(
        """CASE event_type WHEN 'error' THEN concat('[', props, ']') WHEN 'view' THEN '[]' WHEN 'click' THEN props
           WHEN 'purchase' THEN concat('[', props) END"""
    )
    events = d.table(spark, sf_dir, "events").select("user_id", reasons.alias("r"))
    return events.groupBy("user_id").agg(
        F.bool_or(headers.is_blocked(F.col("r"))).alias("googlebot_blocked"),
        F.count_if(headers.is_malformed_reasons(F.col("r"))).alias("n_malformed"),
    )


@query(f"{_TYPED} SELECT item_name, media_type, charset, decision FROM t")
def media_type_decision(spark, sf_dir):
    return members(spark, sf_dir).select(
        "item_name",
        F.col("header_media_type").alias("media_type"),
        F.col("header_charset").alias("charset"),
        "decision",
    )


@query(f"{_TYPED} SELECT item_name, media_type, decision FROM t")
def rule_file_decision(spark, sf_dir):
    """All records decided by rules that were written as a rule file and read back."""
    path = scratch_path(spark, "rules")
    lines = [x for name, values in SECTIONS.items() for x in (f"[{name}]", "<> fixed rules", *values, "")]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    table = read_rule_list(spark, path)
    known = table.filter(F.col("section") == media_types.COMMON).select("value")
    records = record_source.typed(d.document_records(spark, sf_dir))
    decided = media_types.decide(records, media_types.close_over_known_types(table, known))
    return decided.select("item_name", F.col("header_media_type").alias("media_type"), "decision")


@query(f"{_TYPED} SELECT media_type, coalesce(media_type IN {o.COMMON_LIST}, false) AS is_common_type, count(*) AS n FROM t GROUP BY ALL")
def common_type(spark, sf_dir):
    types = record_source.typed(d.document_records(spark, sf_dir)).groupBy(F.col("header_media_type").alias("media_type")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return media_types.flag_common(types, rules(spark)).select("media_type", "is_common_type", "n")


@query(
    f"""{_TYPED} SELECT DISTINCT m AS value FROM (SELECT lower(media_type) AS m FROM t WHERE media_type IS NOT NULL)
      WHERE m NOT IN {o.SETTLED_EXACT} AND split_part(m, '/', 1) NOT IN {o.SETTLED_PRIMARY} AND m NOT IN {o.LISTED_EXACT}"""
)
def known_types(spark, sf_dir):
    """Exact rules added when every media type in the records counts as known."""
    table = media_types.rules(spark, SECTIONS)
    seen = record_source.typed(d.document_records(spark, sf_dir)).select(F.lower("header_media_type").alias("value"))
    closed = media_types.close_over_known_types(table, seen.filter("value IS NOT NULL").distinct())
    return closed.join(table, ["section", "kind", "value"], "left_anti").select("value")


@query(f"{_TYPED} SELECT item_name, filename FROM t UNION ALL SELECT CAST(page_id AS VARCHAR), nullif(regexp_extract(url, '^https?://[^/?#]*/([^?#]+)', 1), '') FROM pages")
def filename_from_url(spark, sf_dir):
    records = record_source.typed(d.document_records(spark, sf_dir)).select("item_name", "filename")
    pages = d.table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("item_name"),
        headers.filename(F.lit(None).cast("string"), F.col("url")).alias("filename"),
    )
    return records.unionByName(pages)


@query(
    f"""{_TYPED} SELECT item_name, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S') AS date_fetched,
      strftime(discovered_at, '%Y-%m-%dT%H:%M:%S') AS date_discovered, epoch_ms(fetched_at) AS fetched_ms FROM t"""
)
def epoch_to_iso(spark, sf_dir):
    return record_source.typed(d.document_records(spark, sf_dir)).select(
        "item_name",
        dates.iso(F.col("fetched_at")).alias("date_fetched"),
        dates.iso(F.col("discovered_at")).alias("date_discovered"),
        F.unix_millis("fetched_at").alias("fetched_ms"),
    )


@query(f"{_TYPED} SELECT item_name, strftime(modified_at, '%Y-%m-%dT%H:%M:%S') AS date_modified FROM t")
def text_dates(spark, sf_dir):
    return record_source.typed(d.document_records(spark, sf_dir)).select(
        "item_name", dates.iso(F.col("modified_at")).alias("date_modified")
    )


@query(
    """SELECT doc_id, coalesce(try_cast(len AS INTEGER), 0) AS declared,
      CAST(greatest(coalesce(try_cast(len AS INTEGER), 0), strlen(text), length(text)) AS INTEGER) AS size, CAST(length(text) AS INTEGER) AS text_length
    FROM (SELECT *, CASE WHEN source = 'src12' THEN n_chars || 'x' ELSE CAST(n_chars AS VARCHAR) END AS len FROM documents)"""
)
def size_resolution(spark, sf_dir):
    docs = d.table(spark, sf_dir, "documents").withColumn(
        "declared",
        headers.declared_size(F.expr("CASE WHEN source = 'src12' THEN concat(n_chars, 'x') ELSE cast(n_chars AS string) END")),
    )
    return docs.select(
        "doc_id",
        "declared",
        headers.final_size(F.col("declared"), F.octet_length("text"), F.length("text")).alias("size"),
        F.length("text").alias("text_length"),
    )


@query(
    f"""WITH r AS ({o.DOCUMENT_RECORDS} UNION ALL {o.PAGE_RECORDS}), b AS ({o.ALL_BODIES}),
    j AS (SELECT item_name, {o.MEDIA_TYPE} AS m, {o.CHARSET} AS c, content,
        regexp_matches(content, '(?i)^\\s*(?:<!doctype html|<html[\\s>])') AS looks_html
      FROM r JOIN b ON trim(item_name, '?/') = content_key),
    k AS (SELECT *, CASE WHEN looks_html AND m IS DISTINCT FROM 'application/xhtml+xml' THEN 'text/html' ELSE m END AS media_type FROM j)
    SELECT item_name, media_type, coalesce(CASE WHEN lower(media_type) IN ('text/html', 'application/xhtml+xml') THEN
      nullif(regexp_extract(content, '(?i)<meta\\s[^<>]*?charset\\s*=\\s*["'']?([A-Za-z0-9_.:-]+)', 1), '') END, c) AS charset
    FROM k"""
)
def type_charset_resolution(spark, sf_dir):
    records = record_source.typed(d.all_records(spark, sf_dir))
    joined_rows = body_source.attach_bodies(records, d.all_bodies(spark, sf_dir)).filter("has_body")
    media_type = F.coalesce(
        extract.extracted_media_type(F.col("content"), F.col("header_media_type")), "header_media_type"
    )
    return joined_rows.withColumn("media_type", media_type).select(
        "item_name",
        "media_type",
        F.coalesce(
            F.when(html.is_html(F.lower("media_type")), html.html_charset(F.col("content"))), "header_charset"
        ).alias("charset"),
    )


@query("SELECT doc_id, CASE WHEN source = 'src3' THEN NULL ELSE md5(text) END AS digest FROM documents")
def decode_bodies(spark, sf_dir):
    """Texts stored as bytes in a charset per language; src3 names a charset that nobody knows."""
    docs = d.table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        """CASE WHEN source = 'src3' THEN 'x-unheard-of' WHEN lang = 'en' THEN 'UTF-8' WHEN lang = 'de' THEN 'utf-16'
           WHEN lang = 'es' THEN 'UTF-32' END AS charset""",
        "CASE lang WHEN 'de' THEN encode(text, 'utf-16') WHEN 'es' THEN encode(text, 'utf-32') ELSE encode(text, 'utf-8') END AS bytes",
    )
    return docs.select("doc_id", F.md5(charsets.decode(F.col("bytes"), F.col("charset"))).alias("digest"))


@query(
    f"""{_TYPED} SELECT lower(content_language) AS lang, {o.analyzer_of('lower(content_language)')} AS analyzer, count(*) AS n
    FROM t GROUP BY ALL"""
)
def analyzer_lookup(spark, sf_dir):
    tags = d.document_records(spark, sf_dir).groupBy(F.lower("content_language").alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    return language.with_analyzer(tags, F.col("lang"), language.analyzer_map(spark)).select("lang", "analyzer", "n")


@query(
    f"""{_TYPED} SELECT item_name, coalesce(CASE WHEN filename LIKE 'notes%' THEN 'fi' END, CASE WHEN decision = 'no' THEN 'sv' END,
      lower(content_language)) AS lang, array_to_string(list_sort(list_distinct(list_filter([lower(content_language),
      CASE WHEN filename LIKE 'notes%' THEN 'fi' END, CASE WHEN decision = 'no' THEN 'sv' END], lambda x: x IS NOT NULL))), '|') AS langs
    FROM t"""
)
def primary_language(spark, sf_dir):
    """Which of three sources names a record's language, and the set of all of them."""
    found = F.when(F.col("filename").startswith("notes"), "FI")
    page = F.when(F.col("decision") == "no", "sv")
    return members(spark, sf_dir).select(
        "item_name",
        language.primary_language(found, page, F.col("content_language")).alias("lang"),
        joined(language.language_set(F.col("content_language"), found, page)).alias("langs"),
    )


@query(
    f"""{_TYPED} SELECT item_name, array_to_string(list_transform(list_filter([modified_at,
      CASE WHEN original = 'self' THEN TIMESTAMP '2013-04-01 00:00:00' END], lambda x: x IS NOT NULL),
      lambda x: strftime(x, '%Y-%m-%dT%H:%M:%S')), '|') AS dates FROM t"""
)
def date_lists(spark, sf_dir):
    records = record_source.typed(d.document_records(spark, sf_dir))
    meta = dates.text_date(F.when(F.col("original") == "self", "on 2013-04-01"), F.col("fetched_at"))
    found = F.array_compact(F.array("modified_at", meta))
    return records.select("item_name", joined(F.transform(found, dates.iso)).alias("dates"))


# --- content ----------------------------------------------------------------


_REFERENCES = "'<p>&uuml;ber caf&eacute; &rsquo;s &#0000000228;&#xE4; &#38;amp; &amp;lt; &bogus; &#55296; &NotEqualTilde; n&ordm;&nbsp;'"


@query(
    f"""SELECT page_id, body, CAST(length(body) AS INTEGER) AS text_length FROM (SELECT page_id, {o.html_text('html')} AS body
    FROM (SELECT page_id, html || {_REFERENCES} || page_id || '</p>' AS html FROM pages))"""
)
def page_text(spark, sf_dir):
    """Text of all pages, each with a line of character references behind it."""
    more = F.concat("html", F.expr(_REFERENCES), F.col("page_id").cast("string"), F.lit("</p>"))
    pages = d.html_pages(spark, sf_dir).select("page_id", html.html_text(more).alias("body"))
    return pages.select("page_id", "body", F.length("body").alias("text_length"))


@query(
    f"""SELECT page_id, {o.TITLE} AS title, nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS html_language,
      nullif(regexp_extract(html, '<meta charset="([^"]+)"', 1), '') AS charset FROM pages"""
)
def page_title(spark, sf_dir):
    c = F.col("html")
    return d.html_pages(spark, sf_dir).select(
        "page_id",
        html.title(c).alias("title"),
        html.html_language(c).alias("html_language"),
        html.html_charset(c).alias("charset"),
    )


@query(
    """SELECT page_id, split_part(split_part(url, '//', 2), '.', 1) || '|~|~|~' AS authors,
      '~|page ' || page_id || ' & more|~|k' || page_id || ', crawl' AS misc,
      '2013-04-17T12:00:' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') AS date_created, '2013-04-17T13:00:00' AS date_modified
    FROM pages"""
)
def page_meta(spark, sf_dir):
    """Author, description, keyword and date elements."""
    bodies = d.meta_pages(spark, sf_dir).select(
        "page_id",
        F.col("url").alias("base_url"),
        F.col("html").alias("content"),
        F.octet_length("html").alias("n_bytes"),
        F.lit(True).alias("has_body"),
        F.lit("text/html").alias("header_media_type"),
        F.lit(None).cast("string").alias("header_charset"),
        F.lit(None).cast("string").alias("content_length"),
        F.timestamp_seconds(F.lit(1366200000)).alias("fetched_at"),
    )
    return extract.extract(bodies).select(
        "page_id",
        F.array_join("authors", "|", "~").alias("authors"),
        F.array_join("misc", "|", "~").alias("misc"),
        dates.iso(F.col("meta_created")).alias("date_created"),
        dates.iso(F.col("meta_modified")).alias("date_modified"),
    )


@query(
    f"""SELECT DISTINCT page_id, regexp_extract(url, '^https?://[^/?#]+', 0) || {o.unescape('h')} AS link
    FROM (SELECT page_id, url, unnest(regexp_extract_all({o.hidden('html')}, '<a href="([^"]*)"', 1)) AS h FROM pages)"""
)
def out_links_html(spark, sf_dir):
    return d.html_pages(spark, sf_dir).select(
        "page_id", F.explode(html.html_links(F.col("html"), F.col("url"))).alias("link")
    )


@query(
    r"""SELECT doc_id, unnest(list_distinct(list_transform(regexp_extract_all(t, '(?i)https?://[^\s<>"''(){}\[\]]+'),
      lambda u: regexp_replace(u, '[.,;:!?]+$', '')))) AS link
    FROM (SELECT doc_id, text || ' (http://' || source || '.example.com/' || lang || '/' || doc_id || '.html), see HTTPS://'
      || lang || '.example.org/?q=' || n_chars || '! http://' || source || '.example.com/' || lang || '/' || doc_id || '.html.' AS t
      FROM documents)"""
)
def out_links_text(spark, sf_dir):
    """Addresses in running text: whole texts, each with a few addresses written behind it."""
    docs = d.texts(spark, sf_dir, "text", "source", "lang", "n_chars")
    page = "'http://', source, '.example.com/', lang, '/', doc_id, '.html'"
    text = F.expr(
        f"concat(text, ' (', {page}, '), see HTTPS://', lang, '.example.org/?q=', n_chars, '! ', {page}, '.')"
    )
    return docs.select("doc_id", F.explode(textscan.text_links(text)).alias("link"))


_MORE_EMAILS = (
    "(' ' || repeat('long.name', CAST(1 + doc_id % 40 AS INT)) || '@host.example ' || 'n' || doc_id || '@' || repeat('sub.', CAST(1 + doc_id % 30 AS INT))"
    " || 'example.com, a@b.comx_y@' || repeat('q', CAST(1 + doc_id % 90 AS INT)) || '.museums')"
)


@query(
    f"""SELECT DISTINCT k, email FROM (
      SELECT 'd' || doc_id AS k, unnest(regexp_extract_all(text || {_MORE_EMAILS}, {o.EMAIL})) AS email FROM documents
      UNION ALL SELECT 'p' || page_id, unnest(regexp_extract_all(html, {o.EMAIL})) FROM pages
      UNION ALL SELECT 'p' || page_id, unnest(regexp_extract_all({o.html_text('html')}, {o.EMAIL})) FROM pages)"""
)
def emails(spark, sf_dir):
    """Addresses in documents and behind them (long, with many labels), and in pages before and after text extraction."""
    text = F.concat("text", F.expr(_MORE_EMAILS))
    docs = d.texts(spark, sf_dir).select(F.concat(F.lit("d"), "doc_id").alias("k"), F.explode(textscan.emails(text)).alias("email"))
    pages = d.html_pages(spark, sf_dir).select(
        F.concat(F.lit("p"), "page_id").alias("k"),
        F.explode(textscan.emails(F.col("html"), html.html_text(F.col("html")))).alias("email"),
    )
    return docs.unionByName(pages)


# --- language and similarity ------------------------------------------------


@query(o.PROFILE)
def language_profile(spark, sf_dir):
    return language.train_profiles(d.texts(spark, sf_dir, "lang", "text"))


@query(o.PROFILE)
def profile_files(spark, sf_dir):
    """Profiles saved as one JSON object per language and read back."""
    path = scratch_path(spark, "profiles")
    trained = language.train_profiles(d.texts(spark, sf_dir, "lang", "text"))
    index.write_profiles(trained, path)
    return read_profiles(spark, path)


@query(f"WITH profile AS ({o.PROFILE}) {o.detected('profile', 'documents', 'doc_id', 'text')}")
def language_detect(spark, sf_dir):
    docs = d.texts(spark, sf_dir, "lang", "text")
    profiles = write_stage(language.train_profiles(docs), "profiles")
    return language.detect(docs, profiles)


@query(o.digest("documents", "doc_id", "text"))
def simhash_words(spark, sf_dir):
    return simhash.similarity_hash(d.texts(spark, sf_dir), word_hash=simhash.md5_hash)


@query(o.digest("(SELECT 'b' || item_id AS k, text FROM benchmark UNION ALL SELECT 'c' || conv_id || '.' || turn, text FROM conversations)", "k", "text"))
def simhash_by_language(spark, sf_dir):
    """Benchmark items and conversation turns, each with a language tag."""
    items = d.table(spark, sf_dir, "benchmark").selectExpr("concat('b', item_id) AS k", "text")
    turns = d.table(spark, sf_dir, "conversations").selectExpr("concat('c', conv_id, '.', turn) AS k", "text")
    texts = d.spread(items.unionByName(turns), "k")
    tags = texts.select("k", F.when(F.col("text").contains("é"), "fr").otherwise("en").alias("lang"))
    return simhash.similarity_hash_by_language(texts, tags, "k", "text", simhash.md5_hash)


# --- analyzers --------------------------------------------------------------


def _by_term(rows: DataFrame, key: str) -> DataFrame:
    """A token table summed up by term, so that every token counts in the comparison."""
    return rows.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("position").alias("positions"),
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
    )


def _by_term_sql(source: str, key: str, tokens_sql: str) -> str:
    return f"""SELECT t.term AS term, count(*) AS n, CAST(sum(t."position") AS BIGINT) AS positions, min({key}) AS first_key, max({key}) AS last_key
    FROM (SELECT {key}, unnest({tokens_sql}) AS t FROM {source}) GROUP BY 1"""


_NONWORD = "list_filter(regexp_split_to_array(lower({c}), '[^0-9A-Za-z_]+'), lambda x: x <> '')"


def _grams_sql(terms_sql: str, n: int) -> str:
    return f"""flatten(list_transform({terms_sql}, lambda w, i: list_transform(range(1, length(w) - {n} + 2),
      lambda s: {{'term': substr(w, s, {n}), 'position': i - 1}})))"""


@query(
    _by_term_sql(
        "pages",
        "page_id",
        "list_filter("
        + o.numbered("list_filter(regexp_split_to_array(lower(url), '[:/?&=.#]+'), lambda x: x <> '')")
        + ", lambda t: t.term NOT IN ('http', 'https', 'www'))",
    )
)
def tokens_url(spark, sf_dir):
    return _by_term(terms.tokenize(d.html_pages(spark, sf_dir), "page_id", "url", "url", "url"), "page_id")


@query(
    _by_term_sql(
        f"(SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, {o.EMAIL}))) AS email FROM documents)",
        "doc_id",
        o.numbered(_NONWORD.format(c="email")),
    )
)
def tokens_email(spark, sf_dir):
    found = d.texts(spark, sf_dir).select("doc_id", F.explode(textscan.emails(F.col("text"))).alias("email"))
    return _by_term(terms.tokenize(found, "doc_id", "email_addresses", "email", "email"), "doc_id")


@query(_TYPED + _by_term_sql("(SELECT item_name, filename FROM t)", "item_name", _grams_sql(o.words("filename"), 3)))
def tokens_trigram(spark, sf_dir):
    records = record_source.typed(d.document_records(spark, sf_dir)).select("item_name", "filename")
    return _by_term(terms.tokenize(records, "item_name", "filename", "filename", "filename"), "item_name")


@query(
    _by_term_sql(
        f"(SELECT doc_id, list_transform({o.words('text')}, lambda w: substr(w, 1, 5)) AS ws FROM documents)",
        "doc_id",
        "list_transform(range(1, len(ws)), lambda i: {'term': ws[i] || ' ' || ws[i + 1], 'position': i - 1})",
    )
)
def tokens_word_bigram(spark, sf_dir):
    return _by_term(terms.tokenize(d.texts(spark, sf_dir), "doc_id", "body.bigram", "text", "word_bigram"), "doc_id")


@query(_by_term_sql("documents", "doc_id", _grams_sql(_NONWORD.format(c="text"), 2)))
def tokens_char_bigram(spark, sf_dir):
    return _by_term(terms.tokenize(d.texts(spark, sf_dir), "doc_id", "body", "text", "character_bigram"), "doc_id")


@query(_by_term_sql("documents", "doc_id", o.numbered(f"regexp_extract_all(lower(text), {o.LETTERS})")))
def tokens_simple(spark, sf_dir):
    return _by_term(terms.tokenize(d.texts(spark, sf_dir), "doc_id", "body.default", "text", "simple"), "doc_id")


@query(_by_term_sql("documents", "doc_id", o.numbered(o.words("text"))))
def tokens_standard(spark, sf_dir):
    return _by_term(terms.tokenize(d.texts(spark, sf_dir), "doc_id", "misc", "text", "standard"), "doc_id")


_UNSPACED = "text || ' 東京都は' || lang || 'カナの首都 สวัสดี' || CAST(doc_id AS STRING)"
_SPACED = r"regexp_replace(" + _UNSPACED + r", '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]\p{M}*)', ' \1 ', 'g')"


@query(_by_term_sql(f"(SELECT doc_id, {_SPACED} AS spaced FROM documents)", "doc_id", o.numbered(o.words("spaced"))))
def tokens_unspaced(spark, sf_dir):
    """Whole texts with words of scripts without blanks behind them."""
    docs = d.texts(spark, sf_dir, "text", "lang").select("doc_id", F.expr(_UNSPACED).alias("text"))
    return _by_term(terms.tokenize(docs, "doc_id", "body", "text", "standard"), "doc_id")


# A short stop list that both engines can hold.
STOP_WORDS = [
    (analyzer, word)
    for analyzer, text in {
        "english": "the of and to in is that it for with",
        "german": "der die das und ist in den von zu mit",
        "french": "le la les de des et un une que en",
        "spanish": "el la los de que y en un una del",
    }.items()
    for word in text.split()
]


@query(
    f"""WITH a AS (SELECT doc_id, {o.analyzer_of('lang')} AS analyzer, unnest({o.numbered(o.words('text'))}) AS t FROM documents)
    SELECT analyzer, term, count(*) AS n, CAST(sum("position") AS BIGINT) AS positions FROM (SELECT analyzer, t.term AS term, t."position" AS "position" FROM a)
    WHERE (analyzer, term) NOT IN (SELECT analyzer, term FROM {o.values(STOP_WORDS, 'analyzer, term')}) GROUP BY ALL"""
)
def tokens_language(spark, sf_dir):
    docs = language.with_analyzer(d.texts(spark, sf_dir, "lang", "text"), F.col("lang"), language.analyzer_map(spark))
    stop = fixed_table(spark, STOP_WORDS, "analyzer", "term")
    rows = terms.tokenize_language(docs, "doc_id", "body", "text", stop)
    return rows.groupBy("analyzer", "term").agg(F.count(F.lit(1)).alias("n"), F.sum("position").alias("positions"))


@query(f"{_TYPED} SELECT item_name, 'media_type' AS field, media_type AS term, 0 AS \"position\" FROM t WHERE media_type IS NOT NULL")
def tokens_keyword(spark, sf_dir):
    records = record_source.typed(d.document_records(spark, sf_dir))
    return terms.tokenize(records, "item_name", "media_type", "header_media_type", "keyword")


_OFFSETS = """(SELECT doc_id, p, rlike, lower(p) AS term, sum(CAST(rlike AS INTEGER)) OVER w - 1 AS "position",
    sum(length(p)) OVER w AS end_offset FROM (
      SELECT doc_id, i, p, regexp_matches(p, '^[\\p{L}\\p{M}\\p{N}]') AS rlike FROM (
        SELECT doc_id, unnest(list_transform(ps, lambda p, i: {'p': p, 'i': i}), recursive := true) FROM (
          SELECT doc_id, regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}]+|[^\\p{L}\\p{M}\\p{N}]+') AS ps FROM documents)))
    WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""


@query(
    f"""SELECT term, count(*) AS n, CAST(sum("position") AS BIGINT) AS positions, CAST(sum(end_offset - length(p)) AS BIGINT) AS start_offsets,
      CAST(sum(end_offset) AS BIGINT) AS end_offsets FROM {_OFFSETS} WHERE rlike GROUP BY term"""
)
def term_vectors(spark, sf_dir):
    rows = terms.term_vectors(d.texts(spark, sf_dir), "doc_id", "body", "text")
    return rows.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("position").alias("positions"),
        F.sum("start_offset").alias("start_offsets"),
        F.sum("end_offset").alias("end_offsets"),
    )


_BODY_TOKENS = f"(SELECT doc_id, unnest({o.numbered(o.words('text'))}, recursive := true) FROM documents)"


@query(
    f"""SELECT doc_id, 'body' AS field, term, count(*) AS tf, string_agg(CAST("position" AS VARCHAR), ',' ORDER BY "position") AS positions
    FROM {_BODY_TOKENS} GROUP BY doc_id, term"""
)
def postings(spark, sf_dir):
    rows = terms.document_postings(d.texts(spark, sf_dir), "doc_id", "body", "text", "standard")
    return rows.withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), ","))


@query(f"SELECT 'body' AS field, term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM {_BODY_TOKENS} GROUP BY term")
def dictionary(spark, sf_dir):
    return terms.count_terms(d.texts(spark, sf_dir), "body", "text", "standard")


# --- lookups ----------------------------------------------------------------


@query(
    f"""{_TYPED} SELECT item_name FROM t WHERE media_type = 'text/plain'
    UNION ALL SELECT 'by language ' || item_name FROM t WHERE lower(content_language) = 'fr'"""
)
def keyword_lookup(spark, sf_dir):
    docs = record_source.typed(d.document_records(spark, sf_dir)).withColumn(
        "language", language.language_set(F.col("content_language"))
    )
    by_type = lookup.keyword(docs, "header_media_type", "text/plain").select("item_name")
    by_language = lookup.keyword(docs, "language", "fr").select(F.concat(F.lit("by language "), "item_name").alias("item_name"))
    return by_type.unionByName(by_language)


@query(
    f"""{_TYPED} SELECT DISTINCT fingerprint FROM t WHERE fingerprint IS NOT NULL
      AND modified_at BETWEEN TIMESTAMP '2013-04-17 13:00:00' AND TIMESTAMP '2013-04-17 20:00:00'"""
)
def date_range(spark, sf_dir):
    docs = groups.pack_lists(members(spark, sf_dir))
    found = lookup.date_range(
        docs, "date_modified", F.lit("2013-04-17 13:00:00").cast("timestamp"), F.lit("2013-04-17 20:00:00").cast("timestamp")
    )
    return found.select("fingerprint").distinct()


@query(
    f"""{_TYPED} SELECT item_name FROM t WHERE try_cast(content_length AS INTEGER) BETWEEN 500 AND 2000
    UNION ALL SELECT 'blocked ' || item_name FROM t WHERE blocked"""
)
def numeric_filter(spark, sf_dir):
    docs = record_source.typed(d.document_records(spark, sf_dir)).withColumn(
        "size", headers.declared_size(F.col("content_length"))
    )
    in_range = lookup.number_range(docs, "size", 500, 2000).select("item_name")
    blocked = lookup.flag(docs, "blocked", True).select(F.concat(F.lit("blocked "), "item_name").alias("item_name"))
    return in_range.unionByName(blocked)


@query(
    f"""SELECT doc_id, count(*) AS hits FROM {_BODY_TOKENS} WHERE term IN ('the', 'of', 'and')
    GROUP BY doc_id HAVING count(DISTINCT term) = 3"""
)
def match_all_terms(spark, sf_dir):
    rows = terms.tokenize(d.texts(spark, sf_dir), "doc_id", "body", "text", "standard")
    return lookup.all_terms(rows, "body", lookup.query_terms(spark, "The, OF and"), "doc_id")


@query(
    f"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS "position" FROM (
      SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM (SELECT doc_id, {o.words('text')} AS ws FROM documents))
    WHERE ws[i] = 'of' AND ws[i + 1] = 'the'"""
)
def phrase_match(spark, sf_dir):
    rows = terms.tokenize(d.texts(spark, sf_dir), "doc_id", "body", "text", "standard")
    return lookup.phrase(rows, "body", lookup.query_terms(spark, "Of the"), "doc_id")


# --- bodies and sinks -------------------------------------------------------


@query(
    f"""WITH r AS ({o.DOCUMENT_RECORDS}), b AS ({o.DOCUMENT_BODIES}) SELECT item_name, content_key, md5(content) AS digest
    FROM r JOIN b ON trim(item_name, '?/') = content_key"""
)
def body_join(spark, sf_dir):
    rows = body_source.attach_bodies(d.document_records(spark, sf_dir), d.document_bodies(spark, sf_dir))
    return rows.filter("has_body").select("item_name", "content_key", F.md5("content").alias("digest"))


@query(
    f"""WITH r AS ({o.DOCUMENT_RECORDS}), b AS ({o.DOCUMENT_BODIES}) SELECT item_name, 'no body stored' AS reason
    FROM r WHERE trim(item_name, '?/') NOT IN (SELECT content_key FROM b)"""
)
def missing_body(spark, sf_dir):
    rows = body_source.missing_bodies(d.document_records(spark, sf_dir), d.document_bodies(spark, sf_dir))
    return index.reject(rows, "body", "no body stored").select("item_name", "reason")


@query(
    f"""WITH r AS ({o.DOCUMENT_RECORDS}), b AS ({o.DOCUMENT_BODIES}), t AS ({o.typed('SELECT * FROM r')})
    SELECT item_name, CASE WHEN decision = 'yes' THEN 'full' ELSE 'header only' END AS path, content IS NOT NULL AS has_body
    FROM t LEFT JOIN b ON decision = 'yes' AND trim(item_name, '?/') = content_key"""
)
def bodied_union_bodyless(spark, sf_dir):
    records = members(spark, sf_dir)
    full = body_source.attach_bodies(records.filter("decision = 'yes'"), d.document_bodies(spark, sf_dir))
    bare = records.filter("decision <> 'yes'").select("item_name", F.lit("header only").alias("path"), F.lit(False).alias("has_body"))
    return full.select("item_name", F.lit("full").alias("path"), "has_body").unionByName(bare)


_LATIN = r"\A[\x00-\x7F\xA0-\xFF]*\z"


@query(
    """SELECT 'd' || doc_id AS k, md5(text) AS digest FROM documents
    UNION ALL SELECT 'p' || page_id, md5(CASE WHEN page_id % 2 = 0 AND regexp_full_match(html, '[\\x00-\\x7F\\x{A0}-\\x{FF}]*', 's')
      THEN replace(html, 'charset="utf-8"', 'charset="iso-8859-1"') ELSE html END) FROM pages"""
)
def gzip_bodies(spark, sf_dir):
    """All texts and pages as one gzip file each, in three charsets, read back by the charset that each names.

    Texts name theirs in the header; pages name their own and have a wrong header.
    """
    path = scratch_path(spark, "gzip")
    latin = F.col("text").rlike(_LATIN)
    docs = d.texts(spark, sf_dir).select(
        F.concat(F.lit("d"), "doc_id").alias("k"),
        "text",
        F.when(latin & (F.col("doc_id") % 3 == 1), "ISO-8859-1").when(latin & (F.col("doc_id") % 3 == 2), "windows-1252").alias("header_charset"),
    ).withColumn("charset", F.col("header_charset"))
    pages = d.html_pages(spark, sf_dir).withColumnRenamed("html", "text").withColumn("charset", F.when(latin & (F.col("page_id") % 2 == 0), "ISO-8859-1"))
    pages = pages.select(
        F.concat(F.lit("p"), "page_id").alias("k"),
        F.when(F.col("charset").isNull(), F.col("text")).otherwise(F.replace("text", F.lit('charset="utf-8"'), F.lit('charset="iso-8859-1"'))).alias("text"),
        F.lit("utf-16").alias("header_charset"),
        "charset",
    )
    # Characters of Latin-1 have the same bytes in windows-1252.
    encoded = F.when(F.col("charset").isNull(), F.col("text").cast("binary")).otherwise(F.encode("text", "ISO-8859-1"))
    stored = docs.unionByName(pages)
    body_source.write_gzip_bodies(stored.select("k", encoded.alias("value")), path)
    files = body_source.read_gzip_bodies(spark, path).select(
        F.regexp_extract("content_key", "/([^/=]+)=", 1).alias("k"),
        F.expr("substring(bytes, 1, octet_length(bytes) - 1)").alias("bytes"),  # without the writer's line end
    )
    read = files.join(stored.select("k", "header_charset"), "k")
    return read.select("k", F.md5(body_source.body_text(F.col("bytes"), F.col("header_charset"))).alias("digest"))


@query(
    """SELECT id, doc_id, n_chars FROM (SELECT md5(text) AS id, doc_id, n_chars,
      row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1"""
)
def upsert_latest(spark, sf_dir):
    versions = d.table(spark, sf_dir, "documents").select(F.md5("text").alias("id"), "doc_id", "n_chars")
    return index.latest(versions, "id", "doc_id")


@query(
    """SELECT doc_id AS id, 'new' AS state, quality AS value FROM labels
    UNION ALL SELECT doc_id, 'old', n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""
)
def upsert_replace(spark, sf_dir):
    old = d.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.lit("old").alias("state"), F.col("n_chars").alias("value")
    )
    new = d.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.lit("new").alias("state"), F.col("quality").cast("bigint").alias("value")
    )
    return index.upsert(old, new, "id")


@query(f"{_ROLLED} SELECT fingerprint, n_urls > 0 AND n_raw_urls > 0 AS valid FROM g")
def validity_gate(spark, sf_dir):
    rolled = groups.rollup(members(spark, sf_dir))
    good = index.valid_groups(rolled).select("fingerprint", F.lit(True).alias("valid"))
    return good.unionByName(index.invalid_groups(rolled).select("fingerprint", F.lit(False).alias("valid")))


@query(f"SELECT md5(item_name) AS id, url, googlebot_exclusion_reasons FROM ({o.DOCUMENT_RECORDS})")
def strict_schema(spark, sf_dir):
    records = index.strict(d.document_records(spark, sf_dir), CRAWL_RECORD)
    return records.select(F.md5("item_name").alias("id"), "url", "googlebot_exclusion_reasons")


@query(
    f"""{_TYPED} SELECT '{{' || array_to_string(list_filter(['"item_name":"' || item_name || '"', '"media_type":"' || media_type || '"',
      '"charset":"' || charset || '"', '"url":"' || url || '"'], lambda x: x IS NOT NULL), ',') || '}}' AS json FROM t"""
)
def nullable_fields(spark, sf_dir):
    records = record_source.typed(d.document_records(spark, sf_dir)).withColumnsRenamed(
        {"header_media_type": "media_type", "header_charset": "charset"}
    )
    return index.to_json(records, "item_name", "media_type", "charset", "url")


# --- the whole flow ---------------------------------------------------------


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_stage(language.train_profiles(d.texts(spark, sf_dir, "lang", "text")), "profiles")


def _index(spark: SparkSession, sf_dir: str, records: DataFrame, fresh: DataFrame | None = None, profiles: DataFrame | None = None) -> pipeline.Indexed:
    return pipeline.build_documents(
        records,
        d.all_bodies(spark, sf_dir),
        rules(spark),
        profiles if profiles is not None else _profiles(spark, sf_dir),
        language.analyzer_map(spark),
        fresh,
        word_hash=simhash.md5_hash,
    )


def _flat(documents: DataFrame) -> DataFrame:
    """Documents with lists joined to text, dates as ISO text."""

    def date_list(name: str) -> Column:
        return joined(F.transform(name, dates.iso)).alias(name)

    return documents.select(
        "id",
        "part",
        *[joined(c).alias(c) for c in ("url", "raw_url", "filename", "language", "email_addresses", "out_links")],
        *[date_list(c) for c in ("date_discovered", "date_fetched", "date_created", "date_modified")],
        "title",
        F.md5("body").alias("body_digest"),
        "media_type",
        "charset",
        "analyzer",
        F.array_join("authors", "|", "~").alias("authors"),
        F.array_join("misc", "|", "~").alias("misc"),
        "googlebot_blocked",
        "text_length",
        "size",
        "similarity_hash_digest",
        "is_common_type",
    )


_HTML = "lower(media_type) IN ('text/html', 'application/xhtml+xml')"
_TEXT = "(lower(media_type) LIKE 'text/%' OR lower(media_type) IN ('application/json', 'application/xml', 'application/rss+xml', 'application/atom+xml'))"
_PIPELINE = f"""WITH r AS ({o.DOCUMENT_RECORDS} UNION ALL {o.PAGE_RECORDS}), b AS ({o.ALL_BODIES}),
  t AS ({o.typed('SELECT * FROM r')}), g AS ({o.rolled('t')}),
  u AS (SELECT * FROM g WHERE n_urls > 0 AND n_raw_urls > 0 AND NOT malformed),
  j AS (SELECT u.*, content, CASE WHEN regexp_matches(content, '(?i)^\\s*(?:<!doctype html|<html[\\s>])')
      AND header_media_type IS DISTINCT FROM 'application/xhtml+xml' THEN 'text/html' ELSE header_media_type END AS media_type
    FROM u LEFT JOIN b ON indexable AND trim(item_name, '?/') = content_key),
  k AS (SELECT *, CASE WHEN NOT indexable THEN 'bare' WHEN content IS NULL THEN 'missing' WHEN {_HTML} OR {_TEXT} THEN 'ok' ELSE 'unsupported' END AS status FROM j),
  x AS (SELECT *, content AS html, CASE WHEN status = 'ok' AND {_HTML} THEN {o.html_text('content')}
      WHEN status = 'ok' THEN {o.trim('content')} END AS body, status = 'ok' AND {_HTML} AS is_page FROM k),
  profile AS ({o.PROFILE}),
  l AS ({o.detected('profile', 'x', 'fingerprint', 'body')}),
  s AS ({o.digest('x', 'fingerprint', 'body')}),
  y AS (SELECT x.*, l.detected, s.similarity_hash_digest AS h, length(body) > 0 AS has_text,
      CASE WHEN is_page AND length(body) > 0 THEN nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') END AS html_language
    FROM x LEFT JOIN l USING (fingerprint) LEFT JOIN s USING (fingerprint)),
  lists AS (SELECT fingerprint, string_agg(url, '|' ORDER BY fetched_num NULLS FIRST, url, item_name) AS url,
      string_agg(raw_url, '|' ORDER BY fetched_num NULLS FIRST, url NULLS FIRST, item_name) AS raw_url,
      coalesce(string_agg(DISTINCT filename, '|' ORDER BY filename), '') AS filename,
      coalesce(string_agg(strftime(discovered_at, '%Y-%m-%dT%H:%M:%S'), '|' ORDER BY fetched_num NULLS FIRST, url NULLS FIRST, item_name), '') AS date_discovered,
      coalesce(string_agg(strftime(fetched_at, '%Y-%m-%dT%H:%M:%S'), '|' ORDER BY fetched_num NULLS FIRST, url NULLS FIRST, item_name), '') AS date_fetched,
      coalesce(string_agg(strftime(modified_at, '%Y-%m-%dT%H:%M:%S'), '|' ORDER BY fetched_num NULLS FIRST, url NULLS FIRST, item_name), '') AS date_modified
    FROM t GROUP BY fingerprint)"""


def _set_text(items: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter({items}, lambda z: z IS NOT NULL))), '|')"


_PIPELINE_DOCUMENTS = (
    _PIPELINE
    + f""" SELECT y.fingerprint AS id, 0 AS part, lists.url, lists.raw_url, lists.filename,
    {_set_text('[header_language, detected, html_language]')} AS "language",
    {_set_text(f"CASE WHEN status = 'ok' THEN list_concat(regexp_extract_all(content, {o.EMAIL}), regexp_extract_all(body, {o.EMAIL})) ELSE [] END")} AS email_addresses,
    {_set_text(f'''CASE WHEN status = 'ok' THEN list_concat(CASE WHEN is_page AND regexp_matches(base_url, '^https?://') THEN
      list_transform(regexp_extract_all({o.hidden("html")}, '<a href="([^"]*)"', 1),
        lambda q: regexp_extract(base_url, '^https?://[^/?#]+', 0) || {o.unescape("q")}) ELSE [] END,
      list_transform(regexp_extract_all(body, '(?i)https?://[^\\s<>"''(){{}}\\[\\]]+'), lambda q: regexp_replace(q, '[.,;:!?]+$', ''))) ELSE [] END''')} AS out_links,
    lists.date_discovered, lists.date_fetched, '' AS date_created, lists.date_modified,
    CASE WHEN is_page THEN {o.TITLE} END AS title, md5(body) AS body_digest, media_type,
    coalesce(CASE WHEN is_page THEN nullif(regexp_extract(html, '<meta charset="([^"]+)"', 1), '') END, header_charset) AS charset,
    CASE WHEN status = 'ok' THEN {o.analyzer_of('CASE WHEN has_text THEN coalesce(detected, html_language, header_language) ELSE header_language END')} END AS analyzer,
    CASE WHEN status = 'ok' THEN '~|~|~|~' END AS authors, CASE WHEN status = 'ok' THEN '~|~|~|~' END AS misc,
    googlebot_blocked, CAST(CASE WHEN status = 'ok' THEN length(body) ELSE 0 END AS INTEGER) AS text_length,
    CAST(CASE WHEN status = 'ok' THEN greatest(coalesce(try_cast(content_length AS INTEGER), 0), strlen(content), length(body))
      ELSE coalesce(try_cast(content_length AS INTEGER), 0) END AS INTEGER) AS size,
    coalesce(h, 0) AS similarity_hash_digest, status = 'ok' AND coalesce(media_type IN {o.COMMON_LIST}, false) AS is_common_type
  FROM y JOIN lists USING (fingerprint) WHERE status <> 'missing'"""
)


@query(_PIPELINE_DOCUMENTS)
def full_pipeline(spark, sf_dir):
    return _flat(_index(spark, sf_dir, d.all_records(spark, sf_dir)).documents)


@query(
    _PIPELINE_DOCUMENTS
    + f""" AND y.fingerprint IN (SELECT fingerprint FROM t WHERE {_IS_ORIGINAL} AND fetched_num > {MARK})"""
)
def incremental_pipeline(spark, sf_dir):
    """Only the documents that originals fetched after the mark touch."""
    records = d.all_records(spark, sf_dir)
    fresh = record_source.originals(records, MARK)
    return _flat(_index(spark, sf_dir, records, fresh).documents)


@query(
    _PIPELINE
    + """ SELECT item_name, fingerprint, stage, reason FROM (
      SELECT item_name, fingerprint, 'media_type' AS stage, 'unknown media type' AS reason FROM t
        WHERE decision = 'unknown' AND fingerprint IN (SELECT fingerprint FROM g)
      UNION ALL SELECT item_name, fingerprint, 'attributes', 'malformed exclusion reasons' FROM g WHERE malformed
      UNION ALL SELECT item_name, fingerprint, 'validity', 'no address' FROM g WHERE NOT malformed AND NOT (n_urls > 0 AND n_raw_urls > 0)
      UNION ALL SELECT item_name, fingerprint, 'body', 'no body stored' FROM y WHERE status = 'missing'
      UNION ALL SELECT item_name, fingerprint, 'parse', 'unsupported media type' FROM y WHERE status = 'unsupported'
      UNION ALL SELECT item_name, fingerprint, 'language', 'no language detected' FROM y WHERE status = 'ok' AND has_text AND detected IS NULL)"""
)
def full_pipeline_rejects(spark, sf_dir):
    return _index(spark, sf_dir, d.all_records(spark, sf_dir)).rejects


_LINK_TEXT = r"""list_transform(regexp_extract_all(body, '(?i)https?://[^\s<>"''(){}\[\]]+'), lambda u: regexp_replace(u, '[.,;:!?]+$', ''))"""
# The terms of one value, by the analyzer of its field.
_VALUE_TERMS = f"""CASE kind
    WHEN 'url' THEN list_filter({o.numbered("list_filter(regexp_split_to_array(lower(v), '[:/?&=.#]+'), lambda z: z <> '')")}, lambda z: z.term NOT IN ('http', 'https', 'www'))
    WHEN 'filename' THEN {_grams_sql(o.words('v'), 3)}
    WHEN 'email' THEN {o.numbered(_NONWORD.format(c='v'))}
    WHEN 'simple' THEN {o.numbered("regexp_extract_all(lower(v), " + o.LETTERS + ")")}
    WHEN 'bigram' THEN list_transform(list_filter(list_zip({o.words('v')}, {o.words('v')}[2:]), lambda z: z[2] IS NOT NULL),
      lambda z, i: {{'term': substr(z[1], 1, 5) || ' ' || substr(z[2], 1, 5), 'position': i - 1}})
    WHEN 'keyword' THEN [{{'term': v, 'position': 0}}]
    ELSE {o.numbered(o.words('v'))} END"""


@query(
    f"""WITH t AS (SELECT page_id, {o.TITLE} AS title, {o.html_text('html')} AS body, url, html, lower(regexp_extract(html, '<html lang="([a-z]+)"', 1)) AS lang FROM pages),
    a AS (SELECT *, {o.analyzer_of('lang')} AS analyzer FROM t),
    f(page_id, analyzer, field, kind, vs) AS (
      SELECT page_id, '', 'url', 'url', [url] FROM a
      UNION ALL SELECT page_id, '', 'raw_url', 'url', [url] FROM a
      UNION ALL SELECT page_id, '', 'filename', 'filename', [nullif(regexp_extract(url, '^https?://[^/?#]*/([^?#]+)', 1), '')] FROM a
      UNION ALL SELECT page_id, analyzer, 'title', 'language', [title] FROM a
      UNION ALL SELECT page_id, '', 'title.default', 'simple', [title] FROM a
      UNION ALL SELECT page_id, '', 'title.bigram', 'bigram', [title] FROM a
      UNION ALL SELECT page_id, analyzer, 'body', 'language', [body] FROM a
      UNION ALL SELECT page_id, '', 'body.default', 'simple', [body] FROM a
      UNION ALL SELECT page_id, '', 'body.bigram', 'bigram', [body] FROM a
      UNION ALL SELECT page_id, '', 'media_type', 'keyword', ['text/html'] FROM a
      UNION ALL SELECT page_id, '', 'charset', 'keyword', [nullif(regexp_extract(html, '<meta charset="([^"]+)"', 1), '')] FROM a
      UNION ALL SELECT page_id, '', 'language', 'keyword', [lang] FROM a
      UNION ALL SELECT page_id, analyzer, 'authors', 'language', [split_part(split_part(url, '//', 2), '.', 1)] FROM a
      UNION ALL SELECT page_id, '', 'misc', 'standard', ['page ' || page_id || ' & more', 'k' || page_id || ', crawl'] FROM a
      UNION ALL SELECT page_id, '', 'email_addresses', 'email', list_sort(list_distinct(list_concat(regexp_extract_all(html, {o.EMAIL}), regexp_extract_all(body, {o.EMAIL})))) FROM a
      UNION ALL SELECT page_id, '', 'out_links', 'url', list_sort(list_distinct(list_concat(
        list_transform(regexp_extract_all({o.hidden('html')}, '<a href="([^"]*)"', 1), lambda h: regexp_extract(url, '^https?://[^/?#]+', 0) || {o.unescape('h')}), {_LINK_TEXT}))) FROM a),
    v AS (SELECT page_id, analyzer, field, kind, unnest(vs) AS v, generate_subscripts(vs, 1) AS nth FROM f),
    w AS (SELECT page_id, analyzer, field, nth, {_VALUE_TERMS} AS ts FROM v WHERE v IS NOT NULL),
    x AS (SELECT *, coalesce(sum(coalesce(list_max(list_transform(ts, lambda z: z.position)), -1) + 101)
      OVER (PARTITION BY page_id, field ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM w),
    e AS (SELECT analyzer, field, start, unnest(ts, recursive := true) FROM x)
    SELECT field, term, count(*) AS n, CAST(sum("position" + start) AS BIGINT) AS positions FROM e
    WHERE (analyzer, term) NOT IN (SELECT analyzer, term FROM {o.values(STOP_WORDS, 'analyzer, term')}) GROUP BY ALL"""
)
def index_fields(spark, sf_dir):
    """Token rows of all 16 index fields in one pass over the pages, summed up by term."""
    bodies = d.meta_pages(spark, sf_dir).select(
        F.col("page_id").alias("id"),
        F.lit(0).alias("part"),
        F.array("url").alias("url"),
        F.array("url").alias("raw_url"),
        F.array(headers.filename(F.lit(None).cast("string"), F.col("url"))).alias("filename"),
        F.col("url").alias("base_url"),
        F.col("html").alias("content"),
        F.octet_length("html").alias("n_bytes"),
        F.lit(True).alias("has_body"),
        F.lit("text/html").alias("header_media_type"),
        F.lit(None).cast("string").alias("header_charset"),
        F.lit(None).cast("string").alias("content_length"),
        F.timestamp_seconds(F.lit(1366200000)).alias("fetched_at"),
    )
    # Texts are extracted once; three analyzers read them.
    pages = write_stage(extract.extract(bodies).withColumn("language", F.array("html_language")), "index-fields")
    docs = language.with_analyzer(pages, F.element_at("language", 1), language.analyzer_map(spark))
    stop = fixed_table(spark, STOP_WORDS, "analyzer", "term")
    rows = terms.index_tokens(docs, stop)
    return rows.groupBy("field", "term").agg(F.count(F.lit(1)).alias("n"), F.sum("position").alias("positions"))


@query(_PIPELINE_DOCUMENTS.replace("SELECT y.fingerprint AS id, 0 AS part,", "SELECT * EXCLUDE (misc) FROM (SELECT y.fingerprint AS id, 0 AS part,") + ")")
def stored_view(spark, sf_dir):
    documents = _index(spark, sf_dir, d.all_records(spark, sf_dir)).documents
    return _flat(index.stored_view(documents).withColumn("misc", F.array().cast("array<string>"))).drop("misc")


@query(_PIPELINE_DOCUMENTS)
def stream_ingest(spark, sf_dir):
    """The same documents through the incremental job, drained from a folder of record files."""
    source, target = scratch_path(spark, "records"), scratch_path(spark, "stream")
    records = d.all_records(spark, sf_dir)
    records.write.parquet(source)
    profiles = _profiles(spark, sf_dir)
    stored = record_source.read_records(spark, source)
    run = ingest.start(spark, source, target, lambda fresh: _index(spark, sf_dir, stored, fresh, profiles), poll=None)
    run.awaitTermination()
    return _flat(ingest.current_documents(spark, target))
