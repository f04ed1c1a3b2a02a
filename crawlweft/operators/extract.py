"""Bodies -> text, metadata, links and e-mail addresses.

Reads HTML and text; other formats keep their header fields and are reported.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweft.functions import dates, headers, html, textscan

# Types read as they stand, besides text/*, message/* and multipart/* (fixed values).
TEXT_TYPES = ("application/json", "application/xml", "application/rss+xml", "application/atom+xml")

OK, MISSING, UNSUPPORTED, CHARSET = "ok", "missing", "unsupported", "charset"

_LOOKS_HTML = r"(?i)^[\s\x{FEFF}]*(?:<!doctype html|<html[\s>])"


def is_text(media_type: Column) -> Column:
    low = F.lower(media_type)
    return F.coalesce(
        low.startswith("text/") | low.startswith("message/") | low.startswith("multipart/") | low.isin(*TEXT_TYPES),
        F.lit(False),
    )


def extracted_media_type(content: Column, header: Column) -> Column:
    """What the content itself says: HTML when it opens like HTML, else nothing."""
    return F.when(content.rlike(_LOOKS_HTML) & ~F.coalesce(header == "application/xhtml+xml", F.lit(False)), "text/html")


def extract(pages: DataFrame) -> DataFrame:
    """Add the content fields to pages with `content`, header fields and `base_url`.

    A narrow projection: the raw content leaves the plan here.
    """
    content = F.col("content")
    out = pages.withColumn(
        "media_type",
        F.when(
            F.col("has_body"),
            F.coalesce(extracted_media_type(content, F.col("header_media_type")), "header_media_type"),
        ).otherwise(F.col("header_media_type")),
    ).withColumn("_html", html.is_html(F.lower("media_type")))
    out = out.withColumn(
        "status",
        F.when(~F.col("has_body"), MISSING)
        .when(content.isNull(), CHARSET)
        .when(F.col("_html") | is_text(F.col("media_type")), OK)
        .otherwise(UNSUPPORTED),
    )
    ok = F.col("status") == OK
    # Each of these is used several times below, so it gets its own step.
    out = out.withColumn("_page", F.when(ok & F.col("_html"), content))
    out = out.withColumns({"_visible": html.strip_hidden(F.col("_page")), "_tags": html.meta_tags(F.col("_page"))})
    out = out.withColumn(
        "body", F.coalesce(html.visible_text(F.col("_visible")), F.when(ok, html.trim_text(content)))
    )

    def meta(*names: str) -> Column:
        return html.meta(F.col("_tags"), *names)

    # Decoded together, in one expression.
    fields = (
        meta("author"),
        meta("dc.creator", "dcterms.creator"),
        meta("dc.contributor", "dcterms.contributor"),
        meta("last-author", "dcterms.modifier"),
        meta("comments"),
        meta("description", "og:description"),
        meta("dc.source", "source"),
        meta("keywords"),
    )
    out = out.withColumn("_fields", F.when(ok, F.transform(F.array(*fields), html.unescape)))
    out = out.withColumns(
        {
            "charset": F.coalesce(html.html_charset(F.col("_page")), F.col("header_charset")),
            "title": html.title(F.col("_page")),
            "html_language": F.lower(html.html_language(F.col("_page"))),
            "authors": F.slice("_fields", 1, 4),
            "misc": F.slice("_fields", 5, 4),
            "meta_created": dates.text_date(
                meta("dcterms.created", "creation-date", "article:published_time"), F.col("fetched_at")
            ),
            "meta_modified": dates.text_date(
                meta("dcterms.modified", "last-modified", "article:modified_time"), F.col("fetched_at")
            ),
            "page_links": html.visible_links(F.col("_visible"), F.col("base_url")),
        }
    )
    none = F.expr("cast(array() as array<string>)")
    return out.withColumns(
        {
            "out_links": F.when(
                ok,
                F.array_sort(
                    F.array_union(F.coalesce("page_links", none), textscan.text_links(F.col("body")))
                ),
            ),
            # Plain text holds the same addresses as its trimmed body, so only pages are read twice.
            "email_addresses": F.when(ok & F.col("_html"), textscan.emails(content, F.col("body"))).when(
                ok, textscan.emails(content)
            ),
            "text_length": F.when(ok, F.length("body")).otherwise(0),
            "size": F.when(
                ok,
                headers.final_size(
                    headers.declared_size(F.col("content_length")), F.col("n_bytes"), F.length("body")
                ),
            ).otherwise(headers.declared_size(F.col("content_length"))),
        }
    ).drop("content", "_html", "_page", "_visible", "_tags", "_fields", "page_links", "n_bytes", "content_key")
