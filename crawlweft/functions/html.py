"""Text, metadata and links of HTML pages, as regular-expression columns.

Everything stays in built-in expressions, so a page costs no shuffle.  Inside a
tag the patterns stop at the next angle bracket, so broken markup stays linear.
"""

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that end a line of text (fixed values).
BLOCK_ELEMENTS = (
    "address|article|aside|blockquote|body|br|center|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul"
)

# Named character references, from the standard library's table of HTML 5.
NAMED = {f"&{name}": text for name, text in html5.items() if name.endswith(";")}
REFERENCE = r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"

HTML_TYPES = ("text/html", "application/xhtml+xml")


def is_html(media_type: Column) -> Column:
    return F.coalesce(media_type.isin(*HTML_TYPES), F.lit(False))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _character(ref: Column) -> Column:
    """Text of one reference such as `&#8364;`, `&#x20AC;` or `&euro;`; null for an impossible one."""
    digits = F.regexp_extract(ref, r"^&#[xX]?0*([0-9A-Fa-f]{1,8});$", 1)
    code = F.when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "utf-32")
    # One literal, which the optimizer reads once, instead of thousands of them.
    named = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")
    return F.when(ref.startswith("&#"), char).otherwise(F.try_element_at(named, ref))


def unescape(text: Column) -> Column:
    """Decode all character references, each once and from left to right; unknown ones stay as written."""

    def decode(t: Column) -> Column:
        refs = F.transform(F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0)), lambda r: F.coalesce(_character(r), r))
        whole = F.array_join(F.zip_with(F.split(t, REFERENCE, -1), refs, lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")
        return F.when(t.rlike(REFERENCE), whole).otherwise(t)

    return _let(text, decode)


def strip_hidden(html: Column) -> Column:
    """Drop comments and what is never shown: scripts, styles, templates.

    One that is never closed runs to the end of the page, as in a browser; this
    also keeps the scan linear.
    """
    out = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")
    for name in ("script", "style", "noscript", "template"):
        out = F.regexp_replace(out, rf"(?is)<{name}(?:\s[^<>]*)?>.*?(?:</{name}\s*>|\z)", "")
    return out


def trim_text(text: Column) -> Column:
    """Cut control characters and blanks from both ends, in linear time."""
    return F.btrim(text, F.lit("".join(map(chr, range(0x21)))))


def visible_text(visible: Column) -> Column:
    """Text of a page without hidden elements, one line per block element."""
    out = F.regexp_replace(visible, r"(?is)<head(?:\s[^<>]*)?>.*?</head\s*>", "")
    out = F.regexp_replace(out, rf"(?i)</?(?:{BLOCK_ELEMENTS})(?:[\s/][^<>]*)?>", "\n")
    out = F.regexp_replace(out, r"<[A-Za-z/!?][^<>]*>", "")
    out = F.regexp_replace(unescape(out), r"[ \t\r\x0B\f\x{A0}]+", " ")
    return trim_text(F.regexp_replace(out, r" ?\n[ \n]*", "\n"))


def html_text(html: Column) -> Column:
    return visible_text(strip_hidden(html))


def title(html: Column) -> Column:
    raw = F.regexp_extract(html, r"(?is)<title(?:\s[^<>]*)?>(.*?)</title\s*>", 1)
    return _or_null(trim_text(F.regexp_replace(unescape(raw), r"\s+", " ")))


def html_language(html: Column) -> Column:
    return _or_null(
        F.regexp_extract(html, r"""(?i)<html\s[^<>]*?\blang\s*=\s*["']?([A-Za-z0-9_-]+)""", 1)
    )


def html_charset(html: Column) -> Column:
    return _or_null(
        F.regexp_extract(html, r"""(?i)<meta\s[^<>]*?charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", 1)
    )


def meta_tags(html: Column) -> Column:
    """All `<meta name or property ...>` tags of a page, as one short text."""
    found = F.regexp_extract_all(html, F.lit(r"(?i)<meta\s[^<>]*?\b(?:name|property)\s*=[^<>]*>"), F.lit(0))
    return F.array_join(found, "")


def meta(tags: Column, *names: str) -> Column:
    """Content of the first tag in `meta_tags` text whose name is among `names`, as written (see `unescape`)."""
    key = rf"""(?:name|property)\s*=\s*["']?(?:{'|'.join(n.replace('.', '[.]') for n in names)})["'\s/>]"""
    value = r"""content\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    tag = F.regexp_extract(tags, rf"(?i)<meta\s(?:[^<>]*\s)?{key}[^<>]*>?|<meta\s[^<>]*\s{key}[^<>]*>?", 0)
    quoted = F.regexp_extract(tag, rf"(?i)\s{value}", 1)
    return F.when(tags != "", _or_null(F.regexp_replace(quoted, r"""^["']|["']$""", "")))


_URL_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)(\?[^#]*)?"


def base_parts(base: Column) -> Column:
    """(scheme, root, path, query) of an http(s) page address, else null."""
    scheme = F.lower(F.regexp_extract(base, _URL_PARTS, 1))
    return F.when(
        base.rlike(r"(?i)^https?://"),
        F.struct(
            scheme.alias("scheme"),
            F.concat(scheme, F.lit("://"), F.regexp_extract(base, _URL_PARTS, 2)).alias("root"),
            F.regexp_extract(base, _URL_PARTS, 3).alias("path"),
            F.regexp_extract(base, _URL_PARTS, 4).alias("query"),
        ),
    )


def _no_dots(path: Column) -> Column:
    """Resolve `.` and `..` segments of an absolute path."""

    def step(acc: Column, seg: Column) -> Column:
        return (
            F.when(seg == ".", acc)
            .when(seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
            .otherwise(F.concat(acc, F.array(seg)))
        )

    def resolve(p: Column) -> Column:
        parts = F.aggregate(F.split(p, "/"), F.expr("cast(array() as array<string>)"), step)
        end = F.when(p.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
        return F.when(p.contains("/."), F.concat(F.array_join(parts, "/"), end)).otherwise(p)

    return _let(path, resolve)


def resolve_link(href: Column, base: Column) -> Column:
    """Absolute http(s) address of a link on the page `base_parts`; null for other schemes."""
    root, path = base["root"], base["path"]
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    link_path = F.regexp_extract(href, r"^[^?#]*", 0)
    link_rest = F.regexp_extract(href, r"(?s)[?#].*$", 0)
    full_path = F.when(href.startswith("/"), link_path).otherwise(F.concat(folder, link_path))
    return (
        F.when(href.rlike(r"(?i)^https?://"), href)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | base.isNull() | (href == ""), F.lit(None).cast("string"))
        .when(href.startswith("//"), F.concat(base["scheme"], F.lit(":"), href))
        .when(href.startswith("#"), F.concat(root, path, base["query"], href))
        .when(href.startswith("?"), F.concat(root, path, href))
        .otherwise(F.concat(root, _no_dots(full_path), link_rest))
    )


def visible_links(visible: Column, base: Column) -> Column:
    """Distinct absolute targets of the anchors of a page without hidden elements, sorted."""
    anchors = F.regexp_extract_all(
        visible,
        F.lit(r"""(?i)<(?:a|area)\s(?:[^<>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""),
        F.lit(1),
    )
    hrefs = F.transform(anchors, lambda a: trim_text(unescape(F.regexp_replace(a, r"""^["']|["']$""", ""))))
    links = _let(base_parts(base), lambda b: F.transform(hrefs, lambda h: resolve_link(h, b)))
    return F.array_sort(F.array_distinct(F.array_compact(links)))


def html_links(html: Column, base: Column) -> Column:
    return visible_links(strip_hidden(html), base)
