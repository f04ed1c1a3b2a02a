import datetime as dt

import pytest
from pyspark.sql import functions as F

from crawlweft.functions import charsets, dates, headers, html, textscan, tokens
from crawlweft.sources.bodies import content_key

X, Y = F.col("x"), F.col("y")


@pytest.mark.parametrize(
    "given, media_type, charset",
    [
        ("text/html; charset=utf-8", "text/html", "utf-8"),
        (' Text/Plain ;Charset="ISO-8859-1"', "Text/Plain", "ISO-8859-1"),
        ("pdf", "pdf", None),
        ("", None, None),
        (None, None, None),
        ("; charset=x", None, "x"),
    ],
)
def test_content_type(value, given, media_type, charset):
    assert value(headers.media_type(X), x=given) == media_type
    assert value(headers.charset(X), x=given) == charset


@pytest.mark.parametrize(
    "disposition, url, expected",
    [
        ('attachment; filename="a b.xls"', "http://a.example/x/y.html", "a b.xls"),
        ("inline; FILENAME=n.txt; x=1", None, "n.txt"),
        (None, "http://a.example/x/y.html?q=1#f", "x/y.html"),
        (None, "http://a.example/", None),
        (None, "http://a.example", None),
        (None, "no address", None),
        (None, None, None),
        ("attachment", "ftp://h/f", "f"),
    ],
)
def test_filename(value, disposition, url, expected):
    assert value(headers.filename(X, Y), x=disposition, y=url) == expected


@pytest.mark.parametrize("text, size", [("1024", 1024), ("12x", 0), (None, 0), ("99999999999", 0)])
def test_declared_size(value, text, size):
    assert value(headers.declared_size(X), x=text) == size


@pytest.mark.parametrize(
    "reasons, blocked, malformed",
    [("[]", False, False), ('["robots"]', True, False), ("bad", False, True), (None, False, False), ('{"a":1}', False, True)],
)
def test_blocked(value, reasons, blocked, malformed):
    assert value(headers.is_blocked(X), x=reasons) is blocked
    assert value(headers.is_malformed_reasons(X), x=reasons) is malformed


@pytest.mark.parametrize(
    "raw, charset, text",
    [
        ("grün".encode(), None, "grün"),
        ("grün".encode(), "UTF-8", "grün"),
        ("grün".encode("utf-16"), "utf-16", "grün"),
        ("grün €".encode("windows-1252"), "Windows-1252", "grün €"),
        ("мир".encode("koi8-r"), "koi8-r", "мир"),
        ("漢字".encode("shift_jis"), "Shift_JIS", "漢字"),
        (b"a\xffb", "utf-8", "a\ufffdb"),
        (b"\xd8\x61", "utf-16", "\ufffd"),
        (b"abc", "no-such-charset", None),
        (b"abc", "hex", None),
    ],
)
def test_decode(spark, raw, charset, text):
    row = spark.createDataFrame([(bytearray(raw), charset)], "x binary, y string")
    assert row.select(charsets.decode(X, Y)).first()[0] == text


def test_epoch(value):
    assert value(dates.iso(dates.epoch_timestamp(X)), x="1366200000.75") == "2013-04-17T12:00:00"
    assert value(dates.epoch_timestamp(X), x="soon") is None
    assert value(dates.iso(dates.discovered_timestamp(Y, X)), x="1366200000", y=None) == "2013-04-17T12:00:00"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Tue, 15 Nov 1994 08:12:31 GMT", "1994-11-15T08:12:31"),
        ("Tuesday, 15-Nov-94 08:12:31 GMT", "1994-11-15T08:12:31"),
        ("Tuesday, 15-Nov-12 08:12:31 GMT", "2012-11-15T08:12:31"),
        ("Tue Nov 15 08:12:31 1994", "1994-11-15T08:12:31"),
        ("Tue Nov  5 08:12:31 1994", "1994-11-05T08:12:31"),
        ("1994-11-15T08:12:31Z", "1994-11-15T08:12:31"),
        ("1994-11-15T08:12:31+02:00", "1994-11-15T06:12:31"),
        ("15 Nov 1994 08:12:31 +0100", "1994-11-15T07:12:31"),
        ("made 1994-11-15, changed 2001-01-02", "2001-01-02T00:00:00"),
        ("2013-04-17T12:34Z", "2013-04-17T12:34:00"),
        ("2013-04-17T12:34+02:00", "2013-04-17T10:34:00"),
        ("2013-04-17 12:34:56.5", "2013-04-17T12:34:56"),
        ("Wed, 17 Apr 2013 12:00:00 EST", "2013-04-17T17:00:00"),
        ("Wed, 17 Apr 2013 12:00 GMT", "2013-04-17T12:00:00"),
        ("17 April 2013", "2013-04-17T00:00:00"),
        ("April 17, 2013 9:05 CEST", "2013-04-17T07:05:00"),
        ("on May 5, 2013.", "2013-05-05T00:00:00"),
        ("04/17/2013", "2013-04-17T00:00:00"),
        ("4/7/2013 08:30", "2013-04-07T08:30:00"),
        ("Tue Nov 15 08:12:31 EST 1994", "1994-11-15T13:12:31"),
        ("2001-13-02", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_text_date(value, text, expected):
    seen = F.lit(dt.datetime(2013, 4, 17))
    assert value(dates.iso(dates.text_date(X, seen)), x=text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("&uuml;ber &eacute;&rsquo;", "über é’"),
        ("&#38;amp; &amp;lt;", "&amp; &lt;"),
        ("&#0000000228;&#xE4;&#x00000000000E4;", "äää"),
        ("&bogus; &#55296; &#99999999999; & &;", "&bogus; &#55296; &#99999999999; & &;"),
        ("no reference", "no reference"),
        (None, None),
    ],
)
def test_unescape(value, text, expected):
    assert value(html.unescape(X), x=text) == expected


def test_long_addresses(value):
    local, host = "l" * 70, "a.b.c.d.e.f.g.h.i.example.com"
    text = f"{local}@x.example, bob@{host} a@b.comx_y@c.museums {'q' * 20000} @x.y"
    assert value(textscan.emails(X), x=text) == sorted([f"{local}@x.example", f"bob@{host}", "a@b.comx", "_y@c.museums"])


def test_unspaced_words(value):
    assert [t["term"] for t in value(tokens.standard(X), x="Ab東京 都は サ x")] == ["ab", "東", "京", "都", "は", "サ", "x"]


def test_content_key(value):
    assert value(content_key(X), x="?/www.a.example/b?c/?") == "www.a.example/b?c"


PAGE = """<!DOCTYPE html><HTML class=x lang='de-AT'><head><meta charset=utf-8><title> A &amp;
 B </title><style>p{}</style><meta content="d &quot;e&quot;" name="description"><META NAME=author CONTENT='Jo &amp; Co'>
<meta property="article:published_time" content="2013-04-17"></head>
<body><!-- <p>no</p> --><script>if (a<b) "</p>"</script><h1>One</h1><p>t<b>w</b>o &lt;3 &#8364;&#x20AC; &#0; a < b</p>
<ul><li>x</li><li>y</li></ul><a href="/p/../q?r=1&amp;s=2">l</a><a class=k href='t.html#u'>m</a><a href=//h.example/i>n</a>
<a href="mailto:a@b.example">o</a><a href="HTTPS://z.example/">z</a><a href="">e</a><area href="?v"><link href="s.css"></body></html>"""


def test_html_text(value):
    lines = value(html.html_text(X), x=PAGE).split("\n")
    assert lines[:4] == ["One", "two <3 €€ &#0; a < b", "x", "y"]
    assert "no" not in lines and "p{}" not in "".join(lines)


def test_html_fields(value):
    tags = html.meta_tags(X)
    assert value(html.title(X), x=PAGE) == "A & B"
    assert value(html.html_language(X), x=PAGE) == "de-AT"
    assert value(html.html_charset(X), x=PAGE) == "utf-8"
    assert value(html.unescape(html.meta(tags, "description", "og:description")), x=PAGE) == 'd "e"'
    assert value(html.unescape(html.meta(tags, "author")), x=PAGE) == "Jo & Co"
    assert value(html.unescape(html.meta(tags, "article:published_time")), x=PAGE) == "2013-04-17"
    assert value(html.unescape(html.meta(tags, "keywords")), x=PAGE) is None


def test_html_links(value):
    links = value(html.html_links(X, Y), x=PAGE, y="http://a.example/dir/page.html?w#f")
    assert links == sorted(
        [
            "http://a.example/q?r=1&s=2",
            "http://a.example/dir/t.html#u",
            "http://h.example/i",
            "HTTPS://z.example/",
            "http://a.example/dir/page.html?v",
        ]
    )
    assert value(html.html_links(X, Y), x=PAGE, y="not an address") == ["HTTPS://z.example/"]


@pytest.mark.parametrize(
    "href, expected",
    [
        ("g", "http://a/b/c/g"),
        ("./g", "http://a/b/c/g"),
        ("g/", "http://a/b/c/g/"),
        ("/g", "http://a/g"),
        ("//g", "http://g"),
        ("?y", "http://a/b/c/d?y"),
        ("g?y", "http://a/b/c/g?y"),
        ("#s", "http://a/b/c/d?q#s"),
        (".", "http://a/b/c/"),
        ("..", "http://a/b/"),
        ("../g", "http://a/b/g"),
        ("../../g", "http://a/g"),
        ("../../../g", "http://a/g"),
        ("javascript:x()", None),
    ],
)
def test_resolve_link(value, href, expected):
    """The examples of RFC 3986, section 5.4."""
    assert value(html.resolve_link(X, html.base_parts(Y)), x=href, y="http://a/b/c/d?q") == expected


def test_text_links_and_emails(value):
    text = "see http://a.example/x, (https://b.example/y?z=1). Mail: Jo.Do+x@mail.example.com, jo@b.example; no@where"
    assert value(textscan.text_links(X), x=text) == ["http://a.example/x", "https://b.example/y?z=1"]
    assert value(textscan.emails(X, Y), x=text, y="jo@b.example k@l.example") == [
        "Jo.Do+x@mail.example.com",
        "jo@b.example",
        "k@l.example",
    ]
    assert value(textscan.emails(X), x=None) == []


def pairs(rows):
    return [(r["term"], r["position"]) for r in rows]


@pytest.mark.parametrize(
    "analyzer, text, expected",
    [
        ("url", "HTTP://www.A.example/b?c=1#d", [("a", 2), ("example", 3), ("b", 4), ("c", 5), ("1", 6), ("d", 7)]),
        ("email", "Jo.Do@B.example", [("jo", 0), ("do", 1), ("b", 2), ("example", 3)]),
        ("filename", "Ab1/wxyz", [("ab1", 0), ("wxy", 1), ("xyz", 1)]),
        ("word_bigram", "Alpine Houses über", [("alpin house", 0), ("house über", 1)]),
        ("word_bigram", "one", []),
        ("character_bigram", "Abc d", [("ab", 0), ("bc", 0)]),
        ("simple", "It's 2 Übel", [("it", 0), ("s", 1), ("übel", 2)]),
        ("standard", "It's 2 Übel", [("it", 0), ("s", 1), ("2", 2), ("übel", 3)]),
        ("keyword", "Text/HTML x", [("Text/HTML x", 0)]),
    ],
)
def test_analyzers(value, analyzer, text, expected):
    assert pairs(value(tokens.ANALYZERS[analyzer](X), x=text)) == expected


def test_word_pairs_cut_the_text_once(spark):
    plan = spark.range(1).select(F.col("id").cast("string").alias("x")).select(tokens.word_bigram(F.col("x")).alias("q"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_scripts_without_blanks_are_found_in_high_characters(value):
    for text, found in (("größer ação", "false"), ("a 東", "true"), ("ไทย", "true"), ("カ", "true"), ("Ω я € 한", "false"), ("", "false")):
        assert value(tokens.has_unspaced(X).cast("string"), x=text) == found, text
