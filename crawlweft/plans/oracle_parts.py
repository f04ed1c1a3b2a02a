"""SQL text shared by the oracle queries: derived tables and repeated steps.

Written for DuckDB over the raw tables, apart from the Spark code it checks.
"""

from crawlweft.functions.html import BLOCK_ELEMENTS, NAMED
from crawlweft.operators.default_rules import SECTIONS
from crawlweft.operators.language import ANALYZER_OF
from crawlweft.operators.media_types import COMMON, INDEXABLE, NON_INDEXABLE
from crawlweft.plans.derived import CONTENT_TYPE_OF, FIRST_FETCH, FIRST_PAGE_FETCH


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple], names: str) -> str:
    body = ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({names}))"


_SECONDS = f"({FIRST_FETCH} + doc_id * 60)"
_FETCH = f"make_timestamp(CAST({_SECONDS} AS BIGINT) * 1000000)"

DOCUMENT_RECORDS = f"""SELECT
  '?' || d.source || '.example.com/' || d.lang || '/' || doc_id || '/' AS item_name,
  CASE WHEN d.source = 'src18' THEN 'copy' ELSE 'self' END AS original,
  CASE WHEN d.source <> 'src19' THEN md5(text) END AS fingerprint,
  CASE WHEN d.source <> 'src17' THEN {_SECONDS} || '.25' END AS fetched,
  CASE WHEN d.lang <> 'de' THEN ({_SECONDS} - 3600) || '.5' END AS discovered,
  CASE WHEN d.source = 'src16' THEN NULL
       WHEN d.source = 'src15' THEN 'not an address'
       WHEN d.source = 'src14' THEN 'http://src14.example.com/'
       ELSE 'http://' || d.source || '.example.com/' || d.lang || '/' || doc_id || '.html?n=' || n_chars END AS url,
  'HTTP://' || upper(d.source) || '.Example.com/' || d.lang || '/' || doc_id || '.html' AS raw_url,
  CASE WHEN d.source = 'src13' THEN 'some day'
       WHEN d.lang = 'en' THEN strftime({_FETCH}, '%a, %d %b %Y %H:%M:%S GMT')
       WHEN d.lang = 'de' THEN strftime({_FETCH}, '%A, %d-%b-%y %H:%M:%S GMT')
       WHEN d.lang = 'fr' THEN strftime({_FETCH}, '%a %b %-d %H:%M:%S %Y')
       ELSE strftime({_FETCH}, '%Y-%m-%dT%H:%M:%SZ') END AS last_modified,
  CASE WHEN d.source = 'src12' THEN n_chars || 'x' ELSE CAST(n_chars AS VARCHAR) END AS content_length,
  t.content_type,
  CASE WHEN d.source = 'src12' THEN upper(d.lang) WHEN d.source = 'src11' THEN NULL
       WHEN d.source = 'src10' THEN 'pt-BR' WHEN d.source = 'src9' THEN 'xx' ELSE d.lang END AS content_language,
  CASE WHEN d.source = 'src8' THEN 'attachment; filename="report ' || doc_id || '.xls"'
       WHEN d.source = 'src7' THEN 'inline; filename=notes' || doc_id || '; x=1' END AS content_disposition,
  CASE WHEN d.lang = 'fr' THEN '["robots","noindex"]' WHEN d.source = 'src6' THEN NULL
       WHEN d.source = 'src5' THEN 'bad' ELSE '[]' END AS googlebot_exclusion_reasons
FROM documents d LEFT JOIN {values(list(CONTENT_TYPE_OF.items()), 'source, content_type')} t ON t.source = d.source"""

_PAGE_SECONDS = f"({FIRST_PAGE_FETCH} + page_id * 60)"
PAGE_RECORDS = f"""SELECT
  '/' || page_id || '.' || regexp_replace(url, '^https?://', '') || '?' AS item_name,
  'self' AS original, md5(html) AS fingerprint, {_PAGE_SECONDS} || '.5' AS fetched, NULL AS discovered,
  url, url AS raw_url, NULL AS last_modified, NULL AS content_length,
  'text/html; charset=utf-8' AS content_type, NULL AS content_language, NULL AS content_disposition,
  '[]' AS googlebot_exclusion_reasons
FROM pages"""

DOCUMENT_BODIES = """SELECT source || '.example.com/' || lang || '/' || doc_id AS content_key, text AS content
FROM documents WHERE source <> 'src4'"""
ALL_BODIES = (
    DOCUMENT_BODIES
    + """ UNION ALL SELECT trim(page_id || '.' || regexp_replace(url, '^https?://', ''), '?/'), html FROM pages"""
)

MEDIA_TYPE = r"nullif(regexp_extract(content_type, '^\s*([^;\s]+)', 1), '')"
CHARSET = r"""nullif(regexp_extract(content_type, '(?i)charset\s*=\s*["'']?([^\s;"'']+)', 1), '')"""


def epoch(column: str) -> str:
    return f"make_timestamp(CAST(floor(CAST({column} AS DOUBLE) * 1000) AS BIGINT) * 1000)"


FILENAME = r"""coalesce(
  nullif(regexp_extract(content_disposition, 'filename\s*=\s*"([^"]*)"', 1), ''),
  nullif(regexp_extract(content_disposition, 'filename\s*=\s*([^";\s]+)', 1), ''),
  nullif(regexp_extract(url, '^https?://[^/?#]*/([^?#]+)', 1), ''))"""

MODIFIED = """CASE
  WHEN last_modified LIKE '%day' THEN NULL
  WHEN last_modified LIKE '____-%' THEN try_strptime(last_modified, '%Y-%m-%dT%H:%M:%SZ')
  WHEN last_modified LIKE '%,%-%' THEN try_strptime(last_modified, '%A, %d-%b-%y %H:%M:%S GMT')
  WHEN last_modified LIKE '%,%' THEN try_strptime(last_modified, '%a, %d %b %Y %H:%M:%S GMT')
  ELSE try_strptime(last_modified, '%a %b %-d %H:%M:%S %Y') END"""

_EXACT = {name: [v for v in vals if not v.endswith("/*")] for name, vals in SECTIONS.items()}
_PRIMARY = {name: [v[:-2] for v in vals if v.endswith("/*")] for name, vals in SECTIONS.items()}


def in_list(items: list[str]) -> str:
    return "(" + ", ".join(quote(v) for v in items) + ")"


def _closed_exact() -> list[str]:
    settled = set(_PRIMARY[INDEXABLE]) | set(_PRIMARY[NON_INDEXABLE])
    known = [v for v in SECTIONS[COMMON] if v not in _EXACT[NON_INDEXABLE] and v.lower().split("/")[0] not in settled]
    return sorted(set(known) | set(_EXACT[INDEXABLE]))


COMMON_LIST = in_list(SECTIONS[COMMON])
DECISION = f"""CASE WHEN media_type IS NULL THEN 'no'
  WHEN split_part(lower(media_type), '/', 1) IN {in_list(_PRIMARY[NON_INDEXABLE])} THEN 'no'
  WHEN lower(media_type) IN {in_list(_EXACT[NON_INDEXABLE])} THEN 'no'
  WHEN split_part(lower(media_type), '/', 1) IN {in_list(_PRIMARY[INDEXABLE])} THEN 'yes'
  WHEN lower(media_type) IN {in_list(_closed_exact())} THEN 'yes'
  ELSE 'unknown' END"""
SETTLED_EXACT = in_list(_EXACT[NON_INDEXABLE])
SETTLED_PRIMARY = in_list(_PRIMARY[NON_INDEXABLE] + _PRIMARY[INDEXABLE])
LISTED_EXACT = in_list(_EXACT[INDEXABLE])

BLOCKED = """(CASE WHEN googlebot_exclusion_reasons LIKE '[%' THEN
  json_array_length(googlebot_exclusion_reasons) > 0 ELSE false END)"""
MALFORMED = "(googlebot_exclusion_reasons IS NOT NULL AND googlebot_exclusion_reasons NOT LIKE '[%')"


def typed(records: str) -> str:
    """Records with the columns read from header text."""
    return f"""SELECT r.*, {DECISION} AS decision FROM (
  SELECT item_name, original, fingerprint, fetched, url, raw_url, content_length, content_language,
    CAST(fetched AS DOUBLE) AS fetched_num, {epoch('fetched')} AS fetched_at,
    {epoch('coalesce(discovered, fetched)')} AS discovered_at, {MODIFIED} AS modified_at,
    {FILENAME} AS filename, {MEDIA_TYPE} AS media_type, {CHARSET} AS charset,
    {BLOCKED} AS blocked, {MALFORMED} AS malformed
  FROM ({records})) r"""


def rolled(typed_name: str) -> str:
    """One row per fingerprint that has an original, from a CTE of typed records."""
    return f"""SELECT fingerprint, max(item_name) FILTER (rl = 1) AS item_name,
    max(fetched_num) FILTER (rl = 1) AS fetched_num, count(*) AS n_records, count(url) AS n_urls,
    count(raw_url) AS n_raw_urls, bool_or(decision = 'yes') AS indexable,
    CASE WHEN bool_or(decision = 'yes') THEN max(media_type) FILTER (ry = 1 AND decision = 'yes')
         ELSE max(media_type) FILTER (rm = 1) END AS header_media_type,
    CASE WHEN bool_or(decision = 'yes') THEN max(charset) FILTER (ry = 1 AND decision = 'yes')
         ELSE max(charset) FILTER (rm = 1) END AS header_charset,
    max(url) FILTER (rf = 1) AS base_url, max(content_length) FILTER (rf = 1) AS content_length,
    lower(max(content_language) FILTER (rf = 1)) AS header_language,
    bool_or(blocked) AS googlebot_blocked, bool_or(malformed) AS malformed,
    min(filename) FILTER (contains(filename, '.')) AS filename_hint
  FROM (SELECT *,
      row_number() OVER (PARTITION BY fingerprint ORDER BY fetched_num NULLS FIRST, url NULLS FIRST, item_name) AS rf,
      row_number() OVER (PARTITION BY fingerprint ORDER BY (CASE WHEN decision = 'yes' THEN 0 ELSE 1 END),
        fetched_num NULLS FIRST, url NULLS FIRST, item_name) AS ry,
      CASE WHEN media_type IS NOT NULL THEN row_number() OVER (PARTITION BY fingerprint ORDER BY (media_type IS NOT NULL) DESC,
        fetched_num DESC NULLS LAST, url DESC NULLS LAST, item_name DESC) END AS rm,
      CASE WHEN original = 'self' AND fetched IS NOT NULL THEN row_number() OVER (PARTITION BY fingerprint
        ORDER BY (original = 'self' AND fetched IS NOT NULL) DESC, fetched_num DESC NULLS LAST, item_name DESC) END AS rl
    FROM {typed_name} WHERE fingerprint IS NOT NULL)
  GROUP BY fingerprint HAVING count(*) FILTER (rl = 1) > 0"""


_REFERENCE = "'&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);'"
_NAMES = ", ".join(quote(name) for name in NAMED)
_TEXTS = ", ".join(quote(text) for text in NAMED.values())


def unescape(column: str) -> str:
    code = """try_cast(CASE WHEN r LIKE '&#x%' OR r LIKE '&#X%' THEN '0x' || regexp_extract(r, '^&#[xX]0*([0-9A-Fa-f]{1,8});$', 1)
      ELSE regexp_extract(r, '^&#0*([0-9]{1,8});$', 1) END AS BIGINT)"""
    char = f"CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr(CAST({code} AS INTEGER)) END"
    named = f"list_extract([{_TEXTS}], list_position([{_NAMES}], r))"
    refs = f"list_transform(regexp_extract_all({column}, {_REFERENCE}), lambda r: coalesce(CASE WHEN r LIKE '&#%' THEN {char} ELSE {named} END, r))"
    pieces = f"regexp_split_to_array({column}, {_REFERENCE})"
    return f"array_to_string(list_transform(list_zip({pieces}, {refs}), lambda z: z[1] || coalesce(z[2], '')), '')"


def trim(column: str) -> str:
    return f"regexp_replace(regexp_replace({column}, '^[\\x00-\\x20]+', ''), '[\\x00-\\x20]+$', '')"


def hidden(column: str) -> str:
    out = f"regexp_replace({column}, '(?s)<!--.*?(?:-->|\\z)', '', 'g')"
    for name in ("script", "style", "noscript", "template"):
        out = f"regexp_replace({out}, '(?is)<{name}(?:\\s[^<>]*)?>.*?(?:</{name}\\s*>|\\z)', '', 'g')"
    return out


def html_text(column: str) -> str:
    out = f"regexp_replace({hidden(column)}, '(?is)<head(?:\\s[^<>]*)?>.*?</head\\s*>', '', 'g')"
    out = f"regexp_replace({out}, '(?i)</?(?:{BLOCK_ELEMENTS})(?:[\\s/][^<>]*)?>', chr(10), 'g')"
    out = f"regexp_replace({out}, '<[A-Za-z/!?][^<>]*>', '', 'g')"
    out = f"regexp_replace({unescape(out)}, '[ \\t\\r\\x0B\\f\\x{{A0}}]+', ' ', 'g')"
    return trim(f"regexp_replace({out}, ' ?\\n[ \\n]*', chr(10), 'g')")


TITLE = "nullif(" + trim(
    "regexp_replace("
    + unescape(r"regexp_extract(html, '(?is)<title(?:\s[^<>]*)?>(.*?)</title\s*>', 1)")
    + r", '\s+', ' ', 'g')"
) + ", '')"
EMAIL = r"'[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}'"
WORD = r"'[\p{L}\p{M}\p{N}]+'"
LETTERS = r"'\p{L}+'"


def numbered(terms: str) -> str:
    """List of terms -> list of structs (term, position)."""
    return f"list_transform({terms}, lambda t, i: {{'term': t, 'position': i - 1}})"


def words(column: str) -> str:
    return f"regexp_extract_all(lower({column}), {WORD})"


def digest(source: str, key: str, text: str) -> str:
    """64-bit word vote over MD5 halves, for a table name or subquery."""

    def half(start: int) -> str:
        return f"CAST('0x' || substr(md5(w), {start}, 8) AS BIGINT)"

    def bits(name: str, first: int) -> str:
        return " + ".join(
            f"(CASE WHEN 2 * sum(({name} >> {i}) & 1) > count(*) THEN CAST({1 << (first + i)} AS HUGEINT) ELSE 0 END)"
            for i in range(32)
        )

    return f"""SELECT {key}, CAST(CASE WHEN d >= CAST({1 << 63} AS HUGEINT) THEN d - CAST({1 << 64} AS HUGEINT) ELSE d END AS BIGINT)
    AS similarity_hash_digest FROM (
    SELECT {key}, {bits('lo', 0)} + {bits('hi', 32)} AS d FROM (
      SELECT {key}, {half(1)} AS hi, {half(9)} AS lo FROM (
        SELECT {key}, unnest({words(text)}) AS w FROM {source})) GROUP BY {key})"""


def ngrams(source: str, key: str, text: str) -> str:
    """(key, n, ngram) rows, one per occurrence."""
    return f"""SELECT {key}, n, substr(w, i, n) AS ngram FROM (
      SELECT {key}, w, unnest(range(1, length(w) + 1)) AS i FROM (
        SELECT {key}, ' ' || unnest(regexp_extract_all({text}, {LETTERS})) || ' ' AS w FROM {source}))
      CROSS JOIN (VALUES (1), (2), (3)) AS ns(n)
    WHERE i + n - 1 <= length(w) AND substr(w, i, n) <> ' '"""


PROFILE = f"""SELECT lang, n, ngram, "count", CAST(total AS BIGINT) AS total FROM (
    SELECT *, sum("count") OVER (PARTITION BY lang, n) AS total,
      sum("count") FILTER (n = 1) OVER (PARTITION BY lang) AS letters
    FROM (SELECT lang, n, ngram, count(*) AS "count" FROM ({ngrams('documents', 'lang', 'text')}) GROUP BY ALL))
  WHERE "count" > letters * (1.0 / 10000)"""


def detected(profile: str, source: str, key: str, text: str) -> str:
    """(key, detected) against the CTE `profile`."""
    return f"""SELECT {key}, arg_max(lang, (score, -rank)) AS detected FROM (
      SELECT {key}, lang, rank, sum(n_seen * w) AS score FROM (
        SELECT {key}, ngram, count(*) AS n_seen FROM ({ngrams(source, key, text)}) GROUP BY ALL) g
      JOIN (SELECT ngram, lang, rank, ln(0.00005 + coalesce(p, 0)) AS w FROM (
          SELECT a.ngram, l.lang, l.rank, (SELECT max("count" / total) FROM {profile} b
            WHERE b.ngram = a.ngram AND b.lang = l.lang) AS p
          FROM (SELECT DISTINCT ngram FROM {profile}) a
          CROSS JOIN (SELECT lang, row_number() OVER (ORDER BY lang) AS rank FROM (SELECT DISTINCT lang FROM {profile})) l)) t
      USING (ngram) GROUP BY ALL) GROUP BY {key}"""


ANALYZERS = values(list(ANALYZER_OF.items()), "lang, analyzer")


def analyzer_of(language: str) -> str:
    cases = " ".join(
        f"WHEN {quote(code)} THEN {quote(name)}" for code, name in ANALYZER_OF.items() if code != "pt-br"
    )
    return (
        f"CASE WHEN {language} LIKE 'pt-br%' THEN 'brazilian' ELSE "
        f"CASE left({language}, 2) {cases} ELSE 'english' END END"
    )
