"""HTTP header values as columns: media type, charset, file names, sizes, flags."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def media_type(content_type: Column) -> Column:
    """`text/html; charset=x` -> `text/html`, case kept; null when there is none."""
    return _or_null(F.regexp_extract(content_type, r"^\s*([^;\s]+)", 1))


def charset(content_type: Column) -> Column:
    return _or_null(
        F.regexp_extract(content_type, r"""(?i)charset\s*=\s*["']?([^\s;"']+)""", 1)
    )


def disposition_filename(disposition: Column) -> Column:
    quoted = F.regexp_extract(disposition, r'(?i)filename\s*=\s*"([^"]*)"', 1)
    bare = F.regexp_extract(disposition, r'(?i)filename\s*=\s*([^";\s]+)', 1)
    return F.coalesce(_or_null(quoted), _or_null(bare))


def url_path(url: Column) -> Column:
    """Path of an address with a known scheme, else null (an address that is no URL)."""
    known = r"(?i)^(?:https?|ftp|file|jar):"
    return F.when(
        url.rlike(known),
        F.regexp_extract(url, r"(?i)^(?:https?|ftp|file|jar):(?://[^/?#]*)?([^?#]*)", 1),
    )


def filename(disposition: Column, url: Column) -> Column:
    """Disposition file name, else the URL path behind its first slash."""
    path = url_path(url)
    from_path = F.when(F.length(path) > 1, F.regexp_replace(path, "^[^/]*/", ""))
    return F.coalesce(disposition_filename(disposition), from_path)


def declared_size(content_length: Column) -> Column:
    """Content-Length as an int; an unreadable one counts as 0."""
    return F.coalesce(content_length.try_cast("int"), F.lit(0))


def final_size(declared: Column, n_bytes: Column, text_length: Column) -> Column:
    return F.greatest(declared, n_bytes, F.coalesce(text_length, F.lit(0)))


def is_blocked(reasons: Column) -> Column:
    """True when the JSON array of exclusion reasons has members; no text is not blocked."""
    return F.coalesce(F.json_array_length(reasons) > 0, F.lit(False))


def is_malformed_reasons(reasons: Column) -> Column:
    return reasons.isNotNull() & F.json_array_length(reasons).isNull()
