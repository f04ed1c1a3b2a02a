"""Bytes to text."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

UTF8_NAMES = ("utf-8", "utf8", "us-ascii", "ascii")


def _decode_one(raw: bytes | None, charset: str | None) -> str | None:
    if raw is None or charset is None:
        return None
    raw = bytes(raw)
    if charset in ("utf-16", "utf-32") and not raw.startswith((b"\xff\xfe", b"\xfe\xff", b"\x00\x00\xfe\xff")):
        charset += "-be"  # without a byte-order mark
    try:
        return raw.decode(charset, errors="replace").removeprefix("\ufeff")
    except (LookupError, UnicodeError, ValueError):
        return None


def _decode_batch(raw: pd.Series, charset: pd.Series) -> pd.Series:
    return pd.Series([_decode_one(b, c) for b, c in zip(raw, charset, strict=True)], dtype=object)


def decode(content: Column, charset: Column) -> Column:
    """Text in the named charset, UTF-8 by default; null when the charset is unknown.

    Bytes that are no text in the charset become U+FFFD.  UTF-8 stays in the JVM.
    Spark's own decoder knows few other charsets and fails the job on bad bytes,
    so the rest goes to Python in Arrow batches; UTF-8 rows send nulls there.
    """
    name = F.coalesce(F.lower(F.trim(charset)), F.lit("utf-8"))
    is_utf8 = name.isin(*UTF8_NAMES)
    other = F.pandas_udf(_decode_batch, "string")
    return F.when(is_utf8, F.make_valid_utf8(content.cast("string"))).otherwise(
        other(F.when(~is_utf8, content), F.when(~is_utf8, name))
    )
