"""Links and e-mail addresses in plain text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

LINK = r"""(?i)https?://[^\s<>"'(){}\[\]]+"""
# A local part is looked at once, from where its run of characters starts (or the
# address before it ends), and never given back: the scan stays linear without a bound.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"


def text_links(text: Column) -> Column:
    """Distinct http(s) addresses written in the text, trailing punctuation dropped."""
    found = F.regexp_extract_all(text, F.lit(LINK), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?]+$", ""))))


def emails(*texts: Column) -> Column:
    """Distinct addresses found in any of the texts, sorted."""
    none = F.expr("cast(array() as array<string>)")
    found = [
        F.coalesce(
            F.when(t.contains("@"), F.regexp_extract_all(t, F.lit(EMAIL), F.lit(0))), none
        )
        for t in texts
    ]
    return F.array_sort(F.array_distinct(F.concat(*found)))
