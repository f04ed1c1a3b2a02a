"""Dates: Unix seconds as text, and free-text header or metadata dates."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

# Zone names in headers and pages, with their offsets.
ZONES = {
    "GMT": "+0000", "UTC": "+0000", "UT": "+0000", "WET": "+0000", "WEST": "+0100", "BST": "+0100", "CET": "+0100",
    "CEST": "+0200", "MEZ": "+0100", "MESZ": "+0200", "EET": "+0200", "EEST": "+0300", "MSK": "+0300",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}

_CLOCK = r"\d{1,2}:\d{2}(?::\d{2})?"
_ZONE = rf"(?: ?(?:{'|'.join(sorted(ZONES, key=len, reverse=True))}|Z|[+-]\d{{2}}:?\d{{2}})(?![0-9A-Za-z]))?"
_MONTH = r"(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]{0,6}"
RFC1123 = rf"\d{{1,2}} {_MONTH}\.?,? \d{{4}}(?:,? {_CLOCK}{_ZONE})?"
RFC850 = rf"\d{{1,2}}-[A-Za-z]{{3}}-\d{{2}} {_CLOCK}{_ZONE}"
ASCTIME = rf"[A-Za-z]{{3}} {{1,2}}\d{{1,2}} {_CLOCK}{_ZONE} \d{{4}}"
AMERICAN = rf"{_MONTH}\.? \d{{1,2}}, \d{{4}}(?:,? {_CLOCK}{_ZONE})?"
SLASHED = rf"\d{{1,2}}/\d{{1,2}}/\d{{4}}(?: {_CLOCK}{_ZONE})?"
ISO8601 = rf"\d{{4}}-\d{{2}}-\d{{2}}(?:[T ]\d{{2}}:\d{{2}}(?::\d{{2}}(?:\.\d+)?)?{_ZONE})?"
ANY_DATE = "|".join((RFC1123, RFC850, ASCTIME, AMERICAN, SLASHED, ISO8601))


def epoch_timestamp(seconds: Column) -> Column:
    """Fractional Unix seconds in text -> timestamp at millisecond precision."""
    return F.timestamp_millis((seconds.try_cast("double") * 1000).cast("bigint"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS)


def discovered_timestamp(discovered: Column, fetched: Column) -> Column:
    return F.when(discovered.isNull(), epoch_timestamp(fetched)).otherwise(
        epoch_timestamp(discovered)
    )


def _parse(text: Column, *patterns: str) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


_NAMED_ZONE = rf"(\d{{2}}) ?({'|'.join(sorted(ZONES, key=len, reverse=True))}|Z|[+-]\d{{2}}:?\d{{2}})( \d{{4}})?$"


def _let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def _offset(zone: Column) -> Column:
    """Seconds that a zone's name or offset lies before UTC; 0 for none and for `Z`."""
    named = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    digits = F.regexp_replace(F.coalesce(F.try_element_at(named, zone), zone), ":", "")
    seconds = (F.substring(digits, 2, 2).try_cast("int") * 60 + F.substring(digits, 4, 2).try_cast("int")) * 60
    return F.coalesce(F.when(digits.startswith("-"), -seconds).otherwise(seconds), F.lit(0))


def text_date(text: Column, seen_at: Column) -> Column:
    """Last date written in `text` as a timestamp; null when there is none.

    Reads RFC 1123, RFC 850, asctime, ISO 8601, dates with a month's name in either order,
    and month/day/year.  Clock times may lack seconds; zones are offsets or the names
    in `ZONES`, UTC by default.  A two-digit year that lands more than fifty years after
    `seen_at` belongs to the century before.
    """
    last = F.regexp_extract(text, r"(?s)^.*(?:^|[^0-9A-Za-z])(" + ANY_DATE + ")", 1)
    # One form: single blanks, no commas or dots behind words, months cut to three letters.
    form = F.regexp_replace(F.regexp_replace(last, " +", " "), r"(?<=[A-Za-z0-9])[.,]+(?= )", "")
    form = F.regexp_replace(form, r"(?<![A-Za-z])([A-Za-z]{3})[a-z]+(?= \d| *$)", "$1")

    def read(t: Column) -> Column:
        zone = F.when(t.contains(":"), F.regexp_extract(t, _NAMED_ZONE, 2)).otherwise("")
        bare = F.when(zone != "", F.regexp_replace(t, _NAMED_ZONE, "$1$3")).otherwise(t)
        clock = F.regexp_replace(bare, r"(?<![:\d])(\d{1,2}:\d{2})(?![:\d])", "$1:00")
        micros = _let(clock, lambda p: F.unix_micros(local(p)))
        return F.timestamp_micros(micros - _offset(zone).cast("long") * 1_000_000)

    def local(p: Column) -> Column:
        short_year = _parse(p, "d-MMM-yy H:mm:ss")
        short_year = F.when(
            short_year > seen_at + F.expr("INTERVAL 50 YEARS"),
            short_year - F.expr("INTERVAL 100 YEARS"),
        ).otherwise(short_year)
        return (
            F.when(p.rlike(r"^\d{1,2} "), _parse(p, "d MMM yyyy H:mm:ss", "d MMM yyyy"))
            .when(p.rlike(r"^\d{1,2}-"), short_year)
            .when(p.rlike(r"^\d{1,2}/"), _parse(p, "M/d/yyyy H:mm:ss", "M/d/yyyy"))
            .when(p.rlike(r"^[A-Za-z]+ \d{1,2} \d{4}"), _parse(p, "MMM d yyyy H:mm:ss", "MMM d yyyy"))
            .when(p.rlike(r"^[A-Za-z]"), _parse(p, "MMM d H:mm:ss yyyy"))
            .otherwise(p.try_cast("timestamp"))
        )

    return F.when(last != "", _let(form, read))
