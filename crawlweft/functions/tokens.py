"""Index analyzers: text -> array of (term, position), in built-in expressions.

Positions count words, so grams of one word share its position and dropped stop
words leave a gap.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{M}\p{N}]+"
LETTERS = r"\p{L}+"
# Scripts written without blanks: each character is a word of its own.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]\p{M}*"

# Terms the address analyzer drops (fixed values).
URL_STOP = ("http", "https", "www")


def runs(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def has_unspaced(text: Column) -> Column:
    """Whether a text holds script without blanks; texts without any character that high are told by one range."""
    return text.rlike(r"[\x{E00}-\x{10FFFF}]") & text.rlike(UNSPACED)


def words(text: Column) -> Column:
    """Standard words, lower-cased; single characters of scripts without blanks."""
    return runs(F.when(has_unspaced(text), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def _numbered(terms: Column) -> Column:
    return F.transform(terms, lambda t, i: F.struct(t.alias("term"), i.alias("position")))


def _split(text: Column, pattern: str) -> Column:
    return F.filter(F.split(F.lower(text), pattern), lambda t: t != "")


def url(text: Column) -> Column:
    return F.filter(_numbered(_split(text, r"[:/?&=.#]+")), lambda t: ~t["term"].isin(*URL_STOP))


def email(text: Column) -> Column:
    return _numbered(_split(text, r"[^0-9A-Za-z_]+"))


def _grams(terms: Column, n: int) -> Column:
    per_word = F.transform(
        terms,
        lambda w, i: F.when(
            F.length(w) >= n,
            F.transform(
                F.sequence(F.lit(1), F.length(w) - (n - 1)),
                lambda s: F.struct(F.substring(w, s, F.lit(n)).alias("term"), i.alias("position")),
            ),
        ).otherwise(F.expr("cast(array() as array<struct<term: string, position: int>>)")),
    )
    return F.flatten(per_word)


def filename(text: Column) -> Column:
    return _grams(words(text), 3)


def character_bigram(text: Column) -> Column:
    return _grams(_split(text, r"[^0-9A-Za-z_]+"), 2)


def word_bigram(text: Column) -> Column:
    """Pairs of neighbouring words, each cut to five characters."""
    cut = F.transform(words(text), lambda w: F.substring(w, 1, 5))

    def pairs(c: Column) -> Column:
        after = F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0)))
        return F.transform(after, lambda w, i: F.struct(F.concat_ws(" ", F.get(c, i), w).alias("term"), i.alias("position")))

    none = F.expr("cast(array() as array<struct<term: string, position: int>>)")
    return F.coalesce(_let(cut, pairs), none)


def simple(text: Column) -> Column:
    return _numbered(F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0)))


def standard(text: Column) -> Column:
    return _numbered(words(text))


def keyword(value: Column) -> Column:
    """The whole value is one term."""
    return F.when(
        value.isNotNull(), F.array(F.struct(value.alias("term"), F.lit(0).alias("position")))
    )


ANALYZERS = {
    "url": url,
    "email": email,
    "filename": filename,
    "word_bigram": word_bigram,
    "character_bigram": character_bigram,
    "simple": simple,
    "standard": standard,
    "language": standard,  # stop words are dropped by a join, see operators.terms
    "keyword": keyword,
}
