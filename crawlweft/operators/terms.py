"""Token tables, term vectors and postings."""

import re

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlweft.functions import tokens
from crawlweft.operators.staging import broadcast_if_small
from crawlweft.sources.lists import fixed_table

# Index field -> (document column, analyzer).  "language" is the analyzer that
# the document itself names.
INDEX_FIELDS = {
    "url": ("url", "url"),
    "raw_url": ("raw_url", "url"),
    "filename": ("filename", "filename"),
    "title": ("title", "language"),
    "title.default": ("title", "simple"),
    "title.bigram": ("title", "word_bigram"),
    "body": ("body", "language"),
    "body.default": ("body", "simple"),
    "body.bigram": ("body", "word_bigram"),
    "media_type": ("media_type", "keyword"),
    "charset": ("charset", "keyword"),
    "language": ("language", "keyword"),
    "authors": ("authors", "language"),
    "misc": ("misc", "standard"),
    "email_addresses": ("email_addresses", "email"),
    "out_links": ("out_links", "url"),
}

# Languages whose stop words ship with Spark (fixed values).
STOP_WORD_LANGUAGES = (
    "danish",
    "dutch",
    "english",
    "finnish",
    "french",
    "german",
    "hungarian",
    "italian",
    "norwegian",
    "portuguese",
    "russian",
    "spanish",
    "swedish",
    "turkish",
)


def default_stop_words(spark: SparkSession) -> DataFrame:
    """(analyzer, term) from the lists that ship with Spark: some 3,000 fixed rows.

    Words are cut at apostrophes, as texts are.
    """
    lists = {a: a for a in STOP_WORD_LANGUAGES} | {"brazilian": "portuguese"}
    rows = {(a, part) for a, name in lists.items() for w in StopWordsRemover.loadDefaultStopWords(name) for part in re.split("['’]", w.lower()) if part}
    return fixed_table(spark, sorted(rows), "analyzer", "term")


def tokenize(documents: DataFrame, key: str, field: str, column: str, analyzer: str) -> DataFrame:
    """(key, field, term, position) of one text column."""
    return documents.select(
        key, F.lit(field).alias("field"), F.explode(tokens.ANALYZERS[analyzer](F.col(column))).alias("t")
    ).select(key, "field", "t.term", "t.position")


def drop_stop_words(rows: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Drop the stop words of each row's `analyzer`; positions keep their gaps.

    Stop words are the hottest terms there are, so their list is broadcast after
    counting it rather than meeting the tokens in a shuffle.
    """
    return rows.join(broadcast_if_small(stop_words), ["analyzer", "term"], "left_anti")


def tokenize_language(
    documents: DataFrame, key: str, field: str, column: str, stop_words: DataFrame
) -> DataFrame:
    """(key, analyzer, field, term, position), by the analyzer that each document names."""
    rows = documents.select(
        key, F.col("analyzer"), F.lit(field).alias("field"), F.explode(tokens.standard(F.col(column))).alias("t")
    ).select(key, "analyzer", "field", "t.term", "t.position")
    return drop_stop_words(rows, stop_words).select(key, "analyzer", "field", "term", "position")


# Positions of a list's next value start this far behind the value before.
VALUE_GAP = 100


def _field_tokens(column: Column, is_list: bool, analyzer: str) -> Column:
    if not is_list:
        return tokens.ANALYZERS[analyzer](column)
    token = "struct<term:string,position:int>"
    values = F.transform(F.array_compact(column), lambda v: tokens.ANALYZERS[analyzer](v).cast(f"array<{token}>"))

    def append(acc: Column, value: Column) -> Column:
        start = acc["next"]
        moved = F.transform(
            value, lambda t: F.struct(t["term"].alias("term"), (t["position"] + start).cast("int").alias("position"))
        )
        last = F.coalesce(F.array_max(F.transform(value, lambda t: t["position"])), F.lit(-1))
        return F.struct(
            (start + last + 1 + VALUE_GAP).cast("int").alias("next"), F.concat(acc["tokens"], moved).alias("tokens")
        )

    start = F.struct(F.lit(0).alias("next"), F.array().cast(f"array<{token}>").alias("tokens"))
    return F.aggregate(values, start, append, lambda acc: acc["tokens"])


def index_tokens(documents: DataFrame, stop_words: DataFrame, key: str = "id") -> DataFrame:
    """Token rows of every index field: (key, part, field, term, position).

    One scan of the documents yields all fields.
    """
    types = {f.name: f.dataType.typeName() for f in documents.schema.fields}
    fields = [
        F.struct(
            F.lit(field).alias("field"),
            F.lit(analyzer == "language").alias("stops"),
            _field_tokens(F.col(column), types[column] == "array", analyzer).alias("tokens"),
        )
        for field, (column, analyzer) in INDEX_FIELDS.items()
        if column in types
    ]
    rows = (
        documents.select(key, "part", "analyzer", F.explode(F.array(*fields)).alias("f"))
        .select(
            key, "part", F.when(F.col("f.stops"), F.col("analyzer")).alias("analyzer"), "f.field", F.explode("f.tokens").alias("t")
        )
        .select(key, "part", "analyzer", "field", "t.term", "t.position")
    )
    return drop_stop_words(rows, stop_words).select(key, "part", "field", "term", "position")


def _by_repeats(documents: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Documents whose key no other document has, and the others; only keys move.  A null key counts as repeated."""
    repeated = documents.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(key).alias("_repeated"))
    repeated = broadcast_if_small(repeated.filter(F.col("_repeated").isNotNull()))
    named = documents.filter(F.col(key).isNotNull())
    same = F.col(key) == F.col("_repeated")
    again = named.join(repeated, same, "left_semi").unionByName(documents.filter(F.col(key).isNull()))
    return named.join(repeated, same, "left_anti"), again


#: Pieces of a text whose lengths are summed up at a time.
_CHUNK = 64


def _running_sums(sizes: Column) -> Column:
    """Sums of the values up to and with each one: within chunks first, so that long arrays are not copied for each value."""
    none = F.expr("cast(array() as array<int>)")

    def sums(values: Column, start: Column) -> Column:
        last = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1)), start)
        return F.aggregate(values, none, lambda acc, x: F.concat(acc, F.array(last(acc) + x)))

    def chunked(x: Column) -> Column:
        at = F.when(F.size(x) > 0, F.sequence(F.lit(1), F.size(x), F.lit(_CHUNK))).otherwise(none)
        parts = F.transform(at, lambda i: sums(F.slice(x, i, F.lit(_CHUNK)), F.lit(0)))
        return _let(parts, lambda p: _let(sums(F.transform(p, lambda c: F.element_at(c, -1)), F.lit(0)), lambda ends: F.flatten(
            F.transform(p, lambda c, i: F.transform(c, lambda v: v + F.when(i > 0, F.get(ends, i - 1)).otherwise(0))))))

    return _let(sizes, chunked)


def _let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


_PIECE = rf"{tokens.WORD}|[^\p{{L}}\p{{M}}\p{{N}}]+"
_IS_WORD = rf"^{tokens.WORD}"


def term_vectors(documents: DataFrame, key: str, field: str, column: str) -> DataFrame:
    """(key, field, term, position, start_offset, end_offset) of standard words.

    The text is cut into alternating words and gaps whose running length gives
    the offsets, inside the document's row; nothing of it moves.  Documents that
    share a key count as one text: they are partitioned by key while still whole,
    and a window runs over their pieces.
    """
    rows = documents.select(key, column)
    once, again = _by_repeats(rows, key)
    pieces = once.select(key, F.regexp_extract_all(F.col(column), F.lit(_PIECE), F.lit(0)).alias("pieces"))
    ends = pieces.select(key, "pieces", _running_sums(F.transform("pieces", F.length)).alias("ends"))
    # Words and gaps take turns, so the first piece tells which of them are words.
    first = F.when(F.get("pieces", F.lit(0)).rlike(_IS_WORD), 0).otherwise(1)
    found = (
        ends.select(key, first.alias("first"), F.posexplode(F.arrays_zip("pieces", "ends")).alias("at", "e"))
        .filter(F.col("at") % 2 == F.col("first"))
        .select(key, F.col("e.pieces").alias("piece"), F.floor(F.col("at") / 2).cast("bigint").alias("position"), F.col("e.ends").cast("bigint").alias("end_offset"))
    )
    shown = found.unionByName(_pieces_of_repeated(again, key, column))
    return shown.select(
        key,
        F.lit(field).alias("field"),
        F.lower("piece").alias("term"),
        "position",
        (F.col("end_offset") - F.length("piece")).alias("start_offset"),
        "end_offset",
    )


def _pieces_of_repeated(documents: DataFrame, key: str, column: str) -> DataFrame:
    """(key, piece, position, end_offset) of the words of documents that may share a key."""
    piece = F.regexp_extract_all(F.col(column), F.lit(_PIECE), F.lit(0))
    pieces = documents.repartition(key).select(key, F.posexplode(piece).alias("at", "piece"))
    so_far = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_word = F.col("piece").rlike(_IS_WORD)
    return (
        pieces.withColumns(
            {
                "end_offset": F.sum(F.length("piece")).over(so_far),
                "position": F.sum(F.when(is_word, 1).otherwise(0)).over(so_far) - 1,
            }
        )
        .filter(is_word)
        .select(key, "piece", "position", "end_offset")
    )


def postings(token_rows: DataFrame, *key: str) -> DataFrame:
    """(key, field, term, tf, positions): positions of a term within one document.

    `key` is `id` and `part` by default, as positions of different parts are unrelated.

    Tokens of a table partitioned by key (`repartition(key)` before tokenizing)
    are grouped without another shuffle.
    """
    return token_rows.groupBy(*(key or ("id", "part")), "field", "term").agg(
        F.count(F.lit(1)).alias("tf"), F.array_sort(F.collect_list("position")).alias("positions")
    )


def document_postings(documents: DataFrame, key: str, field: str, column: str, analyzer: str) -> DataFrame:
    """As `postings` of the tokens of one text column, grouped inside each document's row, so that no token moves.

    Only documents that share a key are partitioned by it, and their tokens grouped across rows.
    """
    once, again = _by_repeats(documents.select(key, column), key)
    found = once.select(key, F.array_sort(tokens.ANALYZERS[analyzer](F.col(column))).alias("t"))

    def grouped(t: Column) -> Column:
        none = F.expr("cast(array() as array<int>)")
        places = F.when(F.size(t) > 0, F.sequence(F.lit(0), F.size(t) - 1)).otherwise(none)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(t, i)["term"] != F.get(t, i - 1)["term"]))

        def entry(s: Column) -> Column:
            size = lambda at, i: F.coalesce(F.get(s, i + 1), F.size(t)) - at
            return F.transform(
                s,
                lambda at, i: F.struct(
                    F.get(t, at)["term"].alias("term"),
                    size(at, i).cast("bigint").alias("tf"),
                    F.transform(F.slice(t, at + 1, size(at, i)), lambda x: x["position"]).alias("positions"),
                ),
            )

        return _let(starts, entry)

    rows = found.select(key, F.explode(_let(F.col("t"), grouped)).alias("e")).select(
        key, F.lit(field).alias("field"), "e.term", "e.tf", "e.positions"
    )
    others = postings(tokenize(again.repartition(key), key, field, column, analyzer), key)
    return rows.unionByName(others.select(*rows.columns))


def count_terms(documents: DataFrame, field: str, column: str, analyzer: str) -> DataFrame:
    """(field, term, df, cf) straight from whole texts, which do not move: only terms do, combined first."""
    found = F.transform(tokens.ANALYZERS[analyzer](F.col(column)), lambda t: t["term"])
    once = lambda terms, df, cf: F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(df).alias("df"), F.lit(cf).alias("cf")))
    rows = documents.select(found.alias("t")).select(F.explode(F.concat(once(F.col("t"), 0, 1), once(F.array_distinct("t"), 1, 0))).alias("e"))
    return rows.groupBy(F.lit(field).alias("field"), F.col("e.term").alias("term")).agg(F.sum("e.df").alias("df"), F.sum("e.cf").alias("cf"))


def dictionary(posting_rows: DataFrame) -> DataFrame:
    """(field, term, df, cf).  Counts combine on the map side, so hot terms do not skew."""
    return posting_rows.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")
    )
