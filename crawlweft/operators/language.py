"""Language profiles, language detection, and the analyzer of a language.

An n-gram is one to three characters of a word padded with one blank on either
side; the blank alone does not count.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweft.functions.tokens import LETTERS
from crawlweft.operators.staging import BROADCAST_ROWS, broadcast_if_small, write_stage
from crawlweft.sources.lists import fixed_table

# Smoothing added to every probability.
FLOOR = 0.5 / 10_000
# An n-gram stays in a profile when its count is above this share of the
# language's single letters, which also bounds a profile's size.
MIN_SHARE = 1 / 10_000


def _words(documents: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Rows (*keep, w): every word of the whole text, padded."""
    word = F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("w")
    return documents.select(*keep, word).select(*keep, F.concat(F.lit(" "), "w", F.lit(" ")).alias("w"))


def _places(words: DataFrame, *keep: str) -> DataFrame:
    """Rows (*keep, w, i): each place of each word.  No shuffle, and rows stay small."""
    return words.select(*keep, "w", F.explode(F.sequence(F.lit(1), F.length("w"))).alias("i"))


def _grams(words: DataFrame, *keep: str) -> DataFrame:
    """Rows (*keep, n, ngram), one per occurrence."""
    grams = [F.expr(f"CASE WHEN i + {n - 1} <= length(w) THEN substring(w, i, {n}) END") for n in (1, 2, 3)]
    return (
        _places(words, *keep)
        .select(*keep, F.posexplode(F.array(*grams)).alias("n0", "ngram"))
        .filter(F.col("ngram") != " ")
        .select(*keep, (F.col("n0") + 1).alias("n"), "ngram")
    )


def _packed(codes: list[str]) -> str:
    """SQL for one long out of up to three code points of 21 bits, so that joins hash longs, not text."""
    return " | ".join(f"shiftleft({c}, {21 * (len(codes) - 1 - i)})" for i, c in enumerate(codes))


def _keys_at(places: DataFrame, *keep: str) -> DataFrame:
    """Rows (*keep, g1, g2, g3): packed n-grams that begin at place `i` of word `w`, null where there is none or `i` is 0."""
    codes = [F.expr(f"cast(ascii(substring(w, i + {at}, 1)) AS bigint)").alias(f"c{at}") for at in range(3)]
    return places.select(*keep, "i", F.length("w").alias("size"), *codes).select(
        *keep,
        F.expr("CASE WHEN i > 0 AND c0 <> ascii(' ') THEN c0 END").alias("g1"),
        F.expr(f"CASE WHEN i > 0 AND i + 1 <= size THEN {_packed(['c0', 'c1'])} END").alias("g2"),
        F.expr(f"CASE WHEN i > 0 AND i + 2 <= size THEN {_packed(['c0', 'c1', 'c2'])} END").alias("g3"),
    )


def train_profiles(
    documents: DataFrame, lang: str = "lang", text: str = "text", min_share: float = MIN_SHARE
) -> DataFrame:
    """(lang, n, ngram, count, total) from labelled texts.

    Equal words are counted before their n-grams are taken, which leaves a small
    part of the n-grams of running text.  Both counts combine on the map side, so
    neither a hot word nor a hot language skews them.  They are staged, as the
    totals need a second pass.  `total` is taken before rare n-grams go.
    """
    labelled = documents.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    words = _words(labelled, "lang").groupBy("lang", "w").agg(F.count(F.lit(1)).alias("seen"))
    counts = write_stage(
        _grams(words, "lang", "seen").groupBy("lang", "n", "ngram").agg(F.sum("seen").alias("count")), "ngrams"
    )
    totals = counts.groupBy("lang").agg(*[F.sum(F.when(F.col("n") == n, F.col("count"))).alias(f"n{n}") for n in (1, 2, 3)])
    total = F.when(F.col("n") == 1, F.col("n1")).when(F.col("n") == 2, F.col("n2")).otherwise(F.col("n3"))
    return (
        counts.join(broadcast_if_small(totals), "lang")
        .filter(F.col("count") > F.col("n1") * min_share)
        .select("lang", "n", "ngram", "count", total.alias("total"))
    )


def _weights(profiles: DataFrame, languages: list[str], n: int) -> DataFrame:
    """One row per packed n-gram of length `n`: its log-probability in each language, as an array.

    An array keeps the joined rows narrow, so many languages stay in generated code.
    """
    p = F.ln(F.lit(FLOOR) + F.col("count") / F.col("total"))
    floor = F.ln(F.lit(FLOOR))
    codes = [f"cast(ascii(substring(ngram, {at + 1}, 1)) AS bigint)" for at in range(n)]
    return (
        profiles.filter(F.col("n") == n)
        .groupBy(F.expr(_packed(codes)).alias(f"g{n}"))
        .agg(
            F.array(*[F.coalesce(F.max(F.when(F.col("lang") == lang, p)), floor) for lang in languages]).alias(f"w{n}")
        )
    )


MAX_LANGUAGES = 1000
# Size of one table of weights that is still broadcast.
MAX_WEIGHT_BYTES = 256 << 20


def languages_of(profiles: DataFrame) -> list[str]:
    """The profile languages: one short code each, a few dozen as a rule."""
    rows = profiles.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} profile languages")
    return [r.lang for r in rows]


# Weight of the n-grams that begin at one place, and whether any of them is in a profile.
_SUM = "coalesce(w1[{i}], 0D) + coalesce(w2[{i}], 0D) + coalesce(w3[{i}], 0D)"
_KNOWN = "w1 IS NOT NULL OR w2 IS NOT NULL OR w3 IS NOT NULL"


def _weighed(grams: DataFrame, weights: list[DataFrame]) -> DataFrame:
    """Add the weights w1, w2, w3 of the n-grams g1, g2, g3."""
    for n, table in enumerate(weights, 1):
        grams = grams.join(table, f"g{n}", "left")
    return grams


# A word is looked up whole when it is seen this often.
OFTEN = 8


def _frequent_words(words: DataFrame, max_rows: int) -> DataFrame | None:
    """(w): the words seen most often, at most `max_rows`, cut at a power of two of their counts; None without any."""
    counts = write_stage(words.groupBy("w").agg(F.count(F.lit(1)).alias("seen")), "words")
    sizes = counts.agg(*[F.count(F.when(F.col("seen") >= OFTEN << b, 1)) for b in range(40)]).first()
    least, n = next((OFTEN << b, n) for b, n in enumerate(sizes) if n <= max_rows)
    return counts.filter(F.col("seen") >= least).select("w") if n else None


def _word_sums(words: DataFrame, weights: list[DataFrame], languages: list[str]) -> DataFrame:
    """(w, s, s_known): the summed weights of each word's n-grams, and whether any is in a profile."""
    grams = _keys_at(_places(words), "w")
    return _weighed(grams, weights).groupBy("w").agg(
        F.array(*[F.expr(f"sum({_SUM.format(i=i)})") for i in range(len(languages))]).alias("s"),
        F.expr(f"bool_or({_KNOWN})").alias("s_known"),
    )


def detect(
    documents: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, detected): the language with the largest summed log-probability.

    Documents with no n-gram of any profile are absent.  Ties go to the first
    code.  The weights are broadcast after counting them; a document's n-grams
    meet them inside its scan task and collapse to one row of partial sums before
    the shuffle.  Frequent words are summed up once and looked up whole; the
    others take one row per place in the word.  `profiles` should be a stage
    or a file, as it is read more than once.
    """
    languages = languages_of(profiles)
    max_rows = MAX_WEIGHT_BYTES // (64 + 8 * len(languages))
    weights = [broadcast_if_small(_weights(profiles, languages, n), max_rows) for n in (1, 2, 3)]
    words = _words(documents, key, text=text)
    frequent = _frequent_words(words, min(BROADCAST_ROWS, max_rows))
    places = F.sequence(F.lit(1), F.length("w"))
    if frequent is None:
        words = words.withColumn("s", F.lit(None).cast("array<double>")).withColumn("s_known", F.lit(None).cast("boolean"))
    else:
        words = words.join(broadcast_if_small(write_stage(_word_sums(frequent, weights, languages), "word-sums")), "w", "left")
        # A word that was looked up has no places left: its one row meets no weight.
        places = F.when(F.col("s").isNull(), places).otherwise(F.array(F.lit(0)))
    grams = _keys_at(words.select(key, "w", "s", "s_known", F.explode(places).alias("i")), key, "s", "s_known")
    scores = (
        _weighed(grams, weights)
        .groupBy(key)
        .agg(
            *[F.expr(f"sum(CASE WHEN s IS NOT NULL THEN s[{i}] ELSE {_SUM.format(i=i)} END) AS s{i}") for i in range(len(languages))],
            F.expr(f"bool_or(coalesce(s_known, {_KNOWN})) AS known"),
        )
        .filter("known")
    )
    ranked = [
        F.struct(F.col(f"s{i}").alias("score"), F.lit(-i).alias("rank"), F.lit(lang).alias("lang"))
        for i, lang in enumerate(languages)
    ]
    best = F.greatest(*ranked) if len(ranked) > 1 else ranked[0]
    return scores.select(key, best["lang"].alias("detected"))


# Language code -> analyzer name (fixed values).
ANALYZER_OF = {
    "ar": "arabic",
    "hy": "armenian",
    "eu": "basque",
    "pt-br": "brazilian",
    "bg": "bulgarian",
    "ca": "catalan",
    "zh": "chinese",
    "ja": "cjk",
    "ko": "cjk",
    "cs": "czech",
    "da": "danish",
    "nl": "dutch",
    "en": "english",
    "fi": "finnish",
    "fr": "french",
    "gl": "galician",
    "de": "german",
    "el": "greek",
    "hi": "hindi",
    "hu": "hungarian",
    "id": "indonesian",
    "it": "italian",
    "no": "norwegian",
    "fa": "persian",
    "pt": "portuguese",
    "ro": "romanian",
    "ru": "russian",
    "es": "spanish",
    "sv": "swedish",
    "tr": "turkish",
    "th": "thai",
}
DEFAULT_ANALYZER = "english"


def analyzer_map(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, list(ANALYZER_OF.items()), "lang", "analyzer")


def with_analyzer(documents: DataFrame, language: Column, mapping: DataFrame) -> DataFrame:
    """Add `analyzer`, looked up by the first two letters of the language.

    `pt-br...` takes the Brazilian entry; an unknown or missing language takes
    the default.
    """
    tag = F.when(language.startswith("pt-br"), "pt-br").when(F.length(language) >= 2, F.left(language, F.lit(2)))
    keyed = documents.withColumn("_tag", tag)
    return (
        keyed.join(broadcast_if_small(mapping.select(F.col("lang").alias("_tag"), "analyzer")), "_tag", "left")
        .withColumn("analyzer", F.coalesce("analyzer", F.lit(DEFAULT_ANALYZER)))
        .drop("_tag")
    )


def primary_language(detected: Column, html_language: Column, header_language: Column) -> Column:
    return F.coalesce(F.lower(detected), F.lower(html_language), F.lower(header_language))


def language_set(*tags: Column) -> Column:
    """Distinct lower-cased tags, nulls skipped."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.lower(t) for t in tags]))))
