"""64-bit similarity hash of a text's words."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweft.functions import tokens

# Languages written without blanks between words (fixed values): their features
# are pairs of neighbouring characters.
UNSPACED = ("ja", "th", "zh")


def fast_hash(word: Column) -> Column:
    return F.xxhash64(word)


def md5_hash(word: Column) -> Column:
    """Upper 64 bits of the MD5 digest; slower, but any SQL engine can compute it."""
    return F.conv(F.substring(F.md5(word), 1, 16), 16, -10).cast("bigint")


def character_pairs(text: Column) -> Column:
    return F.flatten(
        F.transform(
            tokens.runs(text),
            lambda w: F.when(
                F.length(w) > 1,
                F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2))),
            ).otherwise(F.array(w)),
        )
    )


def similarity_hash(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    features: Callable[[Column], Column] = tokens.runs,
    word_hash: Callable[[Column], Column] = fast_hash,
) -> DataFrame:
    """(key, similarity_hash_digest); texts without words are absent.

    A bit of the digest is set when more than half of the words set it.  Two
    31-bit counters share one long, so 32 sums in generated code count all 64
    bits: shifting by i lines up bits i and i + 32.  Words of a document collapse
    to one row in its scan task before the shuffle.
    """
    hashes = documents.select(key, F.explode(features(F.col(text))).alias("w")).select(
        key, word_hash(F.col("w")).alias("h")
    )
    sums = hashes.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"sum(shiftrightunsigned(h, {i}) & 4294967297L) AS c{i}") for i in range(32)],
    )
    bits = [
        f"CASE WHEN 2 * {count} > n THEN shiftleft(1L, {bit}) ELSE 0L END"
        for i in range(32)
        for count, bit in ((f"(c{i} & 4294967295L)", i), (f"shiftrightunsigned(c{i}, 32)", i + 32))
    ]
    return sums.select(key, F.expr(" | ".join(bits)).alias("similarity_hash_digest"))


def similarity_hash_by_language(
    documents: DataFrame,
    languages: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    word_hash: Callable[[Column], Column] = fast_hash,
) -> DataFrame:
    """As `similarity_hash`, with the features that each text's language asks for.

    `languages` is (key, lang).  Texts that hold unspaced script get both digests
    and the language picks one, so whole texts are never shuffled to meet their
    language.
    """
    by_word = similarity_hash(documents, key, text, tokens.runs, word_hash)
    unspaced = documents.filter(tokens.has_unspaced(F.col(text)))
    by_pair = similarity_hash(unspaced, key, text, character_pairs, word_hash).withColumnRenamed(
        "similarity_hash_digest", "_pairs"
    )
    joined = by_word.join(by_pair, key, "left").join(languages.select(key, "lang"), key, "left")
    wants_pairs = F.left("lang", F.lit(2)).isin(*UNSPACED) & F.col("_pairs").isNotNull()
    return joined.select(
        key, F.when(wants_pairs, F.col("_pairs")).otherwise(F.col("similarity_hash_digest")).alias("similarity_hash_digest")
    )
