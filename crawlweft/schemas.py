"""Fixed shapes of the tables this library reads and writes."""

from pyspark.sql import types as T

S, TS = T.StringType(), T.TimestampType()

# One row per crawled address.  Every attribute arrives as text.
CRAWL_RECORD = T.StructType(
    [
        T.StructField(name, S)
        for name in (
            "item_name",
            "original",
            "fingerprint",
            "fetched",
            "discovered",
            "url",
            "raw_url",
            "last_modified",
            "content_length",
            "content_type",
            "content_language",
            "content_disposition",
            "googlebot_exclusion_reasons",
        )
    ]
)

# Attribute names of the narrow form that differ from their column names.
ATTRIBUTE_COLUMNS = {
    "original": "original",
    "fingerprint": "fingerprint",
    "fetched": "fetched",
    "discovered": "discovered",
    "url": "url",
    "raw_url": "raw_url",
    "last-modified": "last_modified",
    "content-length": "content_length",
    "content-type": "content_type",
    "content-language": "content_language",
    "content-disposition": "content_disposition",
    "googlebot_exclusion_reasons": "googlebot_exclusion_reasons",
}

ATTRIBUTE_ROW = T.StructType(
    [
        T.StructField("item_name", S),
        T.StructField("seq", T.LongType()),
        T.StructField("attribute", S),
        T.StructField("value", S),
    ]
)

BODY = T.StructType([T.StructField("content_key", S), T.StructField("content", S)])

MEDIA_TYPE_RULE = T.StructType(
    [T.StructField("section", S), T.StructField("kind", S), T.StructField("value", S)]
)

LANGUAGE_PROFILE = T.StructType(
    [
        T.StructField("name", S),
        T.StructField("freq", T.MapType(S, T.LongType())),
        T.StructField("n_words", T.ArrayType(T.LongType())),
    ]
)

REJECT = T.StructType(
    [
        T.StructField("item_name", S),
        T.StructField("fingerprint", S),
        T.StructField("stage", S),
        T.StructField("reason", S),
    ]
)

# The index table.  `part` is 0 for a document; a group with more members than
# one row should hold goes on in parts 1, 2, ... that carry list fields only.
TEXT_DOCUMENT = T.StructType(
    [
        T.StructField("id", S),
        T.StructField("part", T.IntegerType()),
        T.StructField("url", T.ArrayType(S)),
        T.StructField("raw_url", T.ArrayType(S)),
        T.StructField("filename", T.ArrayType(S)),
        T.StructField("title", S),
        T.StructField("body", S),
        T.StructField("media_type", S),
        T.StructField("charset", S),
        T.StructField("date_discovered", T.ArrayType(TS)),
        T.StructField("date_fetched", T.ArrayType(TS)),
        T.StructField("date_created", T.ArrayType(TS)),
        T.StructField("date_modified", T.ArrayType(TS)),
        T.StructField("language", T.ArrayType(S)),
        T.StructField("analyzer", S),
        T.StructField("authors", T.ArrayType(S)),
        T.StructField("misc", T.ArrayType(S)),
        T.StructField("email_addresses", T.ArrayType(S)),
        T.StructField("out_links", T.ArrayType(S)),
        T.StructField("googlebot_blocked", T.BooleanType()),
        T.StructField("text_length", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("similarity_hash_digest", T.LongType()),
        T.StructField("is_common_type", T.BooleanType()),
    ]
)

# Declared by the index but not retrievable from it.
NOT_STORED = ("misc",)
