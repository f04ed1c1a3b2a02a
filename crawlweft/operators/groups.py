"""Records that share a content fingerprint, rolled up.

A fingerprint can be as hot as "a third of all records" (an empty page, an error
page).  So one-row-per-group results use only aggregates that combine on the map
side, and a group's lists stay in a long table that is spread by member, not by
group.  Arrays are packed last, in parts of bounded length.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweft.operators.staging import broadcast_if_small, write_stage

PART_ROWS = 10_000

# Record column -> (document field, is it a set?)
LIST_FIELDS = {
    "url": ("url", False),
    "raw_url": ("raw_url", False),
    "filename": ("filename", True),
    "fetched_at": ("date_fetched", False),
    "discovered_at": ("date_discovered", False),
    "modified_at": ("date_modified", False),
}


def record_order() -> Column:
    """Fixed order of a group's records: by fetch time, then address, then name."""
    return F.struct("fetched_num", "url", "item_name")


def grouped_records(records: DataFrame, fresh: DataFrame | None = None) -> DataFrame:
    """All records whose fingerprint one of the `fresh` originals has.

    An incremental run has few fresh originals; their fingerprints are broadcast
    after counting and drop most records inside the scan, before any shuffle.  A
    full run gives none: `rollup` alone tells which groups have an original and
    no join is needed.
    """
    members = records.filter(F.col("fingerprint").isNotNull())
    if fresh is None:
        return members
    wanted = broadcast_if_small(fresh.select("fingerprint").distinct())
    return members.join(wanted, "fingerprint", "left_semi").select(*records.columns)


def rollup(records: DataFrame) -> DataFrame:
    """One row per fingerprint that has an original.

    Input: typed records with `decision`.  The original fetched last supplies the
    body, as the last write wins; the first indexable record supplies the content
    type, else the last record that names one; the first record supplies size,
    header language and base address.
    """
    order = record_order()
    content_type = F.struct("header_media_type", "header_charset")
    is_original = (F.col("original") == "self") & F.col("fetched").isNotNull()
    hint = F.when(F.col("filename").contains("."), F.col("filename"))
    first = F.struct("url", "content_length", "content_language")
    last_original = F.when(is_original, F.struct("fetched_num", "item_name"))
    yes = F.col("decision") == "yes"
    groups = (
        records.filter(F.col("fingerprint").isNotNull())
        .groupBy("fingerprint")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.count("url").alias("n_urls"),
            F.count("raw_url").alias("n_raw_urls"),
            F.max(last_original).alias("_original"),
            F.bool_or(yes).alias("indexable"),
            F.min_by(content_type, F.when(yes, order)).alias("_indexable_type"),
            F.max_by(content_type, F.when(F.col("header_media_type").isNotNull(), order)).alias("_last_type"),
            F.min_by(first, order).alias("_first"),
            F.bool_or("blocked").alias("googlebot_blocked"),
            F.bool_or("malformed").alias("malformed"),
            F.min(hint).alias("filename_hint"),
        )
        .filter(F.col("_original").isNotNull())
    )
    chosen = F.coalesce(F.when(F.col("indexable"), F.col("_indexable_type")), F.col("_last_type"))
    return groups.select(
        "fingerprint",
        F.col("_original.item_name").alias("item_name"),
        F.col("_original.fetched_num").alias("fetched_num"),
        "n_records",
        "n_urls",
        "n_raw_urls",
        "indexable",
        chosen["header_media_type"].alias("header_media_type"),
        chosen["header_charset"].alias("header_charset"),
        F.col("_first.url").alias("base_url"),
        F.col("_first.content_length").alias("content_length"),
        F.lower("_first.content_language").alias("header_language"),
        "googlebot_blocked",
        "malformed",
        "filename_hint",
    )


def group_values(records: DataFrame) -> DataFrame:
    """Long form of the lists: (fingerprint, field, value, fetched_num, url, item_name).

    No shuffle: every record yields its own rows.  File names are a set, see
    `group_sets`.
    """
    entries = [
        F.struct(F.lit(field).alias("field"), F.col(column).cast("string").alias("value"))
        for column, (field, is_set) in LIST_FIELDS.items()
        if not is_set
    ]
    return (
        records.filter(F.col("fingerprint").isNotNull())
        .select("fingerprint", "fetched_num", "url", "item_name", F.explode(F.array(*entries)).alias("e"))
        .select("fingerprint", "e.field", "e.value", "fetched_num", "url", "item_name")
        .filter(F.col("value").isNotNull())
    )


def group_sets(records: DataFrame) -> DataFrame:
    """Distinct (fingerprint, filename) pairs; a hot group spreads over its names."""
    return (
        records.filter(F.col("fingerprint").isNotNull() & F.col("filename").isNotNull())
        .select("fingerprint", "filename")
        .distinct()
    )


def oversized_groups(records: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(fingerprint, n_parts) of the groups, with an original or not, that need several parts."""
    sizes = records.filter(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    return sizes.filter(F.col("n") > part_rows).select("fingerprint", F.ceil(F.col("n") / part_rows).alias("n_parts"))


def parts_of(documents: DataFrame, oversized: DataFrame) -> DataFrame:
    """One row per part of each document: adds `part`, from 0 up.

    Later joins use (fingerprint, part), which spreads the parts of a hot group.
    """
    n_parts = F.coalesce("n_parts", F.lit(1)).cast("int")
    return (
        documents.join(broadcast_if_small(oversized), "fingerprint", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
        .drop("n_parts")
    )


def pack_lists(records: DataFrame, oversized: DataFrame | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Arrays of a group's values: one row per (fingerprint, part).

    A group of up to `part_rows` records is one part.  A larger one is split over
    enough parts, lists by record name and file names by their own hash (so a set
    stays a set); no task or row holds much more than `part_rows` members and
    none is dropped.  Only the oversized groups are joined to find the number of
    parts: broadcast when they are few, else merged with AQE splitting the skew,
    which the repartition below it allows.  `oversized` is `oversized_groups` of
    the same records, staged.
    """
    if oversized is None:
        oversized = write_stage(oversized_groups(records, part_rows), "oversized")
    columns = list(LIST_FIELDS)
    sized = records.filter(F.col("fingerprint").isNotNull()).select(
        "fingerprint", record_order().alias("o"), "item_name", *[c for c in columns if c != "url"], "url"
    ).join(broadcast_if_small(oversized), "fingerprint", "left")

    def place(key: str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(key), F.col("n_parts")), F.lit(0)).cast("int").alias("part")

    no_name = F.lit(None).cast("string").alias("set_value")
    one = F.array(F.struct(F.lit(0).alias("part"), F.lit(True).alias("member"), F.col("filename").alias("set_value")))
    two = F.array(
        F.struct(place("item_name"), F.lit(True).alias("member"), no_name),
        F.struct(place("filename"), F.lit(False).alias("member"), F.col("filename").alias("set_value")),
    )
    placed = (
        sized.withColumn("e", F.explode(F.when(F.col("n_parts").isNull(), one).otherwise(two)))
        .select("*", "e.part", "e.member", "e.set_value")
        .drop("e", "filename", "item_name", "n_parts")
        .repartition("fingerprint", "part")
    )
    lists = [c for c, (_, is_set) in LIST_FIELDS.items() if not is_set]
    entry = F.when(F.col("member"), F.struct("o", *lists))
    packed = placed.groupBy("fingerprint", "part").agg(
        F.array_sort(F.collect_list(entry)).alias("m"), F.array_sort(F.collect_set("set_value")).alias("filename")
    )

    def values_of(column: str) -> Column:
        return F.array_compact(F.col(f"m.{column}")).alias(LIST_FIELDS[column][0])

    return packed.select("fingerprint", "part", "filename", *map(values_of, lists))
