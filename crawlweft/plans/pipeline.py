"""Crawl records and bodies -> index documents and rejects.

    records -> groups by fingerprint -> bodies by key -> text and fields
            -> language, similarity hash -> lists -> documents

The group rollup, the extracted text, the languages and the sizes of oversized
groups are staged in the shared folder.  Later steps read only the columns they
need from them, and a text crosses the network twice: once to meet its record,
once to meet its features.
"""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweft import schemas
from crawlweft.functions import headers
from crawlweft.operators import extract, groups, language, media_types, simhash
from crawlweft.operators.staging import scratch_path, write_stage
from crawlweft.sinks import index
from crawlweft.sources import bodies as body_source
from crawlweft.sources import records as record_source


# A row of the index table: a document and the fetch time of its original.
DOCUMENT_VERSION = T.StructType([*schemas.TEXT_DOCUMENT.fields, T.StructField("version", T.DoubleType())])


class Indexed(NamedTuple):
    """Lazy results, and the folder of stages they read.

    Once both are written, `staging.discard(spark, stages)` frees the folder.
    """

    documents: DataFrame
    rejects: DataFrame
    stages: str


def _rejects(members: DataFrame, rolled: DataFrame, extracted: DataFrame, no_language: DataFrame) -> DataFrame:
    unknown = members.filter(F.col("decision") == "unknown").join(
        rolled.select("fingerprint"), "fingerprint", "left_semi"
    )
    parts = [
        index.reject(unknown, "media_type", "unknown media type"),
        index.reject(rolled.filter("malformed"), "attributes", "malformed exclusion reasons"),
        index.reject(index.invalid_groups(rolled.filter("NOT malformed")), "validity", "no address"),
        index.reject(extracted.filter(F.col("status") == extract.MISSING), "body", "no body stored"),
        index.reject(extracted.filter(F.col("status") == extract.CHARSET), "parse", "charset"),
        index.reject(extracted.filter(F.col("status") == extract.UNSUPPORTED), "parse", "unsupported media type"),
        index.reject(no_language, "language", "no language detected"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def build_documents(
    records: DataFrame,
    bodies: DataFrame,
    rule_table: DataFrame,
    profiles: DataFrame,
    analyzers: DataFrame,
    fresh: DataFrame | None = None,
    word_hash: Callable[[Column], Column] = simhash.fast_hash,
    part_rows: int = groups.PART_ROWS,
) -> Indexed:
    """Documents (schema `TEXT_DOCUMENT` plus `version`) and rejects.

    `fresh` holds the originals of an incremental run; without it every group
    that has an original is built.  `bodies` is (content_key, content).
    """
    stages = scratch_path(records.sparkSession, "run")
    members = media_types.decide(
        record_source.typed(groups.grouped_records(records, fresh)), rule_table
    )
    # `part` is written into the stages: as a mere constant the planner would take it
    # out of the join keys below, and put a hot group's lists back into one task.
    rolled = write_stage(groups.rollup(members).withColumn("part", F.lit(0)), "groups", stages)
    usable = index.valid_groups(rolled.filter("NOT malformed")).withColumn(
        "fetched_at", F.timestamp_millis((F.col("fetched_num") * 1000).cast("bigint"))
    )

    attached = body_source.attach_bodies(usable.filter("indexable"), bodies)
    extracted = write_stage(extract.extract(attached), "extracted", stages)
    texts = extracted.filter((F.col("status") == extract.OK) & (F.col("body") != "")).select("fingerprint", "body")

    detected = language.detect(texts, profiles, "fingerprint", "body")
    tags = extracted.filter(F.col("status") == extract.OK).withColumn("has_text", F.col("text_length") > 0)
    spoken = write_stage(
        tags.join(detected, "fingerprint", "left").select(
            "fingerprint",
            "part",
            "item_name",
            "has_text",
            "detected",
            F.when(
                F.col("has_text"),
                language.primary_language(F.col("detected"), F.col("html_language"), F.col("header_language")),
            ).otherwise(F.col("header_language")).alias("lang"),
        ),
        "languages",
        stages,
    )
    digests = simhash.similarity_hash_by_language(texts, spoken, "fingerprint", "body", word_hash)
    features = language.with_analyzer(
        spoken.select("fingerprint", "part", "detected", "lang"), F.col("lang"), analyzers
    ).join(digests, "fingerprint", "left")

    content = (
        extracted.filter(F.col("status") != extract.MISSING)
        .unionByName(usable.filter("NOT indexable").select(
            "*",
            F.col("header_media_type").alias("media_type"),
            F.col("header_charset").alias("charset"),
            F.lit(0).alias("text_length"),
            headers.declared_size(F.col("content_length")).alias("size"),
        ), allowMissingColumns=True)
    )
    oversized = write_stage(groups.oversized_groups(members, part_rows), "oversized", stages)
    lists = groups.pack_lists(members, oversized, part_rows)
    parts = groups.parts_of(content.select("fingerprint", F.col("fetched_num").alias("version")), oversized)
    scalars = media_types.flag_common(
        content.select(
            "fingerprint",
            "part",
            "title",
            "body",
            "media_type",
            "charset",
            "authors",
            "misc",
            "out_links",
            "email_addresses",
            "googlebot_blocked",
            "text_length",
            "size",
            "header_language",
            F.when(F.col("text_length") > 0, F.col("html_language")).alias("html_language"),
            "meta_created",
            "meta_modified",
            "status",
        ),
        rule_table,
    )
    # Every join is by (fingerprint, part), so a hot group's lists stay spread and move once.
    where = ["fingerprint", "part"]
    joined = parts.join(lists, where, "left").join(features, where, "left").join(scalars, where, "left")
    is_head = F.col("part") == 0
    no_dates = F.expr("cast(array() as array<timestamp>)")
    none = F.expr("cast(array() as array<string>)")
    documents = joined.select(
        F.col("fingerprint").alias("id"),
        "part",
        *[F.coalesce(name, none).alias(name) for name in ("url", "raw_url", "filename")],
        "title",
        "body",
        "media_type",
        "charset",
        *[F.coalesce(name, no_dates).alias(name) for name in ("date_discovered", "date_fetched")],
        F.array_compact(F.array("meta_created")).alias("date_created"),
        F.array_compact(F.concat(F.coalesce("date_modified", no_dates), F.array("meta_modified"))).alias("date_modified"),
        F.when(
            is_head, language.language_set(F.col("header_language"), F.col("detected"), F.col("html_language"))
        ).otherwise(none).alias("language"),
        F.when(is_head & (F.col("status") == extract.OK), F.col("analyzer")).alias("analyzer"),
        "authors",
        "misc",
        F.coalesce("email_addresses", none).alias("email_addresses"),
        F.coalesce("out_links", none).alias("out_links"),
        "googlebot_blocked",
        "text_length",
        "size",
        F.when(is_head, F.coalesce("similarity_hash_digest", F.lit(0).cast("bigint"))).alias("similarity_hash_digest"),
        F.when(is_head, F.coalesce(F.col("is_common_type") & (F.col("status") == extract.OK), F.lit(False))).alias(
            "is_common_type"
        ),
        "version",
    )
    versioned = index.strict(documents, DOCUMENT_VERSION)
    no_language = spoken.filter(F.col("has_text") & F.col("detected").isNull())
    return Indexed(versioned, _rejects(members, rolled, extracted, no_language), stages)
