"""Landed API responses to contract rows.

A response is a row ``entity_id, status, body, captured_at`` (details),
``entity_id, title, sample_label, page_start, asked, status, body, captured_at``
(comment pages) or ``tag, tag_order, page_start, status, body, captured_at``
(search pages), or such a row as ``landed`` reads it, with ``payload`` in place of
the body and the raw text of a malformed line. Who a comment came from is never read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.contracts import fields_of
from ratinglens.functions.payload import (
    COMMENT_BODY,
    DETAIL_BODY,
    SEARCH_BODY,
    body_as,
    detail_fields,
    is_object,
    parsed_body,
    payload_reason,
    star_text,
)
from ratinglens.functions.text import entity_id_of_url
from ratinglens.labels import ZH, Labels


def with_payload(responses: DataFrame) -> DataFrame:
    """Responses whose body is parsed to ``payload``, unless it is already."""
    if "payload" in responses.columns:
        return responses
    return responses.select("*", parsed_body(F.col("body")).alias("payload"))


def triage(responses: DataFrame, labels: Labels = ZH) -> DataFrame:
    """Responses with their payload and ``reason``: NULL when usable. A malformed line is a parse failure."""
    reason = payload_reason(F.col("status"), F.col("payload"), labels)
    if "malformed" in responses.columns:
        reason = F.when(F.col("malformed").isNotNull(), labels.parse_failure).otherwise(reason)
    return with_payload(responses).withColumn("reason", reason)


def detail_rows(responses: DataFrame, labels: Labels = ZH) -> DataFrame:
    """Contract rows of the usable detail responses."""
    good = triage(responses, labels).where(F.col("reason").isNull())
    shaped = good.select("entity_id", "captured_at", body_as(F.col("payload"), DETAIL_BODY).alias("data"))
    fields = detail_fields(F.col("data"))
    return shaped.select("entity_id", "captured_at", *[c.alias(name) for name, c in fields.items()]).select(*fields_of("details"))


def failed_responses(responses: DataFrame, labels: Labels = ZH) -> DataFrame:
    """Why responses failed. The entity of a malformed line is what its text still tells, else NULL."""
    bad = triage(responses, labels).where(F.col("reason").isNotNull())
    entity = F.col("entity_id")
    if "malformed" in responses.columns:
        told = F.regexp_extract("malformed", r'"entity_id"\s*:\s*"([^"]+)"', 1)
        entity = F.coalesce(entity, F.nullif(told, F.lit("")))
    return bad.select(entity.alias("entity_id"), "reason", F.col("captured_at").alias("failed_at"))


def comment_rows(pages: DataFrame, limits: Mapping[str, int], labels: Labels = ZH) -> DataFrame:
    """Contract rows of the comment pages, cut at the rank limit of each label."""
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    body = body_as(F.col("payload"), COMMENT_BODY)
    items = with_payload(pages).where((F.col("status") == 200) & is_object(F.col("payload"))).select(
        "entity_id", "title", "sample_label", "page_start", "captured_at", F.posexplode(body["interests"])
    )
    rank = F.col("page_start") + F.col("pos") + 1
    return (
        items.where((rank <= F.try_element_at(limit, F.col("sample_label"))) & (F.col("col.id") != ""))
        .select(
            F.col("col.id").alias("comment_id"),
            "entity_id",
            "title",
            star_text(F.nullif(F.col("col.rating.value"), F.lit("")), labels).alias("star"),
            F.coalesce("col.comment", F.lit("")).alias("body"),
            F.coalesce("col.vote_count", F.lit("0")).alias("useful"),
            F.coalesce("col.create_time", F.lit("")).alias("commented_at"),
            "sample_label",
            rank.cast("string").alias("position"),
            "captured_at",
        )
        .select(*fields_of("comments"))
    )


def page_facts(pages: DataFrame) -> DataFrame:
    """Size and total of every comment page, for the completeness rule."""
    body = body_as(F.col("payload"), COMMENT_BODY)
    failed = F.coalesce((F.col("status") != 200) | ~is_object(F.col("payload")), F.lit(True))
    return with_payload(pages).select(
        "entity_id",
        "sample_label",
        "page_start",
        "asked",
        failed.alias("failed"),
        F.coalesce(F.size(body["interests"]), F.lit(0)).alias("got"),
        F.coalesce(body["total"], F.lit(0)).alias("total"),
    )


def search_hits(pages: DataFrame) -> DataFrame:
    """One row per listed entity with its rank over all pages of the tag.

    Entries without an entity id are dropped but have used up their rank.
    """
    body = body_as(F.col("payload"), SEARCH_BODY)
    listed = with_payload(pages).where((F.col("status") == 200) & is_object(F.col("payload"))).select(
        "tag", "tag_order", "page_start", "captured_at", F.posexplode(body["subjects"])
    )
    hits = listed.select(
        entity_id_of_url(F.col("col.url")).alias("entity_id"),
        F.coalesce("col.title", F.lit("")).alias("title"),
        F.coalesce("col.rate", F.lit("")).alias("search_score"),
        F.coalesce("col.url", F.lit("")).alias("url"),
        "tag",
        "tag_order",
        (F.col("page_start") + F.col("pos") + 1).cast("int").alias("rank"),
        "captured_at",
    )
    return hits.where(F.col("entity_id") != "")


def search_page_facts(pages: DataFrame) -> DataFrame:
    """(tag, page_start, asked, got, failed) of every search page, for the completeness of a tag."""
    body = body_as(F.col("payload"), SEARCH_BODY)
    failed = F.coalesce((F.col("status") != 200) | ~is_object(F.col("payload")), F.lit(True))
    return with_payload(pages).select(
        "tag", "page_start", "asked", F.coalesce(F.size(body["subjects"]), F.lit(0)).alias("got"), failed.alias("failed")
    )
