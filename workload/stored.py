"""Stored tables: whole versions, merges into buckets, and the completeness of tags from their pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.operators.coverage import complete_tags, tag_completeness
from ratinglens.operators.membership import pending_tags
from ratinglens.operators.snapshot import upsert_log
from ratinglens.session import durable_path, staged
from ratinglens.sources import versions
from workload.snapshots import UPSERT_ATTEMPTS
from workload.standins import attempts, table


def table_versions(spark: SparkSession, d: str) -> DataFrame:
    """A table replaced, extended and replaced again; each version as a reader of that number sees it."""
    path = durable_path(spark, "versions")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    versions.overwrite(orders.where("o_orderstatus = 'F'"), path)
    versions.append(orders.where("o_orderstatus = 'O'"), path)
    versions.overwrite(orders.where("o_orderstatus = 'P'"), path)
    rows = [versions.read(spark, path, i).withColumn("version", F.lit(i)) for i in versions.versions(spark, path)]
    both = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return both.groupBy("version", "o_orderstatus").agg(F.count("*").alias("orders"), F.sum("o_orderkey").alias("keys"))


TABLE_VERSIONS = """
SELECT version, o_orderstatus, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders, (VALUES (1, 'F'), (2, 'F'), (2, 'O'), (3, 'P')) v(version, status) WHERE o_orderstatus = status GROUP BY 1, 2"""

ATTEMPT_KEYS = ["entity_id", "round", "attempt"]


def merged_attempts(spark: SparkSession, d: str) -> DataFrame:
    """The odd days of the log are stored under older reasons; the whole log is then merged in, two batches and a replay."""
    path = durable_path(spark, "attempt-log")
    log = staged(attempts(spark, d), "attempts")

    def merge(rows: DataFrame, batch: int) -> None:
        versions.merge(rows, path, ATTEMPT_KEYS, lambda old, new: upsert_log(old, new, ATTEMPT_KEYS, ["failed_at"]), 16, ("log", batch))

    merge(log.where("round % 2 = 1").withColumn("reason", F.lit("older")), 0)
    for batch in (1, 2, 2):
        merge(log.where(F.col("round") % 4 < 2 if batch == 1 else F.col("round") % 4 >= 2), batch)
    return versions.read(spark, path).select("entity_id", "round", "attempt", "level", "reason")


def search_pages(spark: SparkSession, d: str) -> DataFrame:
    """Orders as result pages of their customer: some short, some failed, some read twice, with holes and overlaps."""
    k = F.col("o_orderkey")
    start = F.greatest(F.lit(0), F.floor(k / 4) % 5 * 20 - k % 3 * 5).cast("int")
    return table(spark, d, "orders").select(
        F.concat(F.lit("tag "), F.col("o_custkey").cast("string")).alias("tag"),
        F.col("o_custkey").alias("tag_order"),
        start.alias("page_start"),
        F.lit(20).alias("asked"),
        F.when(k % 7 == 0, k % 20).otherwise(20).cast("int").alias("got"),
        (k % 11 == 0).alias("failed"),
    )


_PAGES = """
pages AS (
    SELECT 'tag ' || o_custkey AS tag, o_custkey AS tag_order, CAST(greatest(0, o_orderkey // 4 % 5 * 20 - o_orderkey % 3 * 5) AS INTEGER) AS s,
           CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 20 ELSE 20 END AS INTEGER) AS got, o_orderkey % 11 = 0 AS failed FROM orders
), tried AS (
    SELECT tag, s, max(CASE WHEN NOT failed THEN s + got END) AS e, bool_or(NOT failed AND got < 20) AS short FROM pages GROUP BY 1, 2
), listed AS (
    SELECT tag, min(pos) AS covered FROM (SELECT DISTINCT tag FROM pages) tags, range(0, 200) r(pos)
    WHERE NOT EXISTS (SELECT 1 FROM tried t WHERE t.tag = tags.tag AND t.s <= pos AND pos < t.e) GROUP BY 1
), ended AS (
    SELECT tag, min(e) AS ends FROM tried JOIN listed USING (tag) WHERE short AND e IS NOT NULL AND s <= covered GROUP BY 1
), gaps AS (
    SELECT tag, count(*) FILTER (s > reach) AS holes FROM
      (SELECT tag, s, coalesce(max(e) OVER (PARTITION BY tag ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach
       FROM tried WHERE e IS NOT NULL) GROUP BY 1
), lost AS (
    SELECT tag, count(*) AS failed_pages, min(s) AS first_failed FROM tried WHERE e IS NULL GROUP BY 1
), judged AS (
    SELECT tag, CAST(covered AS INTEGER) AS covered, ends, CAST(coalesce(holes, 0) AS BIGINT) AS holes, coalesce(failed_pages, 0) AS failed_pages,
           covered >= coalesce(ends, 80) AND coalesce(first_failed >= coalesce(ends, 80), true) AS complete
    FROM listed LEFT JOIN ended USING (tag) LEFT JOIN gaps USING (tag) LEFT JOIN lost USING (tag)
)"""


def tag_completeness_query(spark: SparkSession, d: str) -> DataFrame:
    """What the pages of each tag cover; at most eighty results are listed."""
    return tag_completeness(search_pages(spark, d), listed_at_most=80)


TAG_COMPLETENESS = f"WITH {_PAGES} SELECT tag, covered, ends, holes, failed_pages, complete FROM judged"


def incomplete_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags still to be read, in list order."""
    pages = search_pages(spark, d)
    return pending_tags(pages.select("tag", "tag_order").distinct(), complete_tags(pages, listed_at_most=80))


INCOMPLETE_TAGS = f"WITH {_PAGES} SELECT DISTINCT tag, tag_order FROM pages JOIN judged USING (tag) WHERE NOT complete ORDER BY tag_order"

QUERIES = {
    "table_versions": (table_versions, TABLE_VERSIONS),
    "merged_attempts": (merged_attempts, UPSERT_ATTEMPTS),
    "tag_completeness": (tag_completeness_query, TAG_COMPLETENESS),
    "incomplete_tags": (incomplete_tags, INCOMPLETE_TAGS),
}
