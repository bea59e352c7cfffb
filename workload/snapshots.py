"""Snapshots, samples, pending sets and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.labels import EN
from ratinglens.operators import membership, snapshot
from workload.standins import (
    LIMITS,
    TAGS,
    attempts,
    collection_events,
    comments_raw,
    entities,
    table,
    tag_hits,
    tag_position,
    with_ctes,
)

_LINE_TIES = ["l_partkey", "l_suppkey", "l_extendedprice"]


def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Newest line per (order, line number); later columns settle equal dates."""
    lines = table(spark, d, "lineitem").withColumn(
        "key", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    )
    newest = snapshot.latest_snapshot(lines, "key", "l_shipdate", _LINE_TIES)
    return newest.select("key", "l_partkey", "l_suppkey", "l_quantity")


LATEST_SNAPSHOT = """
SELECT l_orderkey || '-' || l_linenumber AS key, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1"""


def keep_first(spark: SparkSession, d: str) -> DataFrame:
    """First part by key for each name."""
    return snapshot.keep_first(table(spark, d, "part"), "p_name", ["p_partkey"]).select("p_name", "p_partkey", "p_brand")


KEEP_FIRST = """SELECT p_name, p_partkey, p_brand FROM part
QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1"""


def first_seen_entities(spark: SparkSession, d: str) -> DataFrame:
    return snapshot.first_seen_entities(tag_hits(spark, d)).select("entity_id", "tag", "rank")


FIRST_SEEN_ENTITIES = with_ctes(
    "tag_hits",
    body="""SELECT entity_id, tag, rank FROM tag_hits
            QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY tag_order, rank) = 1""",
)


def first_links(spark: SparkSession, d: str) -> DataFrame:
    return snapshot.first_links(tag_hits(spark, d))


FIRST_LINKS = with_ctes(
    "tag_hits", body="SELECT entity_id, tag, min(rank) AS rank FROM tag_hits GROUP BY 1, 2"
)


def upsert_attempts(spark: SparkSession, d: str) -> DataFrame:
    """The log of the odd days is stored; the whole log comes again, upgraded reasons winning."""
    log = attempts(spark, d)
    stored = log.where(F.col("round") % 2 == 1).withColumn("reason", F.lit("older"))
    merged = snapshot.upsert_log(stored, log, ["entity_id", "round", "attempt"], ["failed_at"])
    return merged.select("entity_id", "round", "attempt", "level", "reason")


UPSERT_ATTEMPTS = with_ctes("attempts", body="SELECT entity_id, round, attempt, level, reason FROM attempts")


def rank_limited_sample(spark: SparkSession, d: str) -> DataFrame:
    """First comments per (entity, label), as many as the label's plan asks for."""
    raw = comments_raw(spark, d).withColumn("position", F.col("position").cast("int"))
    order = ["position", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    kept = snapshot.rank_limited_sample(raw, LIMITS, order_by=order)
    return kept.select("entity_id", "sample_label", "position", "l_partkey", "l_suppkey")


RANK_LIMITED_SAMPLE = with_ctes(
    "comments_raw",
    body=f"""SELECT entity_id, sample_label, CAST(position AS INTEGER) AS position, l_partkey, l_suppkey FROM comments_raw
        QUALIFY row_number() OVER (PARTITION BY entity_id, sample_label
            ORDER BY CAST(position AS INTEGER), l_shipdate, l_partkey, l_suppkey, l_extendedprice)
          <= CASE sample_label {' '.join(f"WHEN '{k}' THEN {v}" for k, v in LIMITS.items())} END""",
)


def _collected(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("entity_id"))


def _gone(spark: SparkSession, d: str) -> DataFrame:
    late = table(spark, d, "orders").where(F.year("o_orderdate") >= 2001)
    return late.select(F.col("o_orderkey").cast("string").alias("entity_id"))


def pending_entities(spark: SparkSession, d: str) -> DataFrame:
    """Orders with neither lines (collected) nor a late date (unavailable)."""
    candidates = entities(spark, d).select("entity_id", "title")
    return membership.pending(candidates, [_collected(spark, d), _gone(spark, d)])


PENDING_ENTITIES = """
SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, 'Order ' || o_orderkey AS title FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AND year(o_orderdate) < 2001"""


def next_batch(spark: SparkSession, d: str) -> DataFrame:
    """The next hundred pending orders in key order."""
    candidates = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("entity_id"), F.col("o_orderkey").alias("seq")
    )
    return snapshot.batch_of(membership.pending(candidates, [_collected(spark, d)]), "seq", 100)


NEXT_BATCH = """
SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, o_orderkey AS seq FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) ORDER BY o_orderkey LIMIT 100"""


def completed_keys(spark: SparkSession, d: str) -> DataFrame:
    """Union of collected and unavailable ids."""
    return membership.union_of_keys([_collected(spark, d), _gone(spark, d)], "entity_id")


COMPLETED_KEYS = """
SELECT CAST(l_orderkey AS VARCHAR) AS entity_id FROM lineitem
UNION SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE year(o_orderdate) >= 2001"""


def unseen_links(spark: SparkSession, d: str) -> DataFrame:
    """Customer and priority pairs of the last year that earlier years do not hold."""
    orders = table(spark, d, "orders")
    hits = orders.select(
        F.col("o_custkey").cast("string").alias("entity_id"),
        F.col("o_orderpriority").alias("tag"),
        F.col("o_orderkey").alias("rank"),
        F.col("o_orderdate").alias("captured_at"),
    )
    recent = F.year("captured_at") >= 2000
    first = hits.where(recent).groupBy("entity_id", "tag").agg(F.min("rank").alias("rank"))
    return membership.unseen(first, hits.where(~recent), ["entity_id", "tag"])


UNSEEN_LINKS = """
SELECT CAST(o_custkey AS VARCHAR) AS entity_id, o_orderpriority AS tag, min(o_orderkey) AS rank FROM orders n
WHERE year(o_orderdate) >= 2000 AND NOT EXISTS (SELECT 1 FROM orders o WHERE year(o.o_orderdate) < 2000
  AND o.o_custkey = n.o_custkey AND o.o_orderpriority = n.o_orderpriority) GROUP BY 1, 2"""


def unseen_comments(spark: SparkSession, d: str) -> DataFrame:
    """Comments of shipped lines whose key the open lines do not hold under the same label."""
    raw = comments_raw(spark, d).select("comment_id", "sample_label", "body", "l_shipdate", "l_partkey", "l_suppkey")
    fresh = membership.unseen(raw.where("body = 'F'"), raw.where("body = 'O'"), ["comment_id", "sample_label"])
    return fresh.select("comment_id", "sample_label", "l_partkey", "l_suppkey")


UNSEEN_COMMENTS = with_ctes(
    "comments_raw",
    body="""SELECT comment_id, sample_label, l_partkey, l_suppkey FROM comments_raw n WHERE body = 'F'
            AND NOT EXISTS (SELECT 1 FROM comments_raw o WHERE o.body = 'O' AND o.comment_id = n.comment_id
                            AND o.sample_label = n.sample_label)""",
)


def pending_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags of the fixed list without a link in the first minutes of the log."""
    hits = tag_hits(spark, d)
    done = hits.where(F.col("captured_at") < F.lit("2024-01-01 00:05:00").cast("timestamp_ntz"))
    listed = hits.select("tag").distinct().withColumn("tag_order", tag_position(F.col("tag")))
    return membership.pending_tags(listed, done)


PENDING_TAGS = with_ctes(
    "tag_hits",
    body="""SELECT DISTINCT tag, tag_order FROM tag_hits WHERE tag NOT IN
            (SELECT tag FROM tag_hits WHERE captured_at < TIMESTAMP '2024-01-01 00:05:00') ORDER BY tag_order""",
)


def _progress(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("entity_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        "o_orderdate",
    )
    held = membership.held_counts(comments_raw(spark, d))
    states = (
        table(spark, d, "lineitem")
        .where("l_linestatus = 'F'")
        .groupBy(F.col("l_orderkey").cast("string").alias("entity_id"), F.col("l_returnflag").alias("sample_label"))
        .agg(F.when(F.max("l_tax") > 0.05, EN.exhausted).otherwise(EN.failed).alias("state"))
    )
    return membership.progress_spine(orders, LIMITS, held, states, ["o_orderdate"], EN)


_PROGRESS = f"""
    SELECT o.entity_id, p.sample_label, o.title, CAST(p.target AS BIGINT) AS target, coalesce(h.held, 0) AS held,
           CASE WHEN coalesce(h.held, 0) >= p.target THEN 'done' ELSE coalesce(s.state, 'todo') END AS status,
           coalesce(coalesce(h.held, 0) >= p.target OR s.state = 'exhausted', false) AS finished
    FROM (SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, 'Order ' || o_orderkey AS title FROM orders) o
    CROSS JOIN (VALUES {', '.join(f"('{k}', {v})" for k, v in LIMITS.items())}) p(sample_label, target)
    LEFT JOIN (SELECT entity_id, sample_label, count(*) AS held FROM comments_raw GROUP BY 1, 2) h USING (entity_id, sample_label)
    LEFT JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS entity_id, l_returnflag AS sample_label,
                      CASE WHEN max(l_tax) > 0.05 THEN 'exhausted' ELSE 'failed' END AS state
               FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2) s USING (entity_id, sample_label)"""


def progress_spine(spark: SparkSession, d: str) -> DataFrame:
    return _progress(spark, d)


PROGRESS_SPINE = with_ctes("comments_raw", body=_PROGRESS)


def unfinished_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities with a sampling plan still open."""
    progress = _progress(spark, d)
    orders = progress.select("entity_id", "title").distinct()
    return membership.unseen(orders, membership.finished_entities(progress), ["entity_id"])


UNFINISHED_ENTITIES = with_ctes(
    "comments_raw",
    body=f"SELECT entity_id, title FROM ({_PROGRESS}) GROUP BY 1, 2 HAVING NOT bool_and(finished)",
)


def status_after_run(spark: SparkSession, d: str) -> DataFrame:
    """State stored per customer after its order pages were read."""
    pages = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderstatus") == "P").alias("failed"),
        F.bool_or(F.col("o_orderpriority") == "5-LOW").alias("exhausted"),
        F.count("*").alias("held"),
    )
    status = membership.status_after_run(F.col("failed"), F.col("exhausted"), F.col("held"), F.lit(5), EN)
    return pages.select("o_custkey", status.alias("status"))


STATUS_AFTER_RUN = """
SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'failed'
       WHEN bool_or(o_orderpriority = '5-LOW') AND count(*) < 5 THEN 'exhausted' ELSE 'done' END AS status
FROM orders GROUP BY 1"""

QUERIES = {
    "latest_snapshot": (latest_snapshot, LATEST_SNAPSHOT),
    "keep_first": (keep_first, KEEP_FIRST),
    "first_seen_entities": (first_seen_entities, FIRST_SEEN_ENTITIES),
    "first_links": (first_links, FIRST_LINKS),
    "upsert_attempts": (upsert_attempts, UPSERT_ATTEMPTS),
    "rank_limited_sample": (rank_limited_sample, RANK_LIMITED_SAMPLE),
    "pending_entities": (pending_entities, PENDING_ENTITIES),
    "next_batch": (next_batch, NEXT_BATCH),
    "completed_keys": (completed_keys, COMPLETED_KEYS),
    "unseen_links": (unseen_links, UNSEEN_LINKS),
    "unseen_comments": (unseen_comments, UNSEEN_COMMENTS),
    "pending_tags": (pending_tags, PENDING_TAGS),
    "progress_spine": (progress_spine, PROGRESS_SPINE),
    "unfinished_entities": (unfinished_entities, UNFINISHED_ENTITIES),
    "status_after_run": (status_after_run, STATUS_AFTER_RUN),
}
