"""Collection log: failure state, attempts, page outcomes, progress, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.labels import EN
from ratinglens.operators import crawl_log
from ratinglens.operators.membership import held_counts
from ratinglens.operators.stats import star_metrics
from ratinglens.plans.analysis import analysis_summary, metric_comparison
from ratinglens.plans.cleaning import clean_comments
from ratinglens.functions.rating import shrunk_score
from ratinglens.operators.ordered import exact_quantiles
from ratinglens.operators.quadrants import rated_rows
from workload.standins import (
    COMMENT_ORDER,
    YEARS,
    attempts,
    collection_events,
    comments_raw,
    stored_entities,
    table,
    with_ctes,
)

_STATE = """entity_id, title, last_reason, first_round, last_round, failed_rounds, permanent_rounds, permanent_streak, status,
            strftime(first_failed_at, '%Y-%m-%d %H:%M:%S') AS first_failed_at, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at"""


def _state(spark: SparkSession, d: str) -> DataFrame:
    return crawl_log.failure_state(crawl_log.round_facts(collection_events(spark, d)), EN)


def _as_text(state: DataFrame) -> DataFrame:
    return state.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_failed_at", "updated_at")})


def failure_states(spark: SparkSession, d: str) -> DataFrame:
    """Fold of the failure and success events of each user."""
    return _as_text(_state(spark, d))


FAILURE_STATES = with_ctes("failure_states", body=f"SELECT {_STATE} FROM failure_states")


def unavailable_entities(spark: SparkSession, d: str) -> DataFrame:
    return _as_text(crawl_log.unavailable(_state(spark, d), EN))


UNAVAILABLE_ENTITIES = with_ctes(
    "failure_states", body=f"SELECT {_STATE} FROM failure_states WHERE status = 'unavailable'"
)


def round_order_violations(spark: SparkSession, d: str) -> DataFrame:
    """Rounds that start before an earlier round ended, under event order by value."""
    events = collection_events(spark, d).withColumn("seq", F.col("seq.event_id") % 1000)
    return crawl_log.round_order_violations(crawl_log.round_facts(events))


ROUND_ORDER_VIOLATIONS = with_ctes(
    "collection_events",
    body="""SELECT entity_id, round FROM (SELECT entity_id, round, lo, max(hi) OVER (PARTITION BY entity_id ORDER BY round
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
            FROM (SELECT entity_id, round, min(event_id % 1000) AS lo, max(event_id % 1000) AS hi FROM collection_events GROUP BY 1, 2))
            WHERE before > lo""",
)


def failed_attempts(spark: SparkSession, d: str) -> DataFrame:
    """Failures numbered within (entity, round)."""
    return attempts(spark, d).select("entity_id", "round", "attempt", "level", "reason")


FAILED_ATTEMPTS = with_ctes("attempts", body="SELECT entity_id, round, attempt, level, reason FROM attempts")


def continued_attempts(spark: SparkSession, d: str) -> DataFrame:
    """Attempts of each afternoon numbered on from those logged in the morning."""
    failed = collection_events(spark, d).where(~F.col("ok")).select(
        "entity_id", "round", "reason", "at", F.col("seq.event_id").alias("event_id")
    )
    morning = F.hour("at") < 12
    logged = crawl_log.number_attempts(
        failed.where(morning), attempts(spark, d).where(F.lit(False)), "at", ["event_id"]
    )
    new = crawl_log.number_attempts(failed.where(~morning), logged, "at", ["event_id"])
    return new.select("entity_id", "round", "event_id", "attempt")


CONTINUED_ATTEMPTS = with_ctes(
    "collection_events",
    body="""SELECT entity_id, round, event_id, attempt FROM (
              SELECT entity_id, round, event_id, ts, CAST(row_number() OVER (PARTITION BY entity_id, round ORDER BY ts, event_id) AS INTEGER) AS attempt
              FROM collection_events WHERE NOT ok) WHERE hour(ts) >= 12""",
)


def round_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Rounds that failed for good, with the reason of the last attempt."""
    lost = crawl_log.round_outcomes(attempts(spark, d), 1, "request")
    return lost.select("entity_id", "round", "reason", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("failed_at"))


ROUND_OUTCOMES = with_ctes(
    "attempts",
    body="""SELECT entity_id, round, arg_max(reason, attempt) AS reason, strftime(max(failed_at), '%Y-%m-%d %H:%M:%S') AS failed_at
            FROM attempts GROUP BY 1, 2 HAVING count(*) FILTER (level = 'request') > 1""",
)


def next_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Next attempt per (entity, round)."""
    return crawl_log.next_attempts(attempts(spark, d))


NEXT_NUMBERS = with_ctes(
    "attempts",
    body="SELECT entity_id, round, CAST(max(attempt) + 1 AS INTEGER) AS next_attempt FROM attempts GROUP BY 1, 2",
)


def next_round(spark: SparkSession, d: str) -> DataFrame:
    return crawl_log.next_round(_state(spark, d))


NEXT_ROUND = with_ctes(
    "failure_states", body="SELECT CAST(coalesce(max(last_round), 0) + 1 AS INTEGER) AS next_round FROM failure_states"
)


def permanent_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Failures by permanence of their reason."""
    failed = collection_events(spark, d).where(~F.col("ok"))
    return failed.groupBy("reason").agg(
        F.count("*").alias("n"), F.bool_or(crawl_log.is_permanent(F.col("reason"))).alias("permanent")
    )


PERMANENT_REASONS = with_ctes(
    "collection_events",
    body="""SELECT reason, count(*) AS n, reason IN ('HTTP 400', 'HTTP 404', 'HTTP 410') AS permanent
            FROM collection_events WHERE NOT ok GROUP BY 1""",
)


def held_comment_counts(spark: SparkSession, d: str) -> DataFrame:
    return held_counts(comments_raw(spark, d))


HELD_COMMENT_COUNTS = with_ctes(
    "comments_raw", body="SELECT entity_id, sample_label, count(*) AS held FROM comments_raw GROUP BY 1, 2"
)


def page_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Whether each order's pages failed or reached the end; a line plays a page."""
    lines = table(spark, d, "lineitem")
    pages = lines.select(
        F.col("l_orderkey").cast("string").alias("entity_id"),
        F.col("l_returnflag").alias("sample_label"),
        ((F.col("l_linenumber") - 1) * 20).alias("page_start"),
        F.lit(20).alias("asked"),
        F.least(F.col("l_quantity").cast("int"), F.lit(20)).alias("got"),
        F.lit(100).alias("total"),
        (F.col("l_discount") >= 0.1).alias("failed"),
    )
    return crawl_log.page_outcomes(pages)


PAGE_OUTCOMES = """
SELECT CAST(l_orderkey AS VARCHAR) AS entity_id, l_returnflag AS sample_label, bool_or(failed) AS failed,
       NOT bool_or(failed) AND bool_or(NOT failed AND (got < 20 OR page_start + got >= 100)) AS exhausted
FROM (SELECT *, l_discount >= 0.1 AS failed, least(CAST(l_quantity AS INTEGER), 20) AS got, (l_linenumber - 1) * 20 AS page_start FROM lineitem)
GROUP BY 1, 2"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("entity_id")).distinct()


def _details(spark: SparkSession, d: str) -> DataFrame:
    return collection_events(spark, d).where("ok AND round <= 2").select("entity_id")


def pipeline_status(spark: SparkSession, d: str) -> DataFrame:
    """Target, collected, unavailable, processed, pending and comment counts."""
    return crawl_log.pipeline_status(
        _candidates(spark, d), _details(spark, d), _state(spark, d), comments_raw(spark, d), EN
    )


PIPELINE_STATUS = with_ctes(
    "failure_states",
    "comments_raw",
    body="""SELECT (SELECT count(DISTINCT user_id) FROM events) AS target, (SELECT count(DISTINCT entity_id) FROM got) AS collected,
                   (SELECT count(*) FROM lost) AS unavailable,
                   (SELECT count(*) FROM (SELECT entity_id FROM got UNION SELECT entity_id FROM lost)) AS processed,
                   (SELECT count(DISTINCT user_id) FROM events WHERE CAST(user_id AS VARCHAR) NOT IN
                      (SELECT entity_id FROM got UNION SELECT entity_id FROM lost)) AS pending,
                   (SELECT count(*) FROM comments_raw) AS comments""",
).replace("\nSELECT (SELECT", """,
got AS (SELECT entity_id FROM collection_events WHERE ok AND round <= 2),
lost AS (SELECT entity_id FROM failure_states WHERE status = 'unavailable')
SELECT (SELECT""", 1)


def collection_loss(spark: SparkSession, d: str) -> DataFrame:
    loss = crawl_log.collection_loss(_candidates(spark, d), _state(spark, d), EN)
    return loss.withColumn("unavailable_ratio", F.round("unavailable_ratio", 6))


COLLECTION_LOSS = with_ctes(
    "failure_states",
    body="""SELECT c AS candidates, u AS unavailable, round(u / c, 6) AS unavailable_ratio FROM
            (SELECT (SELECT count(DISTINCT user_id) FROM events) AS c, (SELECT count(*) FROM failure_states WHERE status = 'unavailable') AS u)""",
)


def _analysed(spark: SparkSession, d: str) -> DataFrame:
    # the columns that the summary reads: without categories no sets of part types are built
    rows = stored_entities(spark, d, "entity_id", "year", "origin", "score", "votes", "short_rate", "long_rate")
    rated = rated_rows(rows)
    mean = rated.agg(F.avg("score").alias("c")).scalar()
    votes = exact_quantiles(rated, "votes", {"m": 0.5}).scalar()
    return rows.withColumn("shrunk_score", shrunk_score(F.col("score"), F.col("votes"), mean, votes))


def summary(spark: SparkSession, d: str) -> DataFrame:
    """All seventeen summary values as (module, metric, value)."""
    cleaned = _analysed(spark, d)
    metrics = star_metrics(clean_comments(comments_raw(spark, d), COMMENT_ORDER))
    rows = analysis_summary(
        cleaned, metric_comparison(metrics, cleaned), _candidates(spark, d), _state(spark, d), YEARS, EN
    )
    return rows.select("module", "metric", F.round("value", 6).alias("value"))


def _rho(name: str, x: str, y: str) -> str:
    return f"""SELECT 'A', '{name}_spearman', round(corr(rx, ry), 6) FROM (
        SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2 AS rx,
               rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2 AS ry
        FROM rated WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"""


SUMMARY = with_ctes(
    "rated",
    "period",
    "comment_metrics",
    "failure_states",
    body="""
    SELECT 'A' AS module, 'valid_entities' AS metric, count(*)::DOUBLE AS value FROM rated
    UNION ALL SELECT 'A', 'score_mean', round(avg(score), 6) FROM rated
    UNION ALL SELECT 'A', 'score_median', round(median(score), 6) FROM rated
    UNION ALL """
    + " UNION ALL ".join(
        [
            _rho("votes_score", "votes", "score"),
            _rho("short_rate_score", "short_rate", "score"),
            _rho("short_rate_votes", "short_rate", "votes"),
            _rho("long_rate_score", "long_rate", "score"),
            _rho("long_rate_votes", "long_rate", "votes"),
        ]
    )
    + """
    UNION ALL SELECT 'A', 'entities_with_comments', count(DISTINCT entity_id)::DOUBLE FROM comment_metrics
    UNION ALL SELECT 'A', 'sample_minus_score_mean', round(avg(mean_star * 2 - score), 6)
              FROM comment_metrics LEFT JOIN (SELECT entity_id, score FROM entities) USING (entity_id)
    UNION ALL SELECT 'B', 'period_entities', count(*)::DOUBLE FROM period
    UNION ALL SELECT 'B', 'yearly_min', min(n)::DOUBLE FROM (SELECT count(*) AS n FROM period GROUP BY year)
    UNION ALL SELECT 'B', 'yearly_median', median(n)::DOUBLE FROM (SELECT count(*) AS n FROM period GROUP BY year)
    UNION ALL SELECT 'B', 'home_import_cohens_d', round((avg(a) - avg(b)) / sqrt(((count(a) - 1) * var_samp(a) + (count(b) - 1) * var_samp(b))
              / (count(a) + count(b) - 2)), 6)
              FROM (SELECT CASE WHEN origin = 'domestic' THEN score END AS a, CASE WHEN origin = 'import' THEN score END AS b FROM period)
    UNION ALL SELECT 'quality', 'candidates', count(DISTINCT user_id)::DOUBLE FROM events
    UNION ALL SELECT 'quality', 'unavailable', count(*)::DOUBLE FROM failure_states WHERE status = 'unavailable'
    UNION ALL SELECT 'quality', 'unavailable_ratio',
              round((SELECT count(*) FROM failure_states WHERE status = 'unavailable') / count(DISTINCT user_id), 6) FROM events""",
)


def sample_loss(spark: SparkSession, d: str) -> DataFrame:
    """Share of duplicate comments and of orders without any comment."""
    raw = comments_raw(spark, d)
    counts = raw.groupBy("comment_id", "sample_label").count().agg(
        F.sum("count").alias("rows"), F.count("*").alias("kept")
    )
    held = raw.select("entity_id").distinct()
    orders = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("entity_id"))
    empty = orders.join(held, "entity_id", "left_anti").agg(F.count("*")).scalar()
    whole = orders.agg(F.count("*")).scalar()
    return counts.select(
        "rows",
        F.round(1 - F.col("kept") / F.col("rows"), 6).alias("duplicate_share"),
        F.round(empty / whole, 6).alias("missing_share"),
    )


SAMPLE_LOSS = """
SELECT (SELECT count(*) FROM lineitem) AS rows,
       round(1 - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)) / (SELECT count(*) FROM lineitem), 6) AS duplicate_share,
       round((SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) / (SELECT count(*) FROM orders), 6) AS missing_share"""

QUERIES = {
    "failure_states": (failure_states, FAILURE_STATES),
    "unavailable_entities": (unavailable_entities, UNAVAILABLE_ENTITIES),
    "round_order_violations": (round_order_violations, ROUND_ORDER_VIOLATIONS),
    "failed_attempts": (failed_attempts, FAILED_ATTEMPTS),
    "continued_attempts": (continued_attempts, CONTINUED_ATTEMPTS),
    "round_outcomes": (round_outcomes, ROUND_OUTCOMES),
    "next_attempts": (next_numbers, NEXT_NUMBERS),
    "next_round": (next_round, NEXT_ROUND),
    "permanent_reasons": (permanent_reasons, PERMANENT_REASONS),
    "held_comment_counts": (held_comment_counts, HELD_COMMENT_COUNTS),
    "page_outcomes": (page_outcomes, PAGE_OUTCOMES),
    "pipeline_status": (pipeline_status, PIPELINE_STATUS),
    "collection_loss": (collection_loss, COLLECTION_LOSS),
    "analysis_summary": (summary, SUMMARY),
    "sample_loss": (sample_loss, SAMPLE_LOSS),
}
