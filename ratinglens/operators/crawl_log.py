"""Failure state, attempt numbering and progress counts from collection logs.

Events are rows ``entity_id, title, round, seq, ok, reason, at``: ``seq`` orders
the events of one entity, ``ok`` tells a success from a failure, and rounds do
not decrease along ``seq`` (``round_order_violations`` lists exceptions).

The state of an entity is a fold over its events. It is computed with plain
aggregations only: first per (entity, round), then over pairs of neighbouring
rounds, then per entity. Each step combines before its shuffle, so an entity
with a third of all events never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratinglens.labels import PERMANENT_REASONS, ZH, Labels
from ratinglens.operators.membership import pending, union_of_keys
from ratinglens.operators.ordered import numbered

UNAVAILABLE_AFTER = 2


def is_permanent(reason: Column, reasons: Sequence[str] = PERMANENT_REASONS) -> Column:
    return F.coalesce(reason.isin(*reasons), F.lit(False))


def round_facts(events: DataFrame) -> DataFrame:
    """Per (entity, round): first and last failure, first and last success."""
    failure = F.when(
        ~F.col("ok"),
        F.struct("seq", is_permanent(F.col("reason")).alias("permanent"), "reason", "title", "at"),
    )
    success = F.when(F.col("ok"), F.struct("seq", "at"))
    return events.groupBy("entity_id", "round").agg(
        F.min(failure).alias("first"),
        F.max(failure).alias("last"),
        F.min(success).alias("first_ok"),
        F.max(success).alias("last_ok"),
    )


#: A (entity, round) with its facts, as an element of a stored list.
FACTS = ("round", "first", "last", "first_ok", "last_ok")


def merge_facts(facts: DataFrame) -> DataFrame:
    """Facts of one (entity, round) that were found in several places, as one row."""
    return facts.groupBy("entity_id", "round").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("first_ok").alias("first_ok"), F.max("last_ok").alias("last_ok")
    )


def summarise(facts: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """One row per entity with what the state needs of its rounds.

    ``before`` holds such rows of earlier rounds; they are carried on, so rounds can be folded bit by bit. All
    values are counts, minima and maxima, so everything combines before the shuffle.

    A round continues the streak of permanent failures when its first reason is
    permanent, the previous round also failed and ended on a permanent reason,
    and no success lies between. The round after which no break follows starts
    the current streak, so its length is a difference of round numbers.
    """
    success_after = F.coalesce(F.col("last_ok.seq") > F.col("first.seq"), F.lit(False))
    success_before = F.coalesce(F.col("first_ok.seq") < F.col("first.seq"), F.lit(False))
    carries = F.coalesce(F.col("last.permanent") & ~success_after, F.lit(False))
    own = F.struct("first", "last", "last_ok", success_before.alias("success_before"), carries.alias("carries"))
    own_type = _type_of(facts, own)
    none = F.lit(None)
    halves = facts.select(
        "entity_id",
        F.inline(
            F.array(
                F.struct(F.col("round").alias("round"), own.alias("own"), none.cast("boolean").alias("carried")),
                F.struct((F.col("round") + 1).alias("round"), none.cast(own_type).alias("own"), carries.alias("carried")),
            )
        ),
    )
    if before is not None:
        ended = before.where("last IS NOT NULL").select(
            "entity_id", (F.col("last.round") + 1).alias("round"), none.cast(own_type).alias("own"), F.col("last.carries").alias("carried")
        )
        halves = halves.unionByName(ended)
    # a (entity, round) group holds at most two rows here
    rounds = (
        halves.groupBy("entity_id", "round")
        .agg(F.first("own", ignorenulls=True).alias("own"), F.bool_or("carried").alias("carried"))
        .where(F.col("own").isNotNull())
        .select("entity_id", "round", "own.*", F.coalesce("carried", F.lit(False)).alias("carried"))
    )
    failed = F.col("first").isNotNull()
    permanent = F.col("first.permanent")
    breaks = failed & ~(permanent & F.col("carried") & ~F.col("success_before"))
    parts = rounds.select(
        "entity_id",
        F.when(failed, 1).otherwise(0).alias("failed_rounds"),
        F.when(failed & permanent, 1).otherwise(0).alias("permanent_rounds"),
        F.when(failed, F.struct("round", F.col("first.at").alias("at"))).alias("head"),
        F.when(failed, F.struct("round", F.col("first.seq").alias("first_seq"), F.col("last").alias("last"))).alias("tail"),
        F.when(breaks, F.struct("round", permanent.cast("int").alias("permanent"))).alias("island"),
        F.col("last_ok").alias("ok"),
        F.struct("round", "carries").alias("last"),
    )
    if before is not None:
        parts = parts.unionByName(before)
    return parts.groupBy("entity_id").agg(
        F.sum("failed_rounds").cast("int").alias("failed_rounds"),
        F.sum("permanent_rounds").cast("int").alias("permanent_rounds"),
        *(f(c).alias(c) for f, c in ((F.min, "head"), (F.max, "tail"), (F.max, "island"), (F.max, "ok"), (F.max, "last"))),
    )


def failure_state(facts: DataFrame, labels: Labels = ZH, before: DataFrame | None = None) -> DataFrame:
    """One row per entity that ever failed, from its facts and what ``summarise`` kept of earlier rounds."""
    per_entity = summarise(facts, before).where(F.col("failed_rounds") > 0)
    run = F.col("tail.round") - F.col("island.round") + F.col("island.permanent")
    reset = F.coalesce(F.col("ok.seq") > F.col("tail.first_seq"), F.lit(False))
    streak = F.when(reset, 0).otherwise(run)
    recovered = F.coalesce(F.col("ok.seq") > F.col("tail.last.seq"), F.lit(False))
    return per_entity.select(
        "entity_id",
        F.col("tail.last.title").alias("title"),
        F.col("tail.last.reason").alias("last_reason"),
        F.col("head.round").alias("first_round"),
        F.col("tail.round").alias("last_round"),
        "failed_rounds",
        "permanent_rounds",
        streak.cast("int").alias("permanent_streak"),
        F.when(recovered, labels.recovered)
        .when(streak >= UNAVAILABLE_AFTER, labels.unavailable)
        .otherwise(labels.pending)
        .alias("status"),
        F.col("head.at").alias("first_failed_at"),
        F.when(recovered, F.col("ok.at")).otherwise(F.col("tail.last.at")).alias("updated_at"),
    )


def _type_of(df: DataFrame, column: Column) -> str:
    return df.select(column.alias("c")).schema["c"].dataType.simpleString()


def round_order_violations(facts: DataFrame) -> DataFrame:
    """Entities whose event order runs against their round numbers.

    The window spans the rounds of an entity, a number bounded by the runs made.
    """
    low = F.least(F.col("first.seq"), F.col("first_ok.seq"))
    high = F.greatest(F.col("last.seq"), F.col("last_ok.seq"))
    earlier = W.partitionBy("entity_id").orderBy("round").rowsBetween(W.unboundedPreceding, -1)
    spans = facts.select("entity_id", "round", low.alias("low"), F.max(high).over(earlier).alias("before"))
    return spans.where(F.col("before") > F.col("low")).select("entity_id", "round")


def round_outcomes(attempts: DataFrame, retries: int, request_level: str) -> DataFrame:
    """(entity, round) pairs that failed for good: every allowed retry failed.

    The last attempt gives the reason and the time.
    """
    grouped = attempts.groupBy("entity_id", "round").agg(
        F.max(F.struct("attempt", "reason", "title", "failed_at")).alias("last"),
        F.count_if(F.col("level") == request_level).alias("requests"),
    )
    return grouped.where(F.col("requests") > retries).select(
        "entity_id",
        "round",
        F.col("last.title").alias("title"),
        F.col("last.reason").alias("reason"),
        F.col("last.failed_at").alias("at"),
    )


def unavailable(state: DataFrame, labels: Labels = ZH) -> DataFrame:
    """Snapshot of the unavailable entities, derived from the state table."""
    return state.where(F.col("status") == labels.unavailable)


def next_round(state: DataFrame) -> DataFrame:
    return state.agg((F.coalesce(F.max("last_round"), F.lit(0)) + 1).cast("int").alias("next_round"))


def next_attempts(attempts: DataFrame) -> DataFrame:
    """Number the next attempt gets, per (entity, round)."""
    return attempts.groupBy("entity_id", "round").agg((F.max("attempt") + 1).cast("int").alias("next_attempt"))


def number_attempts(new: DataFrame, logged: DataFrame, order: str, ties: Sequence[str]) -> DataFrame:
    """Attempt numbers for new log rows, continuing after the rows already logged."""
    keys = ["entity_id", "round"]
    held = logged.groupBy(*keys).agg(F.max("attempt").alias("_held"))
    return (
        numbered(new, keys, order, ties, "_position")
        .join(held, keys, "left")
        .withColumn("attempt", (F.col("_position") + F.coalesce("_held", F.lit(0))).cast("int"))
        .drop("_position", "_held")
    )


def page_outcomes(pages: DataFrame, keys: Sequence[str] = ("entity_id", "sample_label")) -> DataFrame:
    """Per key: did a page fail, and was the source read to its end.

    A page ends the source when it is shorter than asked or reaches the total.
    """
    reached = (F.col("total") > 0) & (F.col("page_start") + F.col("got") >= F.col("total"))
    last_page = (F.col("got") < F.col("asked")) | F.coalesce(reached, F.lit(False))
    failed = F.bool_or("failed")
    return pages.groupBy(*keys).agg(
        failed.alias("failed"),
        (~failed & F.coalesce(F.bool_or(~F.col("failed") & last_page), F.lit(False))).alias("exhausted"),
    )


def pipeline_status(
    candidates: DataFrame, details: DataFrame, state: DataFrame, comments: DataFrame, labels: Labels = ZH
) -> DataFrame:
    """One row of progress counts: one aggregation by key over all three tables, and one over its result."""
    lost = unavailable(state, labels)

    def marked(df: DataFrame, mark: str) -> DataFrame:
        return df.select("entity_id", F.lit(mark).alias("mark"))

    rows = marked(candidates, "candidate").unionByName(marked(details, "detail")).unionByName(marked(lost, "lost"))
    named = F.col("entity_id") != ""
    by_key = rows.groupBy("entity_id").agg(
        F.count_if(F.col("mark") == "candidate").alias("wanted"),
        F.count_if(F.col("mark") == "lost").alias("lost"),
        F.coalesce(F.bool_or(named & (F.col("mark") == "detail")), F.lit(False)).alias("held"),
        F.coalesce(F.bool_or(named & (F.col("mark") == "lost")), F.lit(False)).alias("gone"),
    )
    total = by_key.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (("wanted", "target"), ("lost", "unavailable"))),
        F.count_if("held").alias("collected"),
        F.count_if(F.col("held") | F.col("gone")).alias("processed"),
        F.coalesce(F.sum(F.when(~F.col("held") & ~F.col("gone"), F.col("wanted"))), F.lit(0)).alias("pending"),
    )
    counted = comments.agg(F.count("*").alias("n")).scalar()
    return total.select("target", "collected", "unavailable", "processed", "pending", counted.alias("comments"))


def collection_loss(candidates: DataFrame, state: DataFrame, labels: Labels = ZH) -> DataFrame:
    """Candidates, unavailable entities and their ratio (NULL without candidates)."""
    lost = unavailable(state, labels).agg(F.count("*").alias("n")).scalar()
    counted = candidates.agg(F.count("*").alias("candidates")).withColumn("unavailable", lost)
    ratio = F.try_divide(F.col("unavailable"), F.nullif("candidates", F.lit(0)))
    return counted.withColumn("unavailable_ratio", ratio)
