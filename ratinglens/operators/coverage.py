"""Completeness of paged sources: which positions the pages that were read cover without a hole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Results that a source lists at most.
LISTED_AT_MOST = 200


def islands(intervals: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """The intervals [start, end) with ``reach``, the end of what those before cover, and ``island``, 0 while nothing is missing.

    A key's intervals with one start are merged before the shuffle, so a window holds one row per distinct start. An
    interval that begins behind the reach opens a new island; position 0 is reached from the beginning.
    """
    merged = intervals.groupBy(*keys, start).agg(F.max(end).alias(end))
    ordered = W.partitionBy(*keys).orderBy(start)
    reach = F.coalesce(F.max(end).over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    opened = merged.withColumn("reach", F.greatest(reach, F.lit(0)))
    gap = (F.col(start) > F.col("reach")).cast("int")
    return opened.withColumn("island", F.sum(gap).over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))


def tag_completeness(pages: DataFrame, listed_at_most: int = LISTED_AT_MOST, keys: Sequence[str] = ("tag",)) -> DataFrame:
    """(tag, covered, ends, holes, failed_pages, complete) from the facts of search pages, repeated and overlapping ones too.

    A page that was read at least once is good. ``covered`` counts the positions from 0 that good pages cover without a hole;
    the source ``ends`` where the first short page behind no hole ends (NULL while none is known). A tag is complete
    when it is covered up to that end or to the most that is listed, and no page before that only ever failed.
    """
    keys = list(keys)
    good = ~F.col("failed")
    tried = pages.groupBy(*keys, "page_start").agg(
        F.max(F.when(good, F.col("page_start") + F.col("got"))).alias("end"),
        F.coalesce(F.bool_or(good & (F.col("got") < F.col("asked"))), F.lit(False)).alias("short"),
    )
    read = islands(tried.where("end IS NOT NULL").withColumnRenamed("page_start", "start"), keys)
    whole = F.col("island") == 0
    # the pages of a key with their islands: what was tried and never read has none
    joined = tried.join(read.withColumnsRenamed({"start": "page_start", "end": "_end"}), [*keys, "page_start"], "left")
    facts = joined.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(whole, F.col("end"))), F.lit(0)).alias("covered"),
        F.min(F.when(whole & F.col("short"), F.col("end"))).alias("ends"),
        F.coalesce(F.max("island"), F.lit(0)).alias("holes"),
        F.count_if(F.col("end").isNull()).alias("failed_pages"),
        F.min(F.when(F.col("end").isNull(), F.col("page_start"))).alias("_first_failed"),
    )
    until = F.coalesce("ends", F.lit(listed_at_most))
    complete = (F.col("covered") >= F.least(until, F.lit(listed_at_most))) & F.coalesce(F.col("_first_failed") >= until, F.lit(True))
    return facts.withColumn("complete", complete).drop("_first_failed")


def complete_tags(pages: DataFrame, listed_at_most: int = LISTED_AT_MOST, tag: str = "tag") -> DataFrame:
    """Tags whose search pages are complete."""
    return tag_completeness(pages, listed_at_most, [tag]).where("complete").select(tag)
