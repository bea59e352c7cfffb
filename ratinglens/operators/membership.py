"""Pending sets, set differences, lookups and zero-filled spines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratinglens.labels import ZH, Labels
from ratinglens.operators.snapshot import keep_last


def union_of_keys(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct non-empty keys over several tables."""
    parts = [f.select(key).where(F.col(key) != "") for f in frames]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def pending(candidates: DataFrame, completed: Sequence[DataFrame], key: str = "entity_id") -> DataFrame:
    """Candidates found in none of the completed tables."""
    return candidates.join(union_of_keys(completed, key), key, "left_anti")


def unseen(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the stored table does not hold; stored keys are reduced first."""
    return new.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def semi(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(wanted.select(*keys), list(keys), "left_semi")


def pending_tags(tags: DataFrame, done: DataFrame, tag: str = "tag", position: str = "tag_order") -> DataFrame:
    """Tags of the fixed list that are not completed, in list order."""
    return unseen(tags, done, [tag]).orderBy(position)


def year_spine(yearly: DataFrame, first: int, last: int, year: str = "year", count: str = "n") -> DataFrame:
    """Every year of the range; years without rows count zero."""
    years = yearly.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias(year)
    )
    return years.join(yearly, year, "left").select(year, F.coalesce(count, F.lit(0)).cast("bigint").alias(count))


def sample_finished(held: Column, limit: Column, state: Column, labels: Labels = ZH) -> Column:
    """Never NULL: the quota is met or the source is exhausted."""
    return F.coalesce((held >= limit) | (state == labels.exhausted), F.lit(False))


def sample_status(held: Column, limit: Column, state: Column, labels: Labels = ZH) -> Column:
    return F.when(held >= limit, labels.done).otherwise(F.coalesce(state, F.lit(labels.todo)))


def status_after_run(
    failed: Column, exhausted: Column, held: Column, limit: Column, labels: Labels = ZH
) -> Column:
    """State stored for a sample after its pages were read."""
    return (
        F.when(failed, labels.failed).when(exhausted & (held < limit), labels.exhausted).otherwise(labels.done)
    )


def held_counts(comments: DataFrame, key: str = "entity_id", label: str = "sample_label") -> DataFrame:
    """Comments held per (entity, label); rows lacking any key part do not count."""
    present = comments.where((F.col("comment_id") != "") & (F.col(key) != "") & (F.col(label) != ""))
    return present.groupBy(key, label).agg(F.count("*").alias("held"))


def progress_spine(
    entities: DataFrame,
    limits: Mapping[str, int],
    held: DataFrame,
    states: DataFrame,
    order_by: Sequence[str],
    labels: Labels = ZH,
) -> DataFrame:
    """Every entity x every sampling plan with held count, status and finished mark.

    The plan is a fixed literal list, so it is exploded rather than joined.
    """
    plan = F.array(
        *[F.struct(F.lit(k).alias("sample_label"), F.lit(v).alias("target")) for k, v in limits.items()]
    )
    spine = keep_last(entities, ["entity_id"], order_by).select("entity_id", "title", F.inline(plan))
    keys = ["entity_id", "sample_label"]
    joined = spine.join(held, keys, "left").join(states.select(*keys, "state"), keys, "left")
    count = F.coalesce("held", F.lit(0)).cast("bigint")
    return joined.select(
        *keys,
        "title",
        F.col("target").cast("bigint").alias("target"),
        count.alias("held"),
        sample_status(count, F.col("target"), F.col("state"), labels).alias("status"),
        sample_finished(count, F.col("target"), F.col("state"), labels).alias("finished"),
    )


def finished_entities(progress: DataFrame, key: str = "entity_id") -> DataFrame:
    """Entities with every sampling plan finished."""
    done = progress.groupBy(key).agg(F.bool_and("finished").alias("all_done"))
    return done.where("all_done").select(key)
