"""One row per key, bounded samples per key, and idempotent log upserts.

All of them filter ``row_number() <= k``. Spark turns that into a group limit
before the shuffle, so a key holding a third of the input sends at most ``k``
rows per map task and no task ever sorts the whole group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key under a total order."""
    window = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= k).drop("_rn")


def latest_snapshot(df: DataFrame, key: str, captured: str, ties: Sequence[str]) -> DataFrame:
    """Newest row per key; rows with a valid capture time beat rows without one."""
    order = [F.col(captured).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]]
    return top_rows(df, [key], order)


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return top_rows(df, keys, [F.col(c).desc_nulls_last() for c in order_by])


def keep_first(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """First row per key; rows whose key is missing or empty are dropped."""
    present = df.where(F.col(key) != "")
    return top_rows(present, [key], [F.col(c).asc_nulls_last() for c in order_by])


def first_seen_entities(
    hits: DataFrame, key: str = "entity_id", tag_order: str = "tag_order", rank: str = "rank"
) -> DataFrame:
    """Row through which each entity first entered the pool, over ordered tag results."""
    return keep_first(hits, key, [tag_order, rank])


def first_links(
    hits: DataFrame, key: str = "entity_id", tag: str = "tag", rank: str = "rank"
) -> DataFrame:
    """One row per (entity, tag) with its best rank."""
    return hits.where(F.col(key) != "").groupBy(key, tag).agg(F.min(rank).alias(rank))


def upsert_log(stored: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Stored rows plus new rows; on equal keys the new row, then the later one, wins."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return keep_last(both, keys, ["_new", *order_by]).drop("_new")


def rank_limited_sample(
    df: DataFrame,
    limits: Mapping[str, int],
    key: str = "entity_id",
    label: str = "sample_label",
    order_by: Sequence[str] = ("position",),
) -> DataFrame:
    """First rows per (key, label) in source order, as many as the label's plan allows."""
    wanted = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    window = W.partitionBy(key, label).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return (
        df.where(F.col(label).isin(*limits))
        .withColumn("_rn", F.row_number().over(window))
        # the literal bound becomes a group limit ahead of the shuffle
        .where(F.col("_rn") <= max(limits.values()))
        .where(F.col("_rn") <= F.try_element_at(wanted, F.col(label)))
        .drop("_rn")
    )


def source_order(df: DataFrame, seq: str) -> DataFrame:
    return df.orderBy(F.col(seq).asc())


def batch_of(df: DataFrame, seq: str, size: int) -> DataFrame:
    """The next batch in source order, at least one row."""
    return df.orderBy(F.col(seq).asc()).limit(max(1, size))
