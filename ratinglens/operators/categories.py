"""Multi-valued categories with fractional weights, shares and cross tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratinglens.functions.text import multivalue
from ratinglens.labels import STUDY_YEARS, ZH, Labels
from ratinglens.operators.membership import year_spine
from ratinglens.operators.ordered import exact_medians


def in_period(df: DataFrame, years: tuple[int, int] = STUDY_YEARS, year: str = "year") -> DataFrame:
    return df.where(F.col(year).between(*years)).withColumn(year, F.col(year).cast("int"))


def weighted_categories(df: DataFrame, categories: str = "categories", labels: Labels = ZH) -> DataFrame:
    """One row per (entity, category) with weight 1/n; no category means "unknown", weight 1."""
    parts = F.col(categories)
    if dict(df.dtypes)[categories] == "string":
        parts = multivalue(parts)
    filled = F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit(labels.unknown)))
    others = [c for c in df.columns if c != categories]
    listed = df.select(*others, filled.alias("_parts"))
    return listed.select(
        *others, F.explode("_parts").alias("category"), (1.0 / F.size("_parts")).alias("weight")
    )


def yearly_counts(df: DataFrame, years: tuple[int, int] = STUDY_YEARS, year: str = "year") -> DataFrame:
    """Rows per year of the period, zero years included."""
    counted = in_period(df, years, year).groupBy(year).agg(F.count("*").alias("n"))
    return year_spine(counted, *years, year=year)


def yearly_category_share(df: DataFrame, years: tuple[int, int] = STUDY_YEARS, labels: Labels = ZH) -> DataFrame:
    """Weight and share of each category per year."""
    period = in_period(df, years)
    weights = (
        weighted_categories(period.select("year", "categories"), labels=labels)
        .groupBy("year", "category")
        .agg(F.sum("weight").alias("weight"))
    )
    # one row per year of the period: never more than the period is long
    totals = F.broadcast(period.groupBy("year").agg(F.count("*").alias("_n")))
    return weights.join(totals, "year").select(
        "year", "category", "weight", (F.col("weight") / F.col("_n")).alias("share")
    )


def sliding_category_share(
    df: DataFrame, years: tuple[int, int] = STUDY_YEARS, reach: int = 1, labels: Labels = ZH
) -> DataFrame:
    """(year, category, weight, share) over each year and its neighbours within ``reach``, as far as the period goes.

    The share's base is all rows of these years, whether or not the category occurs in them; a category has a row for every
    year with an occurrence within reach.
    """

    def spread(rows: DataFrame) -> DataFrame:
        near = F.sequence(F.greatest(F.col("year") - reach, F.lit(years[0])), F.least(F.col("year") + reach, F.lit(years[1])))
        return rows.withColumn("year", F.explode(near))

    period = in_period(df, years)
    yearly = weighted_categories(period.select("year", "categories"), labels=labels).groupBy("year", "category").agg(F.sum("weight").alias("weight"))
    weights = spread(yearly).groupBy("year", "category").agg(F.sum("weight").alias("weight"))
    # one row per year of the period
    totals = spread(period.groupBy("year").agg(F.count("*").alias("n"))).groupBy("year").agg(F.sum("n").alias("_n"))
    return weights.join(F.broadcast(totals), "year").select("year", "category", "weight", (F.col("weight") / F.col("_n")).alias("share"))


def grouped_category_share(
    df: DataFrame, years: tuple[int, int] = STUDY_YEARS, size: int = 5, labels: Labels = ZH
) -> DataFrame:
    """(span, category, weight, share) per group of ``size`` years; ``span`` is the first year of a group, a multiple of its size."""
    span = (F.floor(F.col("year") / size) * size).cast("int").alias("span")
    period = in_period(df, years)
    rows = weighted_categories(period.select("year", "categories"), labels=labels)
    weights = rows.groupBy(span, "category").agg(F.sum("weight").alias("weight"))
    # one row per group of years
    totals = F.broadcast(period.groupBy(span).agg(F.count("*").alias("_n")))
    return weights.join(totals, "span").select("span", "category", "weight", (F.col("weight") / F.col("_n")).alias("share"))


def yearly_origin_share(df: DataFrame, years: tuple[int, int] = STUDY_YEARS) -> DataFrame:
    period = in_period(df, years).where(F.col("origin").isNotNull())
    counts = period.groupBy("year", "origin").agg(F.count("*").alias("n"))
    totals = F.broadcast(in_period(df, years).groupBy("year").agg(F.count("*").alias("_n")))
    return counts.join(totals, "year").select("year", "origin", "n", (F.col("n") / F.col("_n")).alias("share"))


def origin_statistics(df: DataFrame, years: tuple[int, int] = STUDY_YEARS) -> DataFrame:
    """Size, mean score and exact medians of score and votes per origin class."""
    period = in_period(df, years).where(F.col("origin").isNotNull())
    plain = period.groupBy("origin").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"))
    medians = (
        exact_medians(period, ["score", "votes"], ["origin"])
        .groupBy("origin")
        .agg(
            F.max(F.when(F.col("measure") == "score", F.col("median"))).alias("median_score"),
            F.max(F.when(F.col("measure") == "votes", F.col("median"))).alias("median_votes"),
        )
    )
    return plain.join(medians, "origin", "left")


def top_categories(weighted: DataFrame, k: int = 8) -> DataFrame:
    """Heaviest categories, ties by name."""
    totals = weighted.groupBy("category").agg(F.sum("weight").alias("total_weight"))
    # sums of thirds differ in the last bits by row order: compare at 9 digits
    return totals.orderBy(F.round("total_weight", 9).desc(), F.col("category").asc()).limit(k)


def trend_of_top(share: DataFrame, weighted: DataFrame, k: int = 8) -> DataFrame:
    """Yearly shares of the top categories only (long form)."""
    # at most k rows on the broadcast side
    return share.join(F.broadcast(top_categories(weighted, k).select("category")), "category", "left_semi")


def wide_shares(share: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Year x category table of shares; a pair without rows is 0."""
    wide = share.groupBy("year").pivot("category", list(categories)).agg(F.first("share"))
    return wide.na.fill(0.0, list(categories))


def wide_trend(share: DataFrame, weighted: DataFrame, k: int = 8) -> DataFrame:
    """Year x top-k table of shares: ``top_1`` is the heaviest category, a pair without rows is 0, others are left out.

    Which category stands behind a column is the order of ``top_categories``; it is found and joined in one plan.
    """
    heaviest = Window.orderBy(F.round("total_weight", 9).desc(), F.col("category").asc())  # k rows
    places = top_categories(weighted, k).select("category", F.row_number().over(heaviest).alias("place"))
    wide = share.join(F.broadcast(places), "category").groupBy("year").pivot("place", list(range(1, k + 1))).agg(F.first("share"))
    return wide.select("year", *(F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"top_{i}") for i in range(1, k + 1)))


def category_origin_table(
    weighted: DataFrame, classes: Sequence[str], k: int | None = None
) -> DataFrame:
    """Category x origin weights, optionally only the ``k`` heaviest rows."""
    table = weighted.groupBy("category").pivot("origin", list(classes)).agg(F.sum("weight"))
    table = table.na.fill(0.0, list(classes))
    if k is None:
        return table
    total = sum((F.col(f"`{c}`") for c in classes[1:]), F.col(f"`{classes[0]}`"))
    return table.orderBy(F.round(total, 9).desc(), F.col("category").asc()).limit(k)


def tag_coverage(links: DataFrame, entities: DataFrame, years: tuple[int, int] = STUDY_YEARS) -> DataFrame:
    """Distinct entities per (year, tag).

    Links are made unique before the join, so a heavily linked entity brings one
    row per tag and the count afterwards needs no second distinct.
    """
    unique = links.where(F.col("entity_id").isNotNull() & F.col("tag").isNotNull()).select("entity_id", "tag").distinct()
    dated = in_period(entities, years).select("entity_id", "year").distinct()
    return unique.join(dated, "entity_id").groupBy("year", "tag").agg(F.count("*").alias("entities"))
