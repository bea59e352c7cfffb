"""The result tables of the rating and category studies, as one set of lazy frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.labels import STUDY_YEARS, ZH, Labels
from ratinglens.operators import categories as cats
from ratinglens.operators.crawl_log import collection_loss
from ratinglens.operators.ordered import exact_medians
from ratinglens.operators.quadrants import entity_quadrants, quadrant_sensitivity, rated_rows
from ratinglens.operators.stats import cohens_d, frequency_table, spearman

# Stability of ratings / category structure / collection quality.
STABILITY, STRUCTURE, QUALITY = "A", "B", "quality"


def shrinkage_table(cleaned: DataFrame) -> DataFrame:
    """Raw minus shrunk score, largest drop first."""
    kept = rated_rows(cleaned).na.drop(subset=["shrunk_score"])
    table = kept.select(
        "entity_id", "title", "score", "votes", "shrunk_score", (F.col("score") - F.col("shrunk_score")).alias("difference")
    )
    return table.orderBy(F.col("difference").desc_nulls_last(), F.col("entity_id").asc())


def metric_comparison(metrics: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Comment metrics next to the overall score, on the ten-point scale."""
    joined = metrics.join(cleaned.select("entity_id", "score"), "entity_id", "left")
    ten = F.col("mean_star") * 2
    return joined.select("*", ten.alias("sample_ten"), (ten - F.col("score")).alias("sample_minus_score"))


def measures_long(metrics: DataFrame) -> DataFrame:
    """Three star measures, one row each."""
    names = ["mean_star", "useful_weighted_star", "log_weighted_star"]
    return metrics.select("title", *names).unpivot("title", names, "measure", "star")


def _rows(df: DataFrame, module: str, metrics: dict[str, str]) -> DataFrame:
    """One wide row to (module, metric, value) rows."""
    lines = [
        F.struct(F.lit(module).alias("module"), F.lit(name).alias("metric"), F.col(c).cast("double").alias("value"))
        for name, c in metrics.items()
    ]
    return df.select(F.inline(F.array(*lines)))


def stability_summary(cleaned: DataFrame) -> DataFrame:
    rated = rated_rows(cleaned).select("score", "votes", "short_rate", "long_rate")
    basic = rated.agg(F.count("*").alias("n"), F.avg("score").alias("mean"))
    median = exact_medians(rated, ["score"]).select("median")
    rhos = spearman(
        rated,
        {
            "votes_score_spearman": ("votes", "score"),
            "short_rate_score_spearman": ("short_rate", "score"),
            "short_rate_votes_spearman": ("short_rate", "votes"),
            "long_rate_score_spearman": ("long_rate", "score"),
            "long_rate_votes_spearman": ("long_rate", "votes"),
        },
    )
    return (
        _rows(basic, STABILITY, {"valid_entities": "n", "score_mean": "mean"})
        .unionByName(_rows(median, STABILITY, {"score_median": "median"}))
        .unionByName(rhos.select(F.lit(STABILITY).alias("module"), F.col("pair").alias("metric"), F.col("rho").alias("value")))
    )


def comment_summary(comparison: DataFrame) -> DataFrame:
    row = comparison.agg(
        F.countDistinct("entity_id").alias("entities"), F.avg("sample_minus_score").alias("difference")
    )
    return _rows(row, STABILITY, {"entities_with_comments": "entities", "sample_minus_score_mean": "difference"})


def structure_summary(cleaned: DataFrame, years: tuple[int, int] = STUDY_YEARS, labels: Labels = ZH) -> DataFrame:
    # one row per year of the period: small enough for the plain median
    yearly = cats.yearly_counts(cleaned, years).agg(
        F.sum("n").alias("n"), F.min("n").alias("least"), F.median("n").alias("median")
    )
    effect = cats.in_period(cleaned, years).agg(
        cohens_d(F.col("score"), F.col("origin") == labels.home, F.col("origin") == labels.imported).alias("d")
    )
    return _rows(
        yearly, STRUCTURE, {"period_entities": "n", "yearly_min": "least", "yearly_median": "median"}
    ).unionByName(_rows(effect, STRUCTURE, {"home_import_cohens_d": "d"}))


def quality_summary(candidates: DataFrame, state: DataFrame, labels: Labels = ZH) -> DataFrame:
    names = ("candidates", "unavailable", "unavailable_ratio")
    return _rows(collection_loss(candidates, state, labels), QUALITY, {n: n for n in names})


def analysis_summary(
    cleaned: DataFrame,
    comparison: DataFrame,
    candidates: DataFrame,
    state: DataFrame,
    years: tuple[int, int] = STUDY_YEARS,
    labels: Labels = ZH,
) -> DataFrame:
    """All summary values as (module, metric, value) rows."""
    parts = [
        stability_summary(cleaned),
        comment_summary(comparison),
        structure_summary(cleaned, years, labels),
        quality_summary(candidates, state, labels),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def analysis_tables(
    cleaned: DataFrame,
    metrics: DataFrame,
    links: DataFrame,
    candidates: DataFrame,
    state: DataFrame,
    years: tuple[int, int] = STUDY_YEARS,
    labels: Labels = ZH,
) -> dict[str, DataFrame]:
    """Every result table by name. Absent inputs are empty tables; nothing runs here."""
    quadrants = entity_quadrants(cleaned, labels)
    comparison = metric_comparison(metrics, cleaned)
    period = cats.in_period(cleaned, years)
    weighted = cats.weighted_categories(period.select("entity_id", "year", "categories", "origin"), labels=labels)
    classes = [labels.home, labels.coproduction, labels.special, labels.imported, labels.unknown]
    return {
        "shrinkage": shrinkage_table(cleaned),
        "quadrants": quadrants.select("entity_id", "title", "score", "votes", "quadrant"),
        "quadrant_counts": frequency_table(quadrants, "quadrant"),
        "quadrant_sensitivity": quadrant_sensitivity(cleaned),
        "metric_comparison": comparison,
        "yearly_counts": cats.yearly_counts(cleaned, years),
        "yearly_category_share": cats.yearly_category_share(cleaned, years, labels),
        "yearly_origin_share": cats.yearly_origin_share(cleaned, years),
        "origin_statistics": cats.origin_statistics(cleaned, years),
        "category_origin_table": cats.category_origin_table(weighted, classes, 12),
        "tag_coverage": cats.tag_coverage(links, cleaned, years),
        "summary": analysis_summary(cleaned, comparison, candidates, state, years, labels),
    }
