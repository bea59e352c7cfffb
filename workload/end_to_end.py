"""Raw entity rows through cleaning into result tables, in one plan: emptied scores and unknown parts reach the results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.labels import EN
from ratinglens.operators import categories as cats
from ratinglens.operators.quadrants import entity_quadrants
from ratinglens.plans.cleaning import clean_entities
from workload.ratings import QUADRANT_SQL
from workload.standins import CTE, RULES, YEARS, entities_raw, with_ctes
from workload.trends import SHARE_SQL


def _cleaned(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return clean_entities(entities_raw(spark, d), RULES, columns=columns).cleaned


def _on_cleaned(*names: str, body: str) -> str:
    """SQL in which the named stand-ins are made of the cleaned rows in place of the clean entities."""
    later = "".join(f",\n{n} AS ({CTE[n]})" for n in names)
    return with_ctes("entities_marked", body="").rstrip() + ",\nentities AS (SELECT * FROM entities_marked)" + later + "\n" + body


def cleaned_quadrants(spark: SparkSession, d: str) -> DataFrame:
    return entity_quadrants(_cleaned(spark, d, "score", "votes"), EN).select("entity_id", "score", "votes", "quadrant")


CLEANED_QUADRANTS = _on_cleaned("rated", body=QUADRANT_SQL)


def cleaned_category_share(spark: SparkSession, d: str) -> DataFrame:
    share = cats.yearly_category_share(_cleaned(spark, d, "year", "categories"), YEARS, EN)
    return share.select("year", "category", F.round("weight", 6).alias("weight"), F.round("share", 6).alias("share"))


CLEANED_CATEGORY_SHARE = _on_cleaned(
    "period", "weighted", body=f"SELECT year, category, round(weight, 6) AS weight, round(share, 6) AS share FROM ({SHARE_SQL})"
)


def cleaned_origin_statistics(spark: SparkSession, d: str) -> DataFrame:
    stats = cats.origin_statistics(_cleaned(spark, d, "year", "origin", "score", "votes"), YEARS)
    return stats.select(
        "origin", "n", F.round("mean_score", 6).alias("mean_score"), F.round("median_score", 6).alias("median_score"), "median_votes"
    )


CLEANED_ORIGIN_STATISTICS = _on_cleaned(
    "period",
    body="""SELECT origin, count(*) AS n, round(avg(score), 6) AS mean_score, round(median(score), 6) AS median_score,
                   median(votes) AS median_votes FROM period GROUP BY 1""",
)

QUERIES = {
    "cleaned_quadrants": (cleaned_quadrants, CLEANED_QUADRANTS),
    "cleaned_category_share": (cleaned_category_share, CLEANED_CATEGORY_SHARE),
    "cleaned_origin_statistics": (cleaned_origin_statistics, CLEANED_ORIGIN_STATISTICS),
}
