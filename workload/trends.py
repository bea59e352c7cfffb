"""Category and origin structure over the years, and tag coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.labels import EN
from ratinglens.operators import categories as cats
from ratinglens.operators.ordered import exact_medians, exact_quantiles
from workload.standins import YEARS, entities, stored_entities, table, tag_hits, with_ctes

TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CLASSES = (EN.home, EN.coproduction, EN.special, EN.imported, EN.unknown)


def _weights_of(rows: DataFrame) -> DataFrame:
    return cats.weighted_categories(cats.in_period(rows, YEARS), labels=EN)


def _weighted(spark: SparkSession, d: str) -> DataFrame:
    return _weights_of(entities(spark, d))


def weighted_category_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per (entity, category) with weight 1/n."""
    return _weighted(spark, d).select("entity_id", "year", "origin", "category", F.round("weight", 6).alias("weight"))


WEIGHTED_CATEGORY_ROWS = with_ctes(
    "weighted", body="SELECT entity_id, year, origin, category, round(weight, 6) AS weight FROM weighted"
)


def yearly_counts(spark: SparkSession, d: str) -> DataFrame:
    """Entities per year over a wider period, so empty years appear as zero."""
    return cats.yearly_counts(entities(spark, d), (1990, 2005))


YEARLY_COUNTS = """
SELECT y::INTEGER AS year, coalesce(n, 0) AS n FROM (SELECT unnest(range(1990, 2006)) AS y)
LEFT JOIN (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1) USING (y)"""


def yearly_count_range(spark: SparkSession, d: str) -> DataFrame:
    """Minimum and median yearly count, zero years included."""
    return cats.yearly_counts(entities(spark, d), (1990, 2005)).agg(
        F.min("n").alias("least"), F.median("n").alias("median"), F.sum("n").alias("total")
    )


YEARLY_COUNT_RANGE = f"""SELECT min(n) AS least, median(n) AS median, CAST(sum(n) AS BIGINT) AS total FROM ({YEARLY_COUNTS})"""


def yearly_category_share(spark: SparkSession, d: str) -> DataFrame:
    share = cats.yearly_category_share(stored_entities(spark, d, "entity_id", "year", "categories"), YEARS, EN)
    return share.select("year", "category", F.round("weight", 6).alias("weight"), F.round("share", 6).alias("share"))


SHARE_SQL = """SELECT w.year, category, sum(weight) AS weight, sum(weight) / any_value(n) AS share
            FROM weighted w JOIN (SELECT year, count(*) AS n FROM period GROUP BY 1) t ON t.year = w.year GROUP BY 1, 2"""
YEARLY_CATEGORY_SHARE = with_ctes(
    "weighted", body=f"SELECT year, category, round(weight, 6) AS weight, round(share, 6) AS share FROM ({SHARE_SQL})"
)

_TOP = "SELECT category FROM weighted GROUP BY 1 ORDER BY round(sum(weight), 9) DESC, 1 LIMIT 3"


def top_categories(spark: SparkSession, d: str) -> DataFrame:
    top = cats.top_categories(_weighted(spark, d), 3)
    return top.select("category", F.round("total_weight", 6).alias("total_weight"))


TOP_CATEGORIES = with_ctes(
    "weighted",
    body=f"SELECT category, round(sum(weight), 6) AS total_weight FROM weighted WHERE category IN ({_TOP}) GROUP BY 1",
)


def trend_of_top(spark: SparkSession, d: str) -> DataFrame:
    """Yearly shares of the top categories only."""
    rows = stored_entities(spark, d)
    kept = cats.trend_of_top(cats.yearly_category_share(rows, YEARS, EN), _weights_of(rows), 3)
    return kept.select("year", "category", F.round("share", 6).alias("share"))


TREND_OF_TOP = with_ctes(
    "weighted", body=f"SELECT year, category, round(share, 6) AS share FROM ({SHARE_SQL}) WHERE category IN ({_TOP})"
)


def wide_shares(spark: SparkSession, d: str) -> DataFrame:
    """Year x category table behind the area chart."""
    wide = cats.wide_shares(cats.yearly_category_share(stored_entities(spark, d, "entity_id", "year", "categories"), YEARS, EN), TYPES)
    return wide.select("year", *[F.round(c, 6).alias(c.lower()) for c in TYPES])


WIDE_SHARES = with_ctes(
    "weighted",
    body="SELECT year, "
    + ", ".join(f"round(coalesce(sum(share) FILTER (category = '{c}'), 0), 6) AS {c.lower()}" for c in TYPES)
    + f" FROM ({SHARE_SQL}) GROUP BY 1",
)


def wide_trend(spark: SparkSession, d: str) -> DataFrame:
    """The area chart in one plan: the three heaviest categories, their yearly shares side by side."""
    rows = stored_entities(spark, d, "entity_id", "year", "categories")
    wide = cats.wide_trend(cats.yearly_category_share(rows, YEARS, EN), _weights_of(rows), 3)
    return wide.select("year", *(F.round(f"top_{i}", 6).alias(f"top_{i}") for i in (1, 2, 3)))


WIDE_TREND = with_ctes(
    "weighted",
    body="SELECT year, "
    + ", ".join(f"round(coalesce(sum(share) FILTER (place = {i}), 0), 6) AS top_{i}" for i in (1, 2, 3))
    + f""" FROM ({SHARE_SQL}) JOIN (SELECT category, row_number() OVER (ORDER BY round(sum(weight), 9) DESC, category) AS place
           FROM weighted GROUP BY 1 QUALIFY place <= 3) USING (category) GROUP BY 1""",
)


def yearly_origin_share(spark: SparkSession, d: str) -> DataFrame:
    share = cats.yearly_origin_share(stored_entities(spark, d, "year", "origin"), YEARS)
    return share.select("year", "origin", "n", F.round("share", 6).alias("share"))


YEARLY_ORIGIN_SHARE = with_ctes(
    "period",
    body="""SELECT year, origin, count(*) AS n, round(count(*) / any_value(t), 6) AS share
            FROM period JOIN (SELECT year, count(*) AS t FROM period GROUP BY 1) USING (year) GROUP BY 1, 2""",
)


def origin_statistics(spark: SparkSession, d: str) -> DataFrame:
    stats = cats.origin_statistics(stored_entities(spark, d, "year", "origin", "score", "votes"), YEARS)
    return stats.select(
        "origin", "n", F.round("mean_score", 6).alias("mean_score"), F.round("median_score", 6).alias("median_score"), "median_votes"
    )


ORIGIN_STATISTICS = with_ctes(
    "period",
    body="""SELECT origin, count(*) AS n, round(avg(score), 6) AS mean_score, round(median(score), 6) AS median_score,
                   median(votes) AS median_votes FROM period GROUP BY 1""",
)


def category_origin_table(spark: SparkSession, d: str) -> DataFrame:
    """Category x origin weights, heaviest rows (the heat map)."""
    wide = cats.category_origin_table(_weighted(spark, d), CLASSES, 4)
    return wide.select("category", *[F.round(f"`{c}`", 6).alias(c.replace("-", "_")) for c in CLASSES])


CATEGORY_ORIGIN_TABLE = with_ctes(
    "weighted",
    body="SELECT category, "
    + ", ".join(
        f"round(coalesce(sum(weight) FILTER (origin = '{c}'), 0), 6) AS {c.replace('-', '_')}" for c in CLASSES
    )
    + " FROM weighted GROUP BY 1 ORDER BY round(sum(weight), 9) DESC, 1 LIMIT 4",
)


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    """Part brands of an order's lines as its tags, repeats included."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("tag"))
    return lines.join(parts, "l_partkey").select(
        F.col("l_orderkey").cast("string").alias("entity_id"), "tag", F.col("l_linenumber").alias("rank")
    )


_TAGGED = """SELECT CAST(l_orderkey AS VARCHAR) AS entity_id, p_brand AS tag, l_linenumber AS rank
             FROM lineitem JOIN part ON p_partkey = l_partkey"""
_DATED = f"""SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
             WHERE year(o_orderdate) BETWEEN {YEARS[0]} AND {YEARS[1]}"""


def _dated(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("entity_id"), F.year("o_orderdate").alias("year")
    )


def tag_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Distinct orders per (year, brand)."""
    return cats.tag_coverage(_tagged(spark, d), _dated(spark, d), YEARS)


TAG_COVERAGE = f"""SELECT year, tag, count(DISTINCT entity_id) AS entities
                   FROM ({_TAGGED}) JOIN ({_DATED}) USING (entity_id) GROUP BY 1, 2"""


def tag_rank_spread(spark: SparkSession, d: str) -> DataFrame:
    """Links and quartiles of the rank per tag."""
    hits = tag_hits(spark, d)
    spots = exact_quantiles(hits, "rank", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["tag"])
    return hits.groupBy("tag").agg(F.countDistinct("entity_id").alias("entities")).join(spots, "tag")


TAG_RANK_SPREAD = with_ctes(
    "tag_hits",
    body="""SELECT tag, count(DISTINCT entity_id) AS entities, quantile_cont(rank::DOUBLE, 0.25) AS q25,
                   quantile_cont(rank::DOUBLE, 0.5) AS q50, quantile_cont(rank::DOUBLE, 0.75) AS q75 FROM tag_hits GROUP BY 1""",
)


def tags_per_year(spark: SparkSession, d: str) -> DataFrame:
    """Distinct tags per year."""
    linked = cats.tag_coverage(_tagged(spark, d), _dated(spark, d), YEARS)
    return linked.groupBy("year").agg(F.count("*").alias("tags"))


TAGS_PER_YEAR = f"SELECT year, count(DISTINCT tag) AS tags FROM ({_TAGGED}) JOIN ({_DATED}) USING (entity_id) GROUP BY 1"


def category_medians(spark: SparkSession, d: str) -> DataFrame:
    """Yearly median score and votes per category."""
    rows = _weights_of(stored_entities(spark, d)).where(F.col("score").isNotNull())
    return exact_medians(rows, ["score", "votes"], ["year", "category"]).select(
        "year", "category", "measure", F.round("median", 6).alias("median")
    )


CATEGORY_MEDIANS = with_ctes(
    "weighted",
    body="""SELECT year, category, 'score' AS measure, round(median(score), 6) AS median FROM weighted WHERE score IS NOT NULL GROUP BY 1, 2
            UNION ALL SELECT year, category, 'votes', median(votes) FROM weighted WHERE score IS NOT NULL GROUP BY 1, 2""",
)


def sliding_shares(spark: SparkSession, d: str) -> DataFrame:
    """Share of each category over three neighbouring years."""
    share = cats.sliding_category_share(stored_entities(spark, d, "year", "categories"), YEARS, 1, EN)
    return share.select("year", "category", F.round("share", 6).alias("share"))


SLIDING_SHARES = with_ctes(
    "weighted",
    body=f"""SELECT CAST(y AS INTEGER) AS year, category, round(sum(weight) / any_value(n), 6) AS share
             FROM (SELECT y, count(*) AS n FROM range({YEARS[0]}, {YEARS[1] + 1}) r(y) JOIN period ON abs(period.year - y) <= 1 GROUP BY y)
             JOIN weighted w ON abs(w.year - y) <= 1 GROUP BY y, category""",
)


def grouped_shares(spark: SparkSession, d: str) -> DataFrame:
    """Share of each category per five-year group."""
    share = cats.grouped_category_share(stored_entities(spark, d, "year", "categories"), YEARS, 5, EN)
    return share.select("span", "category", F.round("share", 6).alias("share"))


GROUPED_SHARES = with_ctes(
    "weighted",
    body="""SELECT CAST(w.year // 5 * 5 AS INTEGER) AS span, category, round(sum(weight) / any_value(n), 6) AS share
            FROM weighted w JOIN (SELECT year // 5 AS s, count(*) AS n FROM period GROUP BY 1) t ON t.s = w.year // 5 GROUP BY 1, 2""",
)

QUERIES = {
    "weighted_categories": (weighted_category_rows, WEIGHTED_CATEGORY_ROWS),
    "yearly_counts": (yearly_counts, YEARLY_COUNTS),
    "yearly_count_range": (yearly_count_range, YEARLY_COUNT_RANGE),
    "yearly_category_share": (yearly_category_share, YEARLY_CATEGORY_SHARE),
    "top_categories": (top_categories, TOP_CATEGORIES),
    "trend_of_top": (trend_of_top, TREND_OF_TOP),
    "wide_shares": (wide_shares, WIDE_SHARES),
    "wide_trend": (wide_trend, WIDE_TREND),
    "yearly_origin_share": (yearly_origin_share, YEARLY_ORIGIN_SHARE),
    "origin_statistics": (origin_statistics, ORIGIN_STATISTICS),
    "category_origin_table": (category_origin_table, CATEGORY_ORIGIN_TABLE),
    "tag_coverage": (tag_coverage, TAG_COVERAGE),
    "tag_rank_spread": (tag_rank_spread, TAG_RANK_SPREAD),
    "tags_per_year": (tags_per_year, TAGS_PER_YEAR),
    "category_medians": (category_medians, CATEGORY_MEDIANS),
    "sliding_shares": (sliding_shares, SLIDING_SHARES),
    "grouped_shares": (grouped_shares, GROUPED_SHARES),
}
