"""The aggregates behind the figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.functions.rating import log_votes
from ratinglens.operators import charts
from ratinglens.operators.categories import in_period
from ratinglens.operators.quadrants import median_cuts, rated_rows
from ratinglens.operators.stats import star_metrics
from ratinglens.plans.analysis import measures_long, shrinkage_table
from ratinglens.plans.cleaning import clean_comments
from workload.ratings import _shrunk
from workload.standins import COMMENT_ORDER, YEARS, comments_raw, stored_entities, table, with_ctes


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names})


def price_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Line prices in twenty equal bins."""
    return _rounded(charts.histogram(table(spark, d, "lineitem"), "l_extendedprice"), "low", "high")


PRICE_HISTOGRAM = """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
     b AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 20)) AS INTEGER), 19) AS bin FROM lineitem, r)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / 20), 6) AS low, round(lo + (i + 1) * ((hi - lo) / 20), 6) AS high,
       (SELECT count(*) FROM b WHERE b.bin = i) AS n
FROM r, (SELECT unnest(range(20)) AS i)"""


def score_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Scores in twenty equal bins; edges decide, the last bin is closed."""
    return _rounded(charts.histogram(rated_rows(stored_entities(spark, d, "score", "votes")), "score"), "low", "high")


SCORE_HISTOGRAM = with_ctes(
    "rated",
    body="""SELECT CAST(i AS INTEGER) AS bin, round(any_value(e0), 6) AS low, round(any_value(e1), 6) AS high, count(score) AS n
            FROM (SELECT i, lo + i * ((hi - lo) / 20) AS e0, lo + (i + 1) * ((hi - lo) / 20) AS e1
                  FROM (SELECT min(score) AS lo, max(score) AS hi FROM rated), (SELECT unnest(range(20)) AS i))
            LEFT JOIN rated ON score >= e0 AND (score < e1 OR i = 19) GROUP BY i""",
)


def score_density(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(charts.density(rated_rows(stored_entities(spark, d, "score", "votes")), "score"), "x", "density")


SCORE_DENSITY = with_ctes(
    "rated",
    body="""SELECT CAST(p AS INTEGER) AS point, round(any_value(lo + p * (hi - lo) / 199), 6) AS x,
                   round(sum(k * exp(0 - pow((lo + p * (hi - lo) / 199 - score) / h, 2) / 2) / (n * h * sqrt(2 * pi()))), 6) AS density
            FROM (SELECT score, count(*) AS k FROM rated GROUP BY 1),
                 (SELECT min(score) AS lo, max(score) AS hi, count(*) AS n, stddev_samp(score) * count(*) ** (-0.2) AS h FROM rated),
                 (SELECT unnest(range(200)) AS p) GROUP BY p""",
)


def price_density(spark: SparkSession, d: str) -> DataFrame:
    """Density of the line price, a value with more different ones than the grid has steps."""
    found = charts.density(table(spark, d, "lineitem").select(F.col("l_extendedprice").cast("double").alias("price")), "price", 50, 512)
    return found.select("point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("per_million"))


PRICE_DENSITY = """
WITH v AS (SELECT CAST(l_extendedprice AS DOUBLE) AS p FROM lineitem),
m AS (SELECT min(p) AS lo, max(p) AS hi, count(*) AS n, stddev_samp(p) * count(*) ** (-0.2) AS h, (max(p) - min(p)) / 512 AS step FROM v),
split AS (SELECT least(floor((p - lo) / step), 511) AS i, (p - lo) / step AS place FROM v, m),
grid AS (SELECT i, sum(w) AS w FROM (SELECT i, 1 - (place - i) AS w FROM split UNION ALL SELECT i + 1, place - i FROM split) GROUP BY i)
SELECT CAST(k AS INTEGER) AS point, round(any_value(lo + k * (hi - lo) / 49), 4) AS x,
       round(1e6 * sum(w * exp(0 - pow((lo + k * (hi - lo) / 49 - (lo + i * step)) / h, 2) / 2) / (n * h * sqrt(2 * pi()))), 6) AS per_million
FROM grid, m, (SELECT unnest(range(50)) AS k) GROUP BY k"""


def votes_score_bins(spark: SparkSession, d: str) -> DataFrame:
    """Log votes against score as counts per cell."""
    rated = rated_rows(stored_entities(spark, d, "score", "votes")).select("score", F.round(log_votes(F.col("votes")), 6).alias("log_votes"))
    return charts.binned_pairs(rated, "log_votes", "score", 16, 10)


_CELL = """least(CAST(floor(({v} - {lo}) / (({hi} - {lo}) / {n})) AS INTEGER), {n} - 1)"""


def _cell(v: str, lo: str, hi: str, n: int) -> str:
    guess = _CELL.format(v=v, lo=lo, hi=hi, n=n)
    step = f"(({hi} - {lo}) / {n})"
    return f"""CAST(CASE WHEN {v} < {lo} + {guess} * {step} THEN {guess} - 1
        WHEN {guess} < {n - 1} AND {v} >= {lo} + ({guess} + 1) * {step} THEN {guess} + 1 ELSE {guess} END AS INTEGER)"""


VOTES_SCORE_BINS = with_ctes(
    "rated",
    body=f"""SELECT {_cell('x', 'x0', 'x1', 16)} AS x_bin, {_cell('score', 'y0', 'y1', 10)} AS y_bin, count(*) AS n
            FROM (SELECT score, round(log10(votes + 1), 6) AS x FROM rated),
                 (SELECT min(round(log10(votes + 1), 6)) AS x0, max(round(log10(votes + 1), 6)) AS x1, min(score) AS y0, max(score) AS y1 FROM rated)
            GROUP BY 1, 2""",
)


def votes_shrinkage_bins(spark: SparkSession, d: str) -> DataFrame:
    """Votes against the shrinkage difference, to six digits."""
    rows = shrinkage_table(_shrunk(spark, d)).select("votes", F.round("difference", 6).alias("difference"))
    return charts.binned_pairs(rows, "votes", "difference", 12, 12)


VOTES_SHRINKAGE_BINS = with_ctes(
    "rated",
    body=f"""SELECT {_cell('x', 'x0', 'x1', 12)} AS x_bin, {_cell('y', 'y0', 'y1', 12)} AS y_bin, count(*) AS n
            FROM (SELECT x, y, min(x) OVER () AS x0, max(x) OVER () AS x1, min(y) OVER () AS y0, max(y) OVER () AS y1
                  FROM (SELECT votes::DOUBLE AS x, round(score - (votes / (votes + m) * score + m / (votes + m) * c), 6) AS y
                        FROM rated, (SELECT avg(score) AS c, median(votes) AS m FROM rated)))
            GROUP BY 1, 2""",
)


def quadrant_lines(spark: SparkSession, d: str) -> DataFrame:
    """Cut lines of the quadrant chart."""
    cuts = spark.range(1).select(median_cuts(rated_rows(stored_entities(spark, d, "score", "votes"))).alias("c"))
    return cuts.select(
        F.round("c.score", 6).alias("score_cut"), F.round(log_votes(F.col("c.votes")), 6).alias("log_vote_cut")
    )


QUADRANT_LINES = with_ctes(
    "rated", body="SELECT round(median(score), 6) AS score_cut, round(log10(median(votes) + 1), 6) AS log_vote_cut FROM rated"
)

_BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


def _box_sql(source: str, value: str, by: str) -> str:
    return f"""SELECT {by}, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
        round(min({value}) FILTER ({value} >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
        round(max({value}) FILTER ({value} <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high, count(*) AS n,
        count(*) FILTER ({value} < q1 - 1.5 * (q3 - q1) OR {value} > q3 + 1.5 * (q3 - q1)) AS outliers
        FROM {source} JOIN (SELECT {by}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS q2,
                                   quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY {by}) USING ({by}) GROUP BY {by}"""


def star_measure_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Box plot numbers of the three star measures."""
    metrics = star_metrics(clean_comments(comments_raw(spark, d), COMMENT_ORDER))
    rows = measures_long(metrics).withColumn("star", F.round("star", 6))
    return _rounded(charts.box_stats(rows, "star", ["measure"]), *_BOX)


STAR_MEASURE_BOXES = with_ctes(
    "comment_metrics",
    body=_box_sql(
        "("
        + " UNION ALL ".join(
            f"SELECT '{m}' AS measure, round({m}, 6) AS star FROM comment_metrics"
            for m in ("mean_star", "useful_weighted_star", "log_weighted_star")
        )
        + ")",
        "star",
        "measure",
    ),
)


def score_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Scores by origin class."""
    period = in_period(stored_entities(spark, d), YEARS)
    return _rounded(charts.box_stats(period, "score", ["origin"]), *_BOX)


SCORE_BOXES = with_ctes("period", body=_box_sql("(SELECT origin, score FROM period WHERE score IS NOT NULL)", "score", "origin"))


def vote_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Log votes by origin class."""
    period = in_period(stored_entities(spark, d, "year", "origin", "votes"), YEARS).select("origin", F.round(log_votes(F.col("votes")), 6).alias("log_votes"))
    return _rounded(charts.box_stats(period, "log_votes", ["origin"]), *_BOX)


VOTE_BOXES = with_ctes(
    "period",
    body=_box_sql(
        "(SELECT origin, round(log10(votes + 1), 6) AS log_votes FROM period WHERE votes IS NOT NULL)", "log_votes", "origin"
    ),
)

QUERIES = {
    "price_histogram": (price_histogram, PRICE_HISTOGRAM),
    "score_histogram": (score_histogram, SCORE_HISTOGRAM),
    "score_density": (score_density, SCORE_DENSITY),
    "price_density": (price_density, PRICE_DENSITY),
    "votes_score_bins": (votes_score_bins, VOTES_SCORE_BINS),
    "votes_shrinkage_bins": (votes_shrinkage_bins, VOTES_SHRINKAGE_BINS),
    "quadrant_lines": (quadrant_lines, QUADRANT_LINES),
    "star_measure_boxes": (star_measure_boxes, STAR_MEASURE_BOXES),
    "score_boxes": (score_boxes, SCORE_BOXES),
    "vote_boxes": (vote_boxes, VOTE_BOXES),
}
