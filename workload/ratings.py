"""Rating statistics: distribution, shrinkage, quadrants, comment measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.functions.rating import log_votes, shrunk_score, wilson_bounds
from ratinglens.labels import EN
from ratinglens.operators.ordered import average_ranks, exact_medians, exact_quantiles, value_counts
from ratinglens.operators.quadrants import entity_quadrants, quadrant_sensitivity, rated_rows
from ratinglens.operators.stats import cohens_d, frequency_table, spearman, star_metrics
from ratinglens.plans.analysis import comment_summary, measures_long, metric_comparison, shrinkage_table
from ratinglens.plans.cleaning import clean_comments
from workload.standins import COMMENT_ORDER, PLAIN_COLUMNS, comments_raw, entities, stored_entities, table, with_ctes


def _rated(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return rated_rows(stored_entities(spark, d, *(columns or PLAIN_COLUMNS)))


def _shrunk(spark: SparkSession, d: str) -> DataFrame:
    rated = _rated(spark, d)
    mean = rated.agg(F.avg("score").alias("c")).scalar()
    votes = exact_quantiles(rated, "votes", {"m": 0.5}).scalar()
    return rated.withColumn("shrunk_score", shrunk_score(F.col("score"), F.col("votes"), mean, votes))


def shrunk_scores(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: scores pulled towards the mean by vote count, largest drop first."""
    table_ = shrinkage_table(_shrunk(spark, d))
    return table_.withColumns({c: F.round(c, 6) for c in ("shrunk_score", "difference")})


SHRUNK_SCORES = with_ctes(
    "rated",
    body="""SELECT entity_id, title, score, votes, round(s, 6) AS shrunk_score, round(score - s, 6) AS difference
            FROM (SELECT *, votes / (votes + m) * score + m / (votes + m) * c AS s
                  FROM rated, (SELECT avg(score) AS c, median(votes) AS m FROM rated))
            ORDER BY score - s DESC, entity_id""",
)


def rating_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Size, mean, median and quantiles of the score."""
    rated = _rated(spark, d)
    basic = rated.agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean"))
    spots = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}
    cuts = exact_quantiles(rated, "score", spots).select(F.struct(*[F.round(c, 6).alias(c) for c in spots]).alias("q"))
    return basic.withColumn("q", cuts.scalar()).select("n", "mean", "q.*")


RATING_DISTRIBUTION = with_ctes(
    "rated",
    body="""SELECT count(*) AS n, round(avg(score), 6) AS mean, round(quantile_cont(score, 0.05), 6) AS p05,
            round(quantile_cont(score, 0.25), 6) AS p25, round(quantile_cont(score, 0.5), 6) AS median,
            round(quantile_cont(score, 0.75), 6) AS p75, round(quantile_cont(score, 0.95), 6) AS p95 FROM rated""",
)


def vote_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return exact_quantiles(_rated(spark, d), "votes", {"q25": 0.25, "q50": 0.5, "q75": 0.75})


VOTE_QUANTILES = with_ctes(
    "rated",
    body="""SELECT quantile_cont(votes::DOUBLE, 0.25) AS q25, quantile_cont(votes::DOUBLE, 0.5) AS q50,
                   quantile_cont(votes::DOUBLE, 0.75) AS q75 FROM rated""",
)


def prior_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Overall mean and median votes behind the shrinkage."""
    rated = _rated(spark, d)
    mean = rated.agg(F.round(F.avg("score"), 6).alias("prior_mean"))
    return mean.withColumn("prior_votes", exact_quantiles(rated, "votes", {"m": 0.5}).scalar())


PRIOR_SCALARS = with_ctes("rated", body="SELECT round(avg(score), 6) AS prior_mean, median(votes) AS prior_votes FROM rated")


def average_rank_table(spark: SparkSession, d: str) -> DataFrame:
    """Shared ranks of the line prices."""
    counts = value_counts(table(spark, d, "lineitem"), "l_extendedprice")
    return average_ranks(counts, "l_extendedprice").select("l_extendedprice", "rank")


AVERAGE_RANK_TABLE = """
SELECT l_extendedprice, r + (n - 1) / 2 AS rank FROM (
  SELECT l_extendedprice, n, sum(n) OVER (ORDER BY l_extendedprice) - n + 1 AS r
  FROM (SELECT l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1))"""

_PAIRS = {
    "votes_score": ("votes", "score"),
    "short_rate_score": ("short_rate", "score"),
    "short_rate_votes": ("short_rate", "votes"),
    "long_rate_score": ("long_rate", "score"),
    "long_rate_votes": ("long_rate", "votes"),
}


def spearman_table(spark: SparkSession, d: str) -> DataFrame:
    return spearman(_rated(spark, d), _PAIRS).select("pair", "n", F.round("rho", 6).alias("rho"))


SPEARMAN_TABLE = with_ctes(
    "rated",
    body=" UNION ALL ".join(
        f"""SELECT '{name}' AS pair, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM (
              SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2 AS rx,
                     rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2 AS ry
              FROM rated WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"""
        for name, (x, y) in _PAIRS.items()
    ),
)


def effect_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Home against import: score and log votes."""
    home, imported = F.col("origin") == EN.home, F.col("origin") == EN.imported
    return _rated(spark, d, "origin", "score", "votes").agg(
        F.round(cohens_d(F.col("score"), home, imported), 6).alias("score_d"),
        F.round(cohens_d(log_votes(F.col("votes")), home, imported), 6).alias("votes_d"),
    )


def _d_sql(value: str) -> str:
    a, b = f"{value} END) FILTER (origin = 'domestic')", f"{value} END) FILTER (origin = 'import')"
    pick = "CASE WHEN true THEN "
    n1, n2 = "count(*) FILTER (origin = 'domestic')", "count(*) FILTER (origin = 'import')"
    var = f"(({n1} - 1) * var_samp({pick}{a} + ({n2} - 1) * var_samp({pick}{b}) / ({n1} + {n2} - 2)"
    return f"round((avg({pick}{a} - avg({pick}{b}) / sqrt({var}), 6)"


EFFECT_SIZES = with_ctes(
    "rated", body=f"SELECT {_d_sql('score')} AS score_d, {_d_sql('log10(votes + 1)')} AS votes_d FROM rated"
)


def entity_quadrant_table(spark: SparkSession, d: str) -> DataFrame:
    return entity_quadrants(stored_entities(spark, d, "entity_id", "score", "votes"), EN).select("entity_id", "score", "votes", "quadrant")


QUADRANT_SQL = """SELECT entity_id, score, votes, CASE WHEN score >= s THEN 'high' ELSE 'low' END || '-' ||
    CASE WHEN votes >= v THEN 'mass' ELSE 'niche' END AS quadrant
    FROM rated, (SELECT median(score) AS s, median(votes) AS v FROM rated)"""
ENTITY_QUADRANT_TABLE = with_ctes("rated", body=QUADRANT_SQL)


def quadrant_counts(spark: SparkSession, d: str) -> DataFrame:
    return frequency_table(entity_quadrants(stored_entities(spark, d, "entity_id", "score", "votes"), EN), "quadrant")


QUADRANT_COUNTS = with_ctes("rated", body=f"SELECT quadrant, count(*) AS n FROM ({QUADRANT_SQL}) GROUP BY 1 ORDER BY 2 DESC, 1")

_SCORES, _QUANTILES = (4.5, 5.0, 5.5), (0.25, 0.5, 0.75)


def quadrant_sensitivity_table(spark: SparkSession, d: str) -> DataFrame:
    return quadrant_sensitivity(stored_entities(spark, d, "score", "votes"), _SCORES, _QUANTILES)


QUADRANT_SENSITIVITY_TABLE = with_ctes(
    "rated",
    body=" UNION ALL ".join(
        f"""SELECT {s}::DOUBLE AS score_threshold, {q}::DOUBLE AS vote_quantile, max(t) AS vote_threshold,
            count(*) FILTER (score >= {s} AND votes < t) AS high_niche, count(*) FILTER (score >= {s} AND votes >= t) AS high_mass
            FROM rated, (SELECT quantile_cont(votes::DOUBLE, {q}) AS t FROM rated)"""
        for s in _SCORES
        for q in _QUANTILES
    ),
)


def log_vote_table(spark: SparkSession, d: str) -> DataFrame:
    return _rated(spark, d).select("entity_id", F.round(log_votes(F.col("votes")), 6).alias("log_votes"))


LOG_VOTE_TABLE = with_ctes("rated", body="SELECT entity_id, round(log10(votes + 1), 6) AS log_votes FROM rated")


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return star_metrics(clean_comments(comments_raw(spark, d), COMMENT_ORDER))


_MEASURES = (
    "mean_star", "useful_weighted_star", "log_weighted_star",
    "five_star_share", "five_star_low", "five_star_high", "star_entropy",
)


def comment_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Star measures per (entity, title, label)."""
    return _metrics(spark, d).withColumns({c: F.round(c, 6) + F.lit(0.0) for c in _MEASURES})


COMMENT_METRICS = with_ctes(
    "comment_metrics",
    body="SELECT entity_id, title, sample_label, CAST(rated AS BIGINT) AS rated, "
    + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _MEASURES)
    + " FROM comment_metrics",
)


def comment_metrics_by_label(spark: SparkSession, d: str) -> DataFrame:
    """The same measures over three very large groups."""
    cleaned = clean_comments(comments_raw(spark, d), COMMENT_ORDER)
    return star_metrics(cleaned, keys=["sample_label"]).withColumns({c: F.round(c, 6) + F.lit(0.0) for c in _MEASURES})


COMMENT_METRICS_BY_LABEL = with_ctes(
    "comments_clean",
    body="""SELECT sample_label, CAST(n AS BIGINT) AS rated, round(m, 6) AS mean_star, round(su / u, 6) AS useful_weighted_star,
              round(sh / h, 6) AS log_weighted_star, round(p, 6) AS five_star_share,
              round((p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS five_star_low,
              round((p + 3.8416 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS five_star_high,
              round(e, 6) + 0.0 AS star_entropy
            FROM (SELECT sample_label, count(*)::DOUBLE AS n, avg(star_value) AS m, sum(star_value * useful)::DOUBLE AS su,
                     sum(useful)::DOUBLE AS u, sum(star_value * (1 + ln(1 + useful))) AS sh, sum(1 + ln(1 + useful)) AS h,
                     count(*) FILTER (star_value = 5)::DOUBLE / count(*) AS p, entropy(star_value) AS e
                  FROM comments_clean WHERE star_value IS NOT NULL GROUP BY 1)""",
)


def metric_comparison_table(spark: SparkSession, d: str) -> DataFrame:
    """Comment means on the ten-point scale next to the overall score."""
    compared = metric_comparison(_metrics(spark, d), entities(spark, d))
    return compared.select(
        "entity_id", "sample_label", "score", *[F.round(c, 6).alias(c) for c in ("sample_ten", "sample_minus_score")]
    )


METRIC_COMPARISON_TABLE = with_ctes(
    "comment_metrics",
    "entities",
    body="""SELECT entity_id, sample_label, score, round(mean_star * 2, 6) AS sample_ten,
                   round(mean_star * 2 - score, 6) AS sample_minus_score
            FROM comment_metrics LEFT JOIN (SELECT entity_id, score FROM entities) USING (entity_id)""",
)


def comment_score_gap(spark: SparkSession, d: str) -> DataFrame:
    """Entities with comment ratings, and the mean gap to the overall score."""
    rows = comment_summary(metric_comparison(_metrics(spark, d), entities(spark, d)))
    return rows.select("module", "metric", F.round("value", 6).alias("value"))


COMMENT_SCORE_GAP = with_ctes(
    "comment_metrics",
    "entities",
    body="""SELECT 'A' AS module, unnest(['entities_with_comments', 'sample_minus_score_mean']) AS metric,
                   unnest([count(DISTINCT entity_id)::DOUBLE, round(avg(mean_star * 2 - score), 6)]) AS value
            FROM comment_metrics LEFT JOIN (SELECT entity_id, score FROM entities) USING (entity_id)""",
)


def measures_long_table(spark: SparkSession, d: str) -> DataFrame:
    """Three star measures, wide to long."""
    return measures_long(_metrics(spark, d)).select("title", "measure", F.round("star", 6).alias("star"))


MEASURES_LONG_TABLE = with_ctes(
    "comment_metrics",
    body=" UNION ALL ".join(
        f"SELECT title, '{m}' AS measure, round({m}, 6) AS star FROM comment_metrics" for m in _MEASURES[:3]
    ),
)


def return_share_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Interval of the share of returned lines per supplier."""
    counts = table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("k")
    )
    low, high = wilson_bounds(F.col("k"), F.col("n"))
    return counts.select("l_suppkey", "n", "k", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


RETURN_SHARE_BOUNDS = """
SELECT l_suppkey, n::BIGINT AS n, k, round((p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS low,
       round((p + 3.8416 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS high
FROM (SELECT l_suppkey, count(*)::DOUBLE AS n, count(*) FILTER (l_returnflag = 'R') AS k,
             count(*) FILTER (l_returnflag = 'R') / count(*) AS p FROM lineitem GROUP BY 1)"""


def score_spread_by_votes(spark: SparkSession, d: str) -> DataFrame:
    """Variance of the score in vote groups bounded by the quartiles."""
    rated = _rated(spark, d)
    cuts = exact_quantiles(rated, "votes", {"a": 0.25, "b": 0.5, "c": 0.75}).select(F.struct("a", "b", "c").alias("q"))
    cut = rated.select("score", "votes", cuts.scalar().alias("q"))
    group = sum([(F.col("votes") > F.col(f"q.{c}")).cast("int") for c in "abc"], F.lit(1))
    return cut.groupBy(group.alias("vote_group")).agg(
        F.count("*").alias("n"), F.round(F.var_samp("score"), 6).alias("score_variance")
    )


SCORE_SPREAD_BY_VOTES = with_ctes(
    "rated",
    body="""SELECT CAST(1 + CAST(votes > a AS INTEGER) + CAST(votes > b AS INTEGER) + CAST(votes > c AS INTEGER) AS INTEGER) AS vote_group,
                   count(*) AS n, round(var_samp(score), 6) AS score_variance
            FROM rated, (SELECT quantile_cont(votes::DOUBLE, 0.25) AS a, quantile_cont(votes::DOUBLE, 0.5) AS b,
                                quantile_cont(votes::DOUBLE, 0.75) AS c FROM rated) GROUP BY 1""",
)


def medians_by_supplier(spark: SparkSession, d: str) -> DataFrame:
    """Exact medians of two measures per supplier."""
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice")
    return exact_medians(lines, ["l_quantity", "l_extendedprice"], ["l_suppkey"]).select(
        "l_suppkey", "measure", F.round("median", 6).alias("median")
    )


MEDIANS_BY_SUPPLIER = """
SELECT l_suppkey, 'l_quantity' AS measure, round(median(l_quantity), 6) AS median FROM lineitem GROUP BY 1
UNION ALL SELECT l_suppkey, 'l_extendedprice', round(median(l_extendedprice), 6) FROM lineitem GROUP BY 1"""

QUERIES = {
    "shrunk_scores": (shrunk_scores, SHRUNK_SCORES),
    "rating_distribution": (rating_distribution, RATING_DISTRIBUTION),
    "vote_quantiles": (vote_quantiles, VOTE_QUANTILES),
    "prior_scalars": (prior_scalars, PRIOR_SCALARS),
    "average_ranks": (average_rank_table, AVERAGE_RANK_TABLE),
    "spearman": (spearman_table, SPEARMAN_TABLE),
    "effect_sizes": (effect_sizes, EFFECT_SIZES),
    "entity_quadrants": (entity_quadrant_table, ENTITY_QUADRANT_TABLE),
    "quadrant_counts": (quadrant_counts, QUADRANT_COUNTS),
    "quadrant_sensitivity": (quadrant_sensitivity_table, QUADRANT_SENSITIVITY_TABLE),
    "log_votes": (log_vote_table, LOG_VOTE_TABLE),
    "comment_metrics": (comment_metrics, COMMENT_METRICS),
    "comment_metrics_by_label": (comment_metrics_by_label, COMMENT_METRICS_BY_LABEL),
    "metric_comparison": (metric_comparison_table, METRIC_COMPARISON_TABLE),
    "comment_score_gap": (comment_score_gap, COMMENT_SCORE_GAP),
    "measures_long": (measures_long_table, MEASURES_LONG_TABLE),
    "return_share_bounds": (return_share_bounds, RETURN_SHARE_BOUNDS),
    "score_spread_by_votes": (score_spread_by_votes, SCORE_SPREAD_BY_VOTES),
    "medians_by_supplier": (medians_by_supplier, MEDIANS_BY_SUPPLIER),
}
