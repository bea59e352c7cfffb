"""Two-threshold classification and its sensitivity to the thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratinglens.functions.rating import quadrant
from ratinglens.labels import ZH, Labels
from ratinglens.operators.ordered import exact_medians, exact_quantiles


def rated_rows(entities: DataFrame) -> DataFrame:
    return entities.na.drop(subset=["score", "votes"])


def median_cuts(rated: DataFrame) -> Column:
    """Scalar struct (score, votes) of the sample medians."""
    medians = exact_medians(rated, ["score", "votes"])
    return medians.agg(
        F.struct(
            F.max(F.when(F.col("measure") == "score", F.col("median"))).alias("score"),
            F.max(F.when(F.col("measure") == "votes", F.col("median"))).alias("votes"),
        ).alias("cuts")
    ).scalar()


def entity_quadrants(entities: DataFrame, labels: Labels = ZH) -> DataFrame:
    rated = rated_rows(entities)
    cut = rated.withColumn("_cuts", median_cuts(rated))
    label = quadrant(F.col("score"), F.col("votes"), F.col("_cuts.score"), F.col("_cuts.votes"), labels)
    return cut.withColumn("quadrant", label).drop("_cuts")


def quadrant_sensitivity(
    entities: DataFrame,
    scores: Sequence[float] = (7.5, 8.0, 8.5),
    vote_quantiles: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """Niche and mass counts at every pair of thresholds, in one pass over the rows."""
    rated = rated_rows(entities)
    names = [f"q{i}" for i in range(len(vote_quantiles))]
    thresholds = exact_quantiles(rated, "votes", dict(zip(names, vote_quantiles, strict=True)))
    cuts = thresholds.select(F.array(*names).alias("cuts")).scalar()
    pairs = [(s, i) for s in scores for i in range(len(vote_quantiles))]
    cut = rated.select("score", "votes", cuts.alias("_cuts"))
    high = [F.col("score") >= s for s, _ in pairs]
    niche = [F.col("votes") < F.col("_cuts")[i] for _, i in pairs]
    one_row = cut.agg(
        F.max("_cuts").alias("_cuts"),
        *[F.count_if(h & m).alias(f"n{k}") for k, (h, m) in enumerate(zip(high, niche, strict=True))],
        *[F.count_if(h & ~m).alias(f"m{k}") for k, (h, m) in enumerate(zip(high, niche, strict=True))],
    )
    lines = [
        F.struct(
            F.lit(float(s)).alias("score_threshold"),
            F.lit(float(vote_quantiles[i])).alias("vote_quantile"),
            F.col("_cuts")[i].alias("vote_threshold"),
            F.col(f"n{k}").alias("high_niche"),
            F.col(f"m{k}").alias("high_mass"),
        )
        for k, (s, i) in enumerate(pairs)
    ]
    return one_row.select(F.inline(F.array(*lines)))
