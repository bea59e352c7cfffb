"""The aggregates behind the figures: every result is as small as its picture."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratinglens.operators.ordered import quantiles_of_counts, value_counts


def _range_of(counts: DataFrame, value: str) -> Column:
    return counts.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("r")).scalar()


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin; edges decide, and the last bin holds the maximum."""
    step = (high - low) / bins
    guess = F.when(step > 0, F.floor((value - low) / step)).otherwise(0)
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(bins - 1))
    return (
        F.when(value < low + guess * step, guess - 1)
        .when((guess < bins - 1) & (value >= low + (guess + 1) * step), guess + 1)
        .otherwise(guess)
        .cast("int")
    )


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """(bin, low, high, n) over [min, max] in equal widths, empty bins included."""
    counts = value_counts(df.select(F.col(value).cast("double").alias("value")), "value")
    ends = _range_of(counts, "value")
    binned = (
        counts.withColumn("_r", ends)
        .select(_bin(F.col("value"), F.col("_r.low"), F.col("_r.high"), bins).alias("bin"), "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    spine = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), ends.alias("_r")
    )
    step = (F.col("_r.high") - F.col("_r.low")) / bins
    return spine.join(binned, "bin", "left").select(
        "bin",
        (F.col("_r.low") + F.col("bin") * step).alias("low"),
        (F.col("_r.low") + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


#: Steps of the grid that stands for the values of a density, when there are more different ones.
GRID = 4096


def density(df: DataFrame, value: str, points: int = 200, grid: int = GRID) -> DataFrame:
    """(point, x, density): Gaussian kernel density with Scott's bandwidth h on [min, max].

    Equal values are merged first. If more than ``grid`` different ones are left, each gives its weight to the two grid
    steps around it, in proportion to its nearness; the kernel is then summed over the steps. The work after
    the merge is at most ``grid`` times ``points``, however many rows there are. Without the grid the sum is exact; with it
    each density is off by at most d^2 / (8 h^3 sqrt(2 pi)), d being the grid's step.
    """
    counts = value_counts(df.select(F.col(value).cast("double").alias("value")), "value")
    n, v = F.col("n").cast("double"), F.col("value")
    total = F.sum(n)
    mean = F.sum(n * v) / total
    moments = counts.agg(
        F.struct(
            F.min(v).alias("low"), F.max(v).alias("high"), total.alias("total"), mean.alias("mean"), F.count("*").alias("different")
        ).alias("m")
    ).scalar()
    spread = (
        counts.withColumn("_m", moments)
        .agg(F.sum(n * (v - F.col("_m.mean")) * (v - F.col("_m.mean"))).alias("ss"))
        .scalar()
    )
    step = (F.col("m.high") - F.col("m.low")) / grid
    place = F.try_divide(v - F.col("m.low"), step)
    left = F.least(F.floor(place), F.lit(grid - 1))
    few = F.col("m.different") <= grid
    spot = F.when(few, v).otherwise(left.cast("double"))
    right_share = F.when(few, 0.0).otherwise(place - left)
    cells = (
        counts.withColumn("m", moments)
        .select(few.alias("few"), spot.alias("spot"), (n * (1 - right_share)).alias("own"), (n * right_share).alias("next"), "m")
        .groupBy("few", "spot", "m")
        .agg(F.sum("own").alias("own"), F.sum("next").alias("next"))
    )
    at = F.when(F.col("few"), F.col("spot")).otherwise(F.col("m.low") + F.col("spot") * step)
    weights = cells.select(
        "m", F.inline(F.array(F.struct(at.alias("at"), F.col("own").alias("w")), F.struct((at + step).alias("at"), F.col("next").alias("w"))))
    ).where("w > 0")
    h = F.sqrt(F.try_divide(F.col("ss"), F.col("m.total") - 1)) * F.pow(F.col("m.total"), F.lit(-0.2))
    spots = weights.withColumn("ss", spread).withColumn("h", h).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("m.low") + F.col("point") * (F.col("m.high") - F.col("m.low")) / (points - 1)
    z = (x - F.col("at")) / F.col("h")
    share = F.col("w") * F.exp(-z * z / 2) / (F.col("m.total") * F.col("h") * math.sqrt(2 * math.pi))
    return spots.where(F.col("h") > 0).groupBy("point").agg(F.first(x).alias("x"), F.sum(share).alias("density"))


def binned_pairs(df: DataFrame, x: str, y: str, x_bins: int = 40, y_bins: int = 40) -> DataFrame:
    """(x_bin, y_bin, n): the counts of a scatter plot."""
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    ends = points.agg(
        F.struct(*[f(c).alias(f"{c}{n}") for c in ("x", "y") for n, f in (("low", F.min), ("high", F.max))]).alias("r")
    ).scalar()
    return (
        points.withColumn("_r", ends)
        .select(
            _bin(F.col("x"), F.col("_r.xlow"), F.col("_r.xhigh"), x_bins).alias("x_bin"),
            _bin(F.col("y"), F.col("_r.ylow"), F.col("_r.yhigh"), y_bins).alias("y_bin"),
        )
        .groupBy("x_bin", "y_bin")
        .agg(F.count("*").alias("n"))
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 times the box height, and outlier count per group."""
    counts = value_counts(df, value, by)
    quartiles = quantiles_of_counts(counts, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v, n = F.col(value).cast("double"), F.col("n")
    inside = (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach)
    joined = counts.join(quartiles, list(by))
    # a whisker never ends inside the box
    return joined.groupBy(*by, "q1", "median", "q3").agg(
        F.least(F.min(F.when(inside, v)), F.col("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, v)), F.col("q3")).alias("whisker_high"),
        F.sum(n).alias("n"),
        F.sum(F.when(inside, 0).otherwise(n)).alias("outliers"),
    )
