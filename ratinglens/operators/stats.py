"""Correlation, effect size and one-pass rating statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratinglens.functions.rating import entropy_bits, wilson_bounds
from ratinglens.operators.ordered import average_ranks
from ratinglens.session import staged


def spearman(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(pair, n, rho) for every named pair of columns that has rows.

    Rows with a NULL on either side are dropped per pair. Equal rows are merged and written once, narrow. All ranks
    stand in one long table: a column is ranked once for all pairs that leave none of its rows out, which one row of facts
    about the NULLs tells, else once per pair. One join gives every value its rank, and the products of all pairs are summed
    in one aggregation; the mean rank is known, so centred sums stay accurate. A constant side, or fewer than two rows, gives NULL.
    """
    names = list(dict.fromkeys(c for pair in pairs.values() for c in pair))
    merged = df.select(*(F.col(c).cast("double").alias(c) for c in names)).groupBy(*names).agg(F.count("*").alias("_n"))
    cells = staged(merged.withColumn("_id", F.monotonically_increasing_id()), "cells")
    sides = [(name, own, other) for name, (x, y) in pairs.items() for own, other in ((x, y), (y, x))]
    lost = [F.coalesce(F.bool_or(F.col(own).isNotNull() & F.col(other).isNull()), F.lit(False)) for _, own, other in sides]
    gaps = cells.agg(*(c.alias(f"g{i}") for i, c in enumerate(lost))).first()
    rank_of, values = {}, {}
    for (name, own, other), gap in zip(sides, gaps, strict=True):
        key = rank_of[name, own] = f"{own} in {name}" if gap else own
        values[key] = F.when(F.col(other).isNotNull(), F.col(own)) if gap else F.col(own)
    # numbers stand for the names, which would weigh on every row of the shuffles and sorts
    place = {key: f"r{i}" for i, key in enumerate(values)}
    listed = F.array(*(F.struct(F.lit(i).alias("k"), value.alias("v")) for i, value in enumerate(values.values())))
    longer = cells.select("_id", "_n", F.inline(listed)).where("v IS NOT NULL")
    ranks = average_ranks(longer.groupBy("k", "v").agg(F.sum("_n").alias("n")), "v", ["k"])
    centred = F.col("rank") - (F.col("total") + 1) / 2
    wide = longer.join(ranks, ["k", "v"]).groupBy("_id", "_n").agg(
        *(F.max(F.when(F.col("k") == i, centred)).alias(column) for i, column in enumerate(place.values()))
    )
    found = []
    for name, (x, y) in pairs.items():
        dx, dy = (F.col(place[rank_of[name, c]]) for c in (x, y))
        weight = F.when(dx.isNotNull() & dy.isNotNull(), F.col("_n"))
        spread = F.sqrt(F.sum(weight * dx * dx)) * F.sqrt(F.sum(weight * dy * dy))
        rho = F.try_divide(F.sum(weight * dx * dy), F.nullif(spread, F.lit(0.0)))
        found.append(F.struct(F.lit(name).alias("pair"), F.sum(weight).alias("n"), rho.alias("rho")))
    return wide.agg(F.array(*found).alias("found")).select(F.inline("found")).where("n > 0")


def cohens_d(value: Column, left: Column, right: Column) -> Column:
    """Aggregate: standardised mean difference of two row classes, in one pass.

    NULL when a class has fewer than two values or the pooled variance is zero.
    """
    a, b = F.when(left, value), F.when(right, value)
    na, nb = F.count(a), F.count(b)
    pooled = F.try_divide((na - 1) * F.var_samp(a) + (nb - 1) * F.var_samp(b), na + nb - 2)
    enough = (na >= 2) & (nb >= 2) & (pooled > 0)
    return F.when(enough, F.try_divide(F.avg(a) - F.avg(b), F.sqrt(pooled)))


def star_metrics(
    comments: DataFrame,
    keys: Sequence[str] = ("entity_id", "title", "sample_label"),
    star: str = "star_value",
    useful: str = "useful",
    best: int = 5,
) -> DataFrame:
    """Per group: count, plain and weighted means, top-star share with bounds, entropy.

    One aggregation, all of it combinable before the shuffle; NULL keys form groups.
    """
    rated = comments.where(F.col(star).isNotNull())
    s, u = F.col(star).cast("double"), F.col(useful).cast("double")
    heavy = F.log1p(u) + 1
    sums = rated.groupBy(*keys).agg(
        F.count("*").alias("rated"),
        F.avg(s).alias("mean_star"),
        F.sum(s * u).alias("_su"),
        F.sum(u).alias("_u"),
        F.sum(s * heavy).alias("_sh"),
        F.sum(heavy).alias("_h"),
        *[F.count_if(F.col(star) == k).alias(f"_k{k}") for k in range(1, best + 1)],
    )
    n, top = F.col("rated"), F.col(f"_k{best}")
    low, high = wilson_bounds(top, n)
    classes = [F.col(f"_k{k}") for k in range(1, best + 1)]
    return sums.select(
        *keys,
        "rated",
        "mean_star",
        F.coalesce(F.try_divide(F.col("_su"), F.when(F.col("_u") > 0, F.col("_u"))), F.col("mean_star")).alias(
            "useful_weighted_star"
        ),
        F.try_divide(F.col("_sh"), F.col("_h")).alias("log_weighted_star"),
        F.try_divide(top.cast("double"), n.cast("double")).alias("five_star_share"),
        low.alias("five_star_low"),
        high.alias("five_star_high"),
        entropy_bits(classes, n).alias("star_entropy"),
    )


def frequency_table(df: DataFrame, value: str, count: str = "n") -> DataFrame:
    """Value counts, largest first, ties by value."""
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias(count))
    return counted.orderBy(F.col(count).desc(), F.col(value).asc())
