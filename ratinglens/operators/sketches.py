"""Stored sketches that add up: distinct counts and quantiles of any range of slices without reading a row again.

A sketch is a small binary per group and slice. Rows become sketches once, in one aggregation that combines before the
shuffle; sketches of later batches are merged into those stored (``add_to``), and a question about any set of slices
unites the sketches of these alone. Rows that hold a NULL value count nowhere.

Distinct counts use HyperLogLog sketches of 2^bits registers: the relative standard error is about
``distinct_error(bits)``, and few values are counted exactly. Quantiles use KLL sketches: the share of rows up to a given quantile is
off by less than ``rank_error(k)`` at a confidence of 99 %, however the sketch was put together.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.sources import versions

BITS, ACCURACY = 12, 400


def distinct_error(bits: int = BITS) -> float:
    """Relative standard error of a united distinct count."""
    return 1.04 / math.sqrt(1 << bits)


def rank_error(k: int = ACCURACY) -> float:
    """Bound on the error of a rank, as a share of the rows."""
    return 2.296 / k**0.9723


def distinct_sketches(df: DataFrame, value: str, by: Sequence[str], bits: int = BITS) -> DataFrame:
    """(by, sketch) with the distinct values of each group."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(bits)).alias("sketch"))


def united_distinct(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, sketch): the sketches of each group united."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_counts(sketches: DataFrame, by: Sequence[str] = (), name: str = "distinct") -> DataFrame:
    """(by, distinct): estimated distinct values over all sketches of each group."""
    return united_distinct(sketches, by).select(*by, F.hll_sketch_estimate("sketch").alias(name))


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], k: int = ACCURACY) -> DataFrame:
    """(by, sketch) with the values of each group."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def united_quantiles(sketches: DataFrame, by: Sequence[str], k: int = ACCURACY) -> DataFrame:
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketched_quantiles(
    sketches: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = (), k: int = ACCURACY
) -> DataFrame:
    """(by, n, one column per name): values of which about the given share of rows is not larger; NULL in groups without values."""
    united = united_quantiles(sketches, by, k).withColumn("n", F.kll_sketch_get_n_double("sketch"))
    some = F.col("n") > 0
    found = [F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(name) for name, p in probabilities.items()]
    return united.select(*by, "n", *found)


def add_to(
    path: str, sketches: DataFrame, by: Sequence[str], quantiles: bool = False, buckets: int = versions.BUCKETS, batch: tuple[str, int] | None = None
) -> versions.Version:
    """Unite the sketches of a batch with those stored; only buckets of its groups are read, and no row of an earlier batch.

    ``quantiles`` tells quantile sketches from distinct counts; ``batch`` names a writer and its batch, which counts once.
    """
    unite = united_quantiles if quantiles else united_distinct
    return versions.merge(sketches, path, by, lambda stored, new: unite(stored.unionByName(new), by), buckets, batch)
