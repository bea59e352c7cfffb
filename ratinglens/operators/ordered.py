"""Ranks and quantiles without a single-task sort.

Values are first reduced to (value, count). The distinct values are cut into
ranges; a running count inside each range plus the total of the ranges before
it gives the running count overall. Cut points only steer the balance: any
boundaries give the same result. They come from a sketch held in a scalar
subquery, so nothing passes through the driver and the plan stays lazy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratinglens.session import staged

#: Ranges per shuffle partition, so that one with many values is made up for by others.
_RANGES_PER_PARTITION = 4
#: Accuracy of the sketch per range; its largest is what the sketch functions take.
_SKETCH_PER_RANGE, _SKETCH_MOST = 4, 65_535


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, value, n) over rows where none of them is NULL."""
    # spelled out, so that the joins below find them and infer no filter that would part their shuffle from the sketch's
    present = df.where(reduce(and_, [_present(df, c) for c in (*by, value)]))
    return present.groupBy(*by, value).agg(F.count("*").alias("n"))


def _present(df: DataFrame, name: str) -> Column:
    there = F.col(name).isNotNull()
    return there & ~F.isnan(name) if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)) else there


def _ranges(df: DataFrame) -> int:
    """The ranges outnumber the shuffle partitions, however many there are."""
    return _RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _with_range(counts: DataFrame, value: str, ranges: int) -> DataFrame:
    """Adds ``_range``, the number of cut points below the value, by binary search among the sketch's quantiles."""
    if ranges < 2:
        return counts.withColumn("_range", F.lit(0))
    accuracy = max(8, min(_SKETCH_MOST, _SKETCH_PER_RANGE * ranges))
    # one text constant, as an array of so many literals would weigh on the plan
    fractions = F.split(F.lit(",".join(str(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
    # the cuts hang on the count, so that the sketch reads the very shuffle the running count reads: Spark then computes it
    # once. Without rows there is no sketch to ask, and one range.
    sketch = counts.agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(accuracy)).alias("sketch"), F.max("n").alias("most"))
    cuts = sketch.select(F.kll_sketch_get_quantile_double(F.when(F.col("most") > 0, F.col("sketch")), fractions).alias("cuts")).scalar()
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(ranges.bit_length()))))
    at = F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(F.col(value) > F.try_element_at(F.col("_cuts"), found + step), found + step).otherwise(found),
    )
    # never NULL, as joins by it would else test that below the aggregation, for every row
    return counts.withColumn("_cuts", cuts).select(*counts.columns, F.coalesce(at, F.lit(0)).alias("_range"))


def _offsets(ranged: DataFrame, by: list[str]) -> DataFrame:
    """Per group and range the rows in it, the rows ``_before`` it, and the group's ``total``: summed before the shuffle."""
    totals = ranged.groupBy(*by, "_range").agg(F.sum("n").alias("_in_range"))
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    return totals.select(
        *by,
        "_range",
        "_in_range",
        F.coalesce(
            F.sum("_in_range").over(group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum("_in_range").over(group).alias("total"),
    )


def _counted_on(ranged: DataFrame, value: str, by: list[str], offsets: DataFrame) -> DataFrame:
    """(by, value, n, cum, total) in the ranges that the offsets name."""
    inside = W.partitionBy(*by, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    return ranged.join(offsets, [*by, "_range"]).select(
        *by, value, "n", (F.sum("n").over(inside) + F.col("_before")).alias("cum"), "total"
    )


def cumulative_counts(
    counts: DataFrame, value: str, by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """(by, value, n) plus ``cum``, the rows up to and including the value, and ``total``."""
    by = list(by)
    ranged = _with_range(counts, value, ranges or _ranges(counts))
    offsets = _offsets(ranged, by)
    return _counted_on(ranged, value, by, offsets if by else F.broadcast(offsets))


def average_ranks(counts: DataFrame, value: str, by: Sequence[str] = (), rank: str = "rank") -> DataFrame:
    """(by, value, rank, total): tied rows share the mean of their positions."""
    cumulative = cumulative_counts(counts, value, by)
    shared = F.col("cum") - (F.col("n") - 1) / 2
    return cumulative.select(*by, value, shared.alias(rank), "total")


def quantiles_of_counts(
    counts: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated exact quantiles, one column per name, one row per group."""
    by = list(by)
    ranged = _with_range(counts, value, _ranges(counts))
    offsets = _offsets(ranged, by)
    # the places asked for lie in a few ranges of each group: rows of the others are neither shuffled nor sorted
    places = [rounded((F.col("total") - 1) * p) for p in probabilities.values() for rounded in (F.floor, F.ceil)]
    holds = [(F.col("_before") <= k) & (k < F.col("_before") + F.col("_in_range")) for k in places]
    wanted = offsets.where(reduce(or_, holds))
    cumulative = _counted_on(ranged, value, by, wanted if by else F.broadcast(wanted))
    total = F.max("total")
    columns = []
    for name, p in probabilities.items():
        spot = F.col("total") - 1
        low = F.min(F.when(F.col("cum") > F.floor(spot * p), F.col(value)))
        high = F.min(F.when(F.col("cum") > F.ceil(spot * p), F.col(value)))
        part = (total - 1) * p - F.floor((total - 1) * p)
        columns.append((low + (high - low) * part).cast("double").alias(name))
    grouped = cumulative.groupBy(*by) if by else cumulative
    return grouped.agg(*columns)


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    return quantiles_of_counts(value_counts(df, value, by), value, probabilities, by)


def exact_medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, measure, median): all columns in one pass, told apart by ``measure``."""
    # numbers stand for the names, which would weigh on every row of the shuffles
    told = [F.struct(F.lit(i).alias("_measure"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)]
    found = exact_quantiles(df.select(*by, F.inline(F.array(*told))), "value", {"median": 0.5}, [*by, "_measure"])
    return found.select(*by, F.array(*map(F.lit, columns))[F.col("_measure")].alias("measure"), "median")


def numbered(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], number: str) -> DataFrame:
    """1-based position of each row in its key by time, ties in the given order.

    Rows are dealt by ranges of (key, time, ties) whose ends Spark samples, and written once so that a row stays in its
    range: a key with many rows, also at one moment, is cut into many ranges. Positions inside a range are
    added to the rows of the key in the ranges before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *keys, order, *ties).withColumn("_range", F.spark_partition_id())
    cut = staged(dealt, "ranges")
    inside = W.partitionBy(*keys, "_range").orderBy(F.col(order), *[F.col(t) for t in ties])
    sizes = cut.groupBy(*keys, "_range").agg(F.count("*").alias("_rows"))
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    offsets = sizes.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_range").alias("_at"), before.alias("_before"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_range") == F.col("_at"))
    return (
        cut.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, same)
        .withColumn(number, (F.col("_inside") + F.col("_before")).cast("bigint"))
        .drop("_range", "_inside", "_before", "_at", *(f"_{k}" for k in keys))
    )
