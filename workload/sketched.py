"""Stored sketches next to exact counts: the queries tell exact figures and whether the estimates keep their bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.operators import sketches
from ratinglens.session import durable_path
from ratinglens.sources import versions
from workload.standins import table

#: Standard errors that a distinct count may be off.
SIGMAS = 4


def tag_reach(spark: SparkSession, d: str) -> DataFrame:
    """Users per kind of event over some days, from daily sketches that two batches put together."""
    path = durable_path(spark, "reach")
    events = table(spark, d, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    for i, part in enumerate(("event_id % 3 = 0", "event_id % 3 <> 0")):
        rows = table(spark, d, "events").where(part).select("user_id", "event_type", F.to_date("ts").alias("day"))
        daily = sketches.distinct_sketches(rows, "user_id", ["event_type", "day"])
        sketches.add_to(path, daily, ["event_type", "day"], buckets=8, batch=("events", i))
    range_of = "day >= DATE'2024-01-03' AND day < DATE'2024-01-20'"
    found = sketches.distinct_counts(versions.read(spark, path).where(range_of), ["event_type"], "estimate")
    exact = events.where(range_of).groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    off = F.abs(F.col("estimate") - F.col("users"))
    bound = F.greatest(F.lit(0.5), SIGMAS * sketches.distinct_error() * F.col("users"))
    return exact.join(found, "event_type").select("event_type", "users", (off <= bound).alias("within_bound"))


TAG_REACH = """
SELECT event_type, count(DISTINCT user_id) AS users, true AS within_bound FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-03' AND CAST(ts AS DATE) < DATE '2024-01-20' GROUP BY 1"""

_QUANTILES = {"q1": 0.25, "median": 0.5, "p99": 0.99}


def price_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of the order price per priority, from sketches per year that three batches put together."""
    path = durable_path(spark, "prices")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("year"), "o_totalprice")
    by = ["o_orderpriority", "year"]
    for i in range(3):
        part = sketches.quantile_sketches(orders.where(F.col("o_orderkey") % 3 == i), "o_totalprice", by)
        sketches.add_to(path, part, by, quantiles=True, buckets=8, batch=("orders", i))
    found = sketches.sketched_quantiles(versions.read(spark, path), _QUANTILES, ["o_orderpriority"])
    # the rows up to a quantile, and those below it, stand on either side of its share
    price = F.col("o_totalprice").cast("double")
    judged = orders.join(found, "o_orderpriority").groupBy("o_orderpriority", "n").agg(
        F.count("*").alias("orders"),
        *(F.avg((price <= F.col(name)).cast("int")).alias(f"{name}_upto") for name in _QUANTILES),
        *(F.avg((price < F.col(name)).cast("int")).alias(f"{name}_below") for name in _QUANTILES),
    )
    error = sketches.rank_error()
    within = [((F.col(f"{c}_upto") >= p - error) & (F.col(f"{c}_below") <= p + error)).alias(f"{c}_within") for c, p in _QUANTILES.items()]
    return judged.select("o_orderpriority", "orders", (F.col("n") == F.col("orders")).alias("all_counted"), *within)


PRICE_SKETCHES = """
SELECT o_orderpriority, count(*) AS orders, true AS all_counted, true AS q1_within, true AS median_within, true AS p99_within
FROM orders GROUP BY 1"""

QUERIES = {"tag_reach": (tag_reach, TAG_REACH), "price_sketches": (price_sketches, PRICE_SKETCHES)}
