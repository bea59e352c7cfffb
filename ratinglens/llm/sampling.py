"""Bounded, repeatable samples of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that pass the hash threshold of a label, as a multiple of those wanted.
MARGIN = 8


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_label: int | dict, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(label, place, text) of at most per_label whole texts of each label, chosen by a hash of the id; places are its order.

    labels holds doc_id and label. The number of rows of each label sets a threshold on the hash that lets about MARGIN
    times the wanted rows pass, so however frequent a label is, few of its rows are ranked. Null ids, labels and texts
    are left out; an id with several labels counts once with each.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("string").alias("label")).dropna().distinct()
    wanted = per_label if isinstance(per_label, dict) else None
    # one row a label, of which a classifier has few
    numbers = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    shares = {name: MARGIN * (wanted.get(name, 0) if wanted is not None else per_label) / n for name, n in numbers.items()}
    low = F.lit(False)
    for name, share in shares.items():
        upto = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
        low = F.when(F.col("label") == name, F.xxhash64("id") <= F.lit(upto).cast("long")).otherwise(low)
    order = [F.xxhash64("id"), "id"]
    place = F.row_number().over(Window.partitionBy("label").orderBy(*order))
    chosen = known.where(low).withColumn("place", place).where(_limit(per_label) >= F.col("place"))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).dropna()
    return texts.join(F.broadcast(chosen), "id").groupBy("label", "place").agg(F.min("text").alias("text"))


def _limit(per_label: int | dict) -> Column:
    if isinstance(per_label, int):
        return F.lit(per_label)
    out = F.lit(0)
    for label, n in per_label.items():
        out = F.when(F.col("label") == label, n).otherwise(out)
    return out
