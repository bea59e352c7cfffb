"""Cross-site line dedup with HyperLogLog sketches, in DataFrame functions only.

A line is a \\n-separated piece of a text, without white space at its ends; empty ones are never removed. The sketch of the sites
of each line hash merges in partial aggregations, so a line that is everywhere costs each task one row. Lines whose
estimate is far above or below the threshold are settled by it; those near it get an exact count of their sites. A line on
at least `min_sites` sites is boilerplate and goes everywhere but from its first place (smallest document id, then
position), so that text that was copied across sites survives once.

Null texts stay null and have no lines; a null site counts as a site of its own; null ids come last in the order of
places. Rows that share an id and open with a shared line at the same place all keep it if that place is the first. Rows that agree in id and text share their fate. An empty table gives an empty result. Scratch columns start with
an underscore; all columns of the input come back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratinglens.llm.common import shuffled

MIN_SITES = 5
#: log2 of the sketch's buckets; its relative error is about 1.04 / sqrt(2^12), far below the margin of 2 used here.
SKETCH_BITS = 12
MARGIN = 2.0
#: Parts into which the rows of a line are dealt where they meet its count.
SALTS = 16


def _salted(lines: DataFrame) -> DataFrame:
    """Each line under every salt, so that the rows of a frequent line meet it in many tasks."""
    return shuffled(lines.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))


def _pieces(text: str) -> Column:
    return F.transform(F.split(F.col(text), "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")))


def _row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id).cast("string"), F.col(text))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(a, b, first): hashes of the lines on at least min_sites sites, and their first place.

    lines has the two 64-bit hashes a, b of a line, its site, a sortable `place`, and the salt that deals a frequent line.
    """
    merged = lines.groupBy("a", "b").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"), F.min("place").alias("first")
    )
    sure = merged.where(F.col("sites") >= MARGIN * min_sites).select("a", "b", "first")
    near = merged.where((F.col("sites") < MARGIN * min_sites) & (F.col("sites") >= min_sites / MARGIN))
    # (line, site) pairs are made distinct before they meet, so a frequent line stays small
    exact = (
        lines.join(_salted(near.select("a", "b")), ["a", "b", "salt"], "left_semi")
        .groupBy("a", "b", "site")
        .agg(F.min("place").alias("first"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.min("first").alias("first"))
        .where(F.col("n") >= min_sites)
    )
    return sure.union(exact.select("a", "b", "first"))


def drop_shared_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """The documents with boilerplate lines cut from the text; adds _n_lines and _n_removed."""
    others = [c for c in docs.columns if c not in (text, "_n_lines", "_n_removed")]
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), F.col(text).alias("_text"), _row_key(doc_id, text).alias("_key")
    )
    lines = (
        docs.select(
            _row_key(doc_id, text).alias("_key"),
            F.col(doc_id).alias("_id"),
            F.coalesce(F.col(site).cast("string"), F.lit("\0")).alias("site"),
            F.posexplode(_pieces(text)),
        )
        .where("col <> ''")
        .select(
            "_key",
            F.xxhash64("col").alias("a"),
            F.xxhash64(F.lit(1), F.col("col")).alias("b"),
            "site",
            F.struct(F.col("_id").isNull().alias("no_id"), "_id", F.col("pos").alias("pos")).alias("place"),
            F.pmod(F.xxhash64("_key"), F.lit(SALTS)).alias("salt"),
        )
    )
    shared = boilerplate(lines.drop("_key"), min_sites)
    gone = (
        lines.select("_key", "a", "b", "salt", "place")
        .join(_salted(shared), ["a", "b", "salt"])
        .where("place <> first")
        .groupBy("_key")
        .agg(F.collect_set("place.pos").alias("_gone"))
    )
    pieces = F.split(F.col("_text"), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), F.col("_gone"))
    cut = F.array_join(F.transform(stay, lambda i: F.get(F.col("_pieces"), i)), "\n")
    joined = keyed.join(gone, "_key", "left").withColumn("_pieces", F.when(F.col("_gone").isNotNull(), pieces))
    body = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(cut)
    return joined.select(
        *(body.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns if c in (text, *others)),
        F.when(F.col("_text").isNull(), 0).otherwise(F.size(pieces)).cast("long").alias("_n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_n_removed"),
    )


SQL = """
WITH d AS (
  SELECT doc_id, coalesce(source, chr(0)) AS site, text, row_number() OVER () AS r FROM documents
), l AS (
  SELECT r, doc_id, site, pos - 1 AS pos, raw, trim(raw, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT r, doc_id, site, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)
), shared AS (
  SELECT line, min({'id': doc_id, 'pos': pos}) AS first FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 5
), judged AS (
  SELECT l.r, l.pos, l.raw, shared.line IS NOT NULL AND {'id': l.doc_id, 'pos': l.pos} <> shared.first AS gone
  FROM l LEFT JOIN shared USING (line)
), kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone) AS body
  FROM judged GROUP BY r
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
