"""SimHash near-duplicates found by covering locality-sensitive hashing.

Each of the 64 bits gets a nonzero vector of radius + 1 bits. A table belongs to a nonzero vector v and keeps the bits
whose own vector has an odd product with v. Any `radius` differing bits span less than the whole space, so some v is
orthogonal to all of them: that table hides every difference, and the pair meets there. There are 2^(radius+1) - 1 tables
and each keeps about half of the bits.

Only distinct fingerprints are hashed, so groups of exact copies count once. In a bucket every member is compared with the
smallest one. Only buckets in which a member was too far from it and that still hold more than one component are
searched further, in blocks of bounded size, between different components.

Null and empty texts, and texts without words, have fingerprint zero and link like any other. Documents with a null id take
part; a component of null ids alone has a null id. Repeated rows and ids are kept, each with its component.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratinglens.llm.common import add_columns, map_rows, shuffled, unused, utf8
from ratinglens.llm.components import components
from ratinglens.session import staged

BITS, SEED = 64, 42
#: Members of a bucket that are compared at a time.
BLOCK = 2048


def fingerprint(text: str | None, words: int) -> int:
    """Bit b is 1 if it is set in over half of the shingles' hashes; 0 without words."""
    parts = utf8(text).lower().split() if text else []
    if not parts:
        return 0
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    body = b" ".join(parts)
    span = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    places = zip(starts[: len(parts) - span + 1].tolist(), ends[span - 1 :].tolist(), strict=True)
    hashes = np.array([digest(body[i:j], SEED) for i, j in places], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 8192):
        part = hashes[i : i + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def masks(radius: int) -> list[int]:
    """The kept bits of each table."""
    n = (1 << radius + 1) - 1
    vectors = [b % n + 1 for b in range(BITS)]
    return [
        sum(1 << b for b in range(BITS) if (vectors[b] & v).bit_count() % 2) for v in range(1, n + 1)
    ]


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints that give the same components as all pairs within the radius."""
    tables = F.array(*(F.lit(signed(m)).cast("long") for m in masks(radius)))
    rows = prints.select("fp", F.posexplode(tables).alias("t", "mask")).select(
        F.col("t").cast("byte").alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )
    buckets = rows.groupBy("t", "key").agg(F.min("fp").alias("lead"), F.count("*").alias("n")).where("n > 1")
    met = staged(rows.join(shuffled(buckets), ["t", "key"]).withColumn("near", distance("fp", "lead") <= radius), "buckets")
    direct = met.where("near and fp <> lead").select(F.col("lead").alias("a"), F.col("fp").alias("b")).distinct()
    direct = staged(direct, "near")
    # a bucket of two is settled; in a larger one, members far from the smallest may be near each other
    unsure = met.where("n > 2").groupBy("t", "key").agg(F.bool_and("near").alias("sure")).where("not sure")
    if unsure.isEmpty():
        return direct
    label = components(direct)
    members = (
        met.join(shuffled(unsure.drop("sure")), ["t", "key"])
        .join(shuffled(label.withColumnRenamed("node", "fp")), "fp", "left")
        .select("t", "key", "fp", F.coalesce("component", "fp").alias("label"))
    )
    mixed = members.groupBy("t", "key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h")
    members = members.join(shuffled(mixed.select("t", "key")), ["t", "key"])
    return direct.union(_between_components(members, radius))


def _between_components(members: DataFrame, radius: int) -> DataFrame:
    """Links between members of a bucket that are of different components, block of members against block."""
    block = F.pmod(F.xxhash64("fp"), F.greatest(F.ceil(F.col("size") / BLOCK), F.lit(1)))
    sizes = members.groupBy("t", "key").agg(F.count("*").alias("size"))
    dealt = members.join(shuffled(sizes), ["t", "key"]).withColumn("i", block)
    n_blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.lit(1))
    pairs = dealt.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1))).select(
        "t", "key", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), (F.col("i") <= F.col("j")).alias("left"), "fp", "label"
    )
    ordered = pairs.repartition("t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y")

    def rows(source: Iterable[tuple]) -> Iterable[tuple]:
        place, held = None, []
        for row in source:
            if row[:4] != place:
                yield from near(held)
                place, held = row[:4], []
            held.append(row[4:])
        yield from near(held)

    def near(held: list[tuple]) -> Iterable[tuple]:
        """One link for each two components with members within the radius."""
        left = np.array([h[1:] for h in held if h[0]], dtype=np.int64).reshape(-1, 2)
        right = np.array([h[1:] for h in held if not h[0]], dtype=np.int64).reshape(-1, 2)
        other = right if len(right) else left
        seen: set[tuple[int, int]] = set()
        for fp, label in left.tolist():
            close = np.bitwise_count(np.bitwise_xor(other[:, 0], fp).view(np.uint64)) <= radius
            for found in np.unique(other[close & (other[:, 1] != label), 1]).tolist():
                if (link := (min(label, found), max(label, found))) not in seen:
                    seen.add(link)
                    yield link

    return map_rows(ordered, "a long, b long", rows).distinct()


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4, name: str = "fp", keep_text: bool = True) -> DataFrame:
    """The documents with their fingerprint as a signed 64-bit number in one more column."""
    return add_columns(docs, text, f"{name} long", lambda texts: [(signed(fingerprint(t, words)),) for t in texts], keep_text)


def groups(prints: DataFrame, radius: int = 4) -> DataFrame:
    """(fp, component_id, keeps) for each distinct fp of (id, fp).

    component_id is the smallest id in the component; `keeps` marks the one fingerprint of a component whose document
    with that id stands for it.
    """
    if not 0 <= radius <= 7:
        raise ValueError("radius from 0 to 7: the number of tables doubles with each bit")
    distinct = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    label = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    of_print = distinct.join(shuffled(label), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = of_print.groupBy("component").agg(
        F.min(F.struct(F.col("least").isNull(), "least", "fp")).alias("first")  # null ids only where there are no others
    )
    return of_print.join(shuffled(least), "component").select(
        "fp", F.col("first.least").alias("component_id"), (F.col("fp") == F.col("first.fp")).alias("keeps")
    )


def _prints(docs: DataFrame, doc_id: str, text: str, words: int, keyed: bool = False) -> DataFrame:
    """(id, fp) of each document, with 128 bits of its text's hash if keyed."""
    keys = [F.xxhash64(F.col(text)).alias("a"), F.xxhash64(F.lit(1), F.col(text)).alias("b")] if keyed else []
    narrow = docs.select(F.col(doc_id).alias("id"), *keys, F.col(text).alias("text"))
    return staged(fingerprints(narrow, "text", words, keep_text=False), "prints")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4
) -> DataFrame:
    """(doc_id, fp, component_id) for each document."""
    prints = _prints(docs, doc_id, text, words)
    return prints.join(shuffled(groups(prints, radius)), "fp").select(F.col("id").alias(doc_id), "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """The documents without near-duplicates: of each component the document with the smallest id stays, once.

    Of rows that share that id and fingerprint the one with the smallest hash of its text stays, and of equal texts the row
    with the smallest hash of all its columns.
    """
    prints = _prints(docs, doc_id, text, words, keyed=True)
    kept = shuffled(groups(prints, radius).where("keeps").select("fp", F.col("component_id").alias("keeper")))
    chosen = prints.join(kept, (prints["fp"] == kept["fp"]) & prints["id"].eqNullSafe(kept["keeper"]))
    chosen = chosen.groupBy(prints["fp"], "keeper").agg(F.min(F.struct("a", "b")).alias("own"), F.count("*").alias("rows"))
    own_id, a, b, rows = (unused(docs, name) for name in ("_kept_id", "_kept_a", "_kept_b", "_kept_rows"))
    chosen = staged(
        chosen.select(F.col("keeper").alias(own_id), F.col("own.a").alias(a), F.col("own.b").alias(b), F.col("rows").alias(rows)), "kept"
    )
    same = (F.xxhash64(F.col(text)) == F.col(a)) & (F.xxhash64(F.lit(1), F.col(text)) == F.col(b))
    out = docs.join(shuffled(chosen), F.col(doc_id).eqNullSafe(F.col(own_id)) & same)
    if not chosen.where(F.col(rows) > 1).isEmpty():
        rank = F.row_number().over(Window.partitionBy(own_id, a, b).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))))
        out = out.withColumn(rows, rank).where(F.col(rows) == 1)
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
