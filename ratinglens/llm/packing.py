"""Best-fit decreasing packing of token sequences.

Lengths are whole numbers up to the capacity, so best-fit decreasing can be planned on the number of pieces of each
length: a table of at most `capacity` rows, whatever the size of the corpus. The plan walks the lengths downwards; a segment
tree over remaining capacities finds the tightest open sequence that takes a piece in logarithmic time. Sequences that
were filled alike form one group, so the plan has a few groups for each length, and the result is that of best-fit
decreasing over all pieces of the corpus at once. Each piece then looks up its place by its length and its rank
among pieces of that length.

Null and empty texts have no ids of their own and become one piece that holds the end id alone. Repeated rows and ids
and null ids are packed row by row. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratinglens.llm.common import map_rows, shuffled
from ratinglens.llm.tokens import encoder
from ratinglens.session import staged


class OpenSequences:
    """Groups of alike sequences by remaining capacity, under a segment tree that tells which capacities occur."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.leaves)
        self.groups: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, room: int, some: bool) -> None:
        node = room + self.leaves
        self.some[node] = some
        while node > 1:
            node //= 2
            self.some[node] = self.some[2 * node] or self.some[2 * node + 1]

    def add(self, room: int, first: int, count: int) -> None:
        """Sequences first .. first + count - 1 have this room left."""
        if room and count:
            self.groups.setdefault(room, []).append((first, count))
            self._mark(room, True)

    def take(self, length: int) -> tuple[int, int, int] | None:
        """Remove and return (room, first, count) of the tightest group that has room for the length."""
        node = length + self.leaves
        while not self.some[node]:
            while node > 1 and node % 2:  # up until a right neighbour exists
                node //= 2
            if node <= 1:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        room = node - self.leaves
        first, count = self.groups[room].pop()
        if not self.groups[room]:
            self._mark(room, False)
        return room, first, count


def plan(counts: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places for `count` pieces of each length, as (length, first rank, first sequence, offset, pieces per sequence).

    A row holds for the ranks from its first one up to that of the length's next row: rank r goes to sequence
    first + (r - rank) // per, at offset + (r - rank) % per * length.
    """
    out: list[tuple[int, int, int, int, int]] = []
    open_, fresh = OpenSequences(capacity), 0
    for length, count in sorted(counts, reverse=True):
        rank = 0
        while rank < count:
            group = open_.take(length)
            if group is None:
                per = capacity // length
                room, first, size = capacity, fresh, -(-(count - rank) // per)
                fresh += size
            else:
                room, first, size = group
                per = room // length
            # once a piece is in a sequence, that is the tightest with room for the next
            whole = min(size, (count - rank) // per)
            if whole:
                out.append((length, rank, first, capacity - room, per))
                open_.add(room - per * length, first, whole)
                rank += whole * per
            if whole < size and rank < count:
                rest = count - rank
                out.append((length, rank, first + whole, capacity - room, rest))
                open_.add(room - rest * length, first + whole, 1)
                rank, whole = count, whole + 1
            if whole < size:
                open_.add(room, first + whole, size - whole)
    return out


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = True
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): a document's ids and end id, cut where they exceed the capacity.

    ids are little-endian unsigned 32-bit numbers; without keep_ids they are left out.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(source: Iterable[tuple]) -> Iterable[tuple]:
        for name, encoded in encoder(tokenizer).encode_rows(source):
            ids = encoded + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                yield (name, piece, at // 4, len(part) // 4, zlib.crc32(part), *([part] if keep_ids else []))

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return map_rows(narrow, schema, rows)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to pieces of a `length` up to the capacity.

    Pieces of one length are ranked inside chunks by a hash, so a length that a third of all pieces share is dealt over
    many tasks; the chunks' sizes are then added up.
    """
    chunks = max(8, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = pieces.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    sizes = staged(keyed.groupBy("length", "_chunk").agg(F.count("*").alias("n")), "sizes")
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    counts = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    places = plan([(r["length"], r["n"]) for r in counts], capacity)
    inside = Window.partitionBy("length", "_chunk").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("_in", F.row_number().over(inside) - 1).join(shuffled(bases), ["length", "_chunk"])
    return _look_up(ranked.withColumn("_rank", F.col("_base") + F.col("_in")).drop("_chunk", "_in", "_base"), places)


def _look_up(ranked: DataFrame, places: list[tuple]) -> DataFrame:
    """Join each (length, rank) with the row of the plan that holds for it; the plan's size depends on the capacity alone."""
    spark = ranked.sparkSession
    table = spark.sparkContext.broadcast(np.array(places, dtype=np.int64).reshape(-1, 5))
    columns = [f.name for f in ranked.schema.fields]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields)

    def run(batches):
        import pyarrow as pa

        rows = table.value
        # the plan is in falling order of lengths and rising order of ranks within
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        rows = rows[order]
        lengths = rows[:, 0]
        for b in batches:
            length = b.column(columns.index("length")).to_numpy()
            rank = b.column(columns.index("_rank")).to_numpy()
            at = np.empty(len(length), dtype=np.int64)
            for one in np.unique(length):
                low, high = np.searchsorted(lengths, one), np.searchsorted(lengths, one, side="right")
                own = length == one
                at[own] = low + np.searchsorted(rows[low:high, 1], rank[own], side="right") - 1
            _, first, sequence, offset, per = rows[at].T
            ahead = rank - first
            new = [pa.array(sequence + ahead // per), pa.array(offset + ahead % per * length)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*columns, "sequence_id", "offset"])

    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long").drop("_rank")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece, and the ids if asked for."""

    pieces = token_pieces(docs, tokenizer, end_id, capacity, doc_id, text, keep_ids)
    return place(staged(pieces, "pieces"), capacity)
