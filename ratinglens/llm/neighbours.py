"""Nearest vectors by collision-counting hashing with query-centred windows.

Vectors are dealt into blocks by a hash. For a block, each of PROJECTIONS random directions gives a sorted array of the
unit vectors' single projections. A query opens a window around its own projection in every array; a vector inside
collides. Windows widen step by step (virtual rehashing: the same arrays serve every radius, and a step reads only what
is new at both ends). A vector that collides in at least the threshold of the arrays is verified: its cosine is
computed in double precision from the original vectors. With windows of WIDTH times the radius, a vector within the radius
collides in an array with a fixed probability, so the search of a block ends once the k-th best found lies within the radius. The
last radius is the largest distance of unit vectors; if fewer than k were found by then, all the rest are verified.

Every vector is indexed and every query meets every block; a query's finds of all blocks are merged. The index depends on no
sample. Of equal vectors only the k + 1 smallest ids can be among the nearest, so no more are sent; that limit is
taken in each task before the shuffle. A task holds one block and a batch of queries.

Rows with a null id, and vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those of another
length than the most frequent one (the smallest of equally frequent ones). Repeated rows (same id and vector) count once;
rows that share an id but not the vector are each a candidate and a query, an id is found once, at its best, and never for
itself. Ties go to the smaller id. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block, and queries that one task of a block answers, on average.
BLOCK, QUERY_GROUP = 16_384, 8_192
#: Queries whose collision counts are held at a time.
BATCH = 64
#: Sorted arrays of a block; half width of a window at radius one; widening of the radius in a step; the first radius.
PROJECTIONS, WIDTH, STEP, FIRST_RADIUS = 64, 1.12, 1.1, 0.3
#: The threshold lies so many standard deviations under the mean collisions of a vector at the radius.
SLACK = 1.6
SEED = 20_011
#: No two unit vectors are farther apart; collisions of a vector that is verified.
FARTHEST, DONE = 2.0, -(1 << 40)


def threshold(projections: int = PROJECTIONS, width: float = WIDTH) -> int:
    """Collisions from which a vector is verified."""
    hit = math.erf(width / math.sqrt(2))
    return max(1, math.floor(projections * hit - SLACK * math.sqrt(projections * hit * (1 - hit))))


class Vectors:
    """Vectors scaled by powers of two, which changes no cosine, with their norms."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray):
        self.ids = ids
        raw = np.ascontiguousarray(raw, dtype=np.float64)
        self.raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1))[1][:, None])
        self.norms = np.sqrt((self.raw * self.raw).sum(axis=1))
        self.units = self.raw / self.norms[:, None]

    def part(self, start: int, end: int) -> Vectors:
        return Vectors(self.ids[start:end], self.raw[start:end])

    def cosines(self, places: np.ndarray, vector: np.ndarray, norm: float) -> np.ndarray:
        # row by row, so that equal vectors get equal values wherever they stand
        return (self.raw[places] * vector).sum(axis=1) / (self.norms[places] * norm)


class CollisionIndex:
    """Sorted single projections of a block of vectors."""

    def __init__(self, vectors: Vectors):
        self.vectors, self.size = vectors, len(vectors.ids)
        self.directions = np.random.default_rng(SEED).standard_normal((vectors.raw.shape[1], PROJECTIONS))
        values = (vectors.units @ self.directions).T
        order = np.argsort(values, axis=1)
        self.values = np.take_along_axis(values, order, axis=1)
        self.order = order.ravel()
        self.starts = np.arange(PROJECTIONS) * self.size

    def bounds(self, centres: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """First and last place (exclusive) of each query's window in each array, as places in `order`."""
        low = np.stack([np.searchsorted(v, c - half, "left") for v, c in zip(self.values, centres.T, strict=True)], axis=1)
        high = np.stack([np.searchsorted(v, c + half, "right") for v, c in zip(self.values, centres.T, strict=True)], axis=1)
        return low + self.starts, high + self.starts

    def search(self, queries: Vectors, k: int) -> Iterator[tuple[int, int, float]]:
        """(query id, id, cosine) of the k nearest found in this block for each query."""
        centres = queries.units @ self.directions
        counts = np.zeros((len(queries.ids), self.size), dtype=np.int64)
        best: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        active = np.arange(len(queries.ids))
        low = high = self.bounds(centres, 0.0)[0]
        radius, least = FIRST_RADIUS, threshold()
        while len(active):
            new_low, new_high = self.bounds(centres[active], WIDTH * radius)
            going = np.zeros(len(active), dtype=bool)
            for place, q in enumerate(active.tolist()):
                self._widen(counts[q], new_low[place], low[place], high[place], new_high[place])
                self._verify(queries, q, counts[q], least, best, k)
                if radius >= FARTHEST:
                    if len(best[q]) < k:
                        self._verify(queries, q, counts[q], 0, best, k)
                else:
                    going[place] = len(best[q]) < k or 2 + 2 * best[q][-1][0] > radius * radius
            active, low, high = active[going], new_low[going], new_high[going]
            radius *= STEP
        for q, top in enumerate(best):
            for negative, vec_id in top:
                yield int(queries.ids[q]), vec_id, -negative

    def _widen(self, counts: np.ndarray, *ends: np.ndarray) -> None:
        """Count what stands in the arrays between the outer and the inner ends of the windows."""
        parts = []
        for a, b, c, d in zip(*(e.tolist() for e in ends), strict=True):
            parts += (self.order[a:b], self.order[c:d])
        counts += np.bincount(np.concatenate(parts), minlength=self.size)

    def _verify(self, queries: Vectors, q: int, counts: np.ndarray, least: int, best: list, k: int) -> None:
        """Put vectors with enough collisions into the query's list of (minus cosine, id)."""
        found = np.flatnonzero(counts >= least)
        if not len(found):
            return
        counts[found] = DONE
        found = found[self.vectors.ids[found] != queries.ids[q]]
        scores = self.vectors.cosines(found, queries.raw[q], queries.norms[q])
        if len(found) > 4 * k:  # the k-th best distinct id is not below the k-th best of those that are kept
            keep = np.argpartition(-scores, 2 * k)[: 2 * k]
            keep = np.flatnonzero(scores >= scores[keep].min())
            found, scores = found[keep], scores[keep]
        best[q] = nearest_ids([*best[q], *zip((-scores).tolist(), self.vectors.ids[found].tolist(), strict=True)], k)


def nearest_ids(pairs: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    """The k first (minus cosine, id) of different ids."""
    out: dict[int, float] = {}
    for negative, vec_id in sorted(pairs):
        if len(out) == k:
            break
        out.setdefault(vec_id, negative)
    return [(negative, vec_id) for vec_id, negative in out.items()]


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vec) of rows that can take part, repeated rows once."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vec")).dropna()
    return named.where(finite & F.exists("vec", lambda x: x != 0)).distinct()


def nearest(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors found for each row that is_query, a condition on `id`."""
    if k < 1:
        raise ValueError("k from 1")
    rows = usable(vectors, vec_id, vector).withColumn("asks", F.coalesce(is_query, F.lit(False)))
    sizes = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"), F.count_if("asks").alias("asking"))
    found = sizes.orderBy(F.desc("n"), "size").first()
    size, n, asking = found or (0, 0, 0)
    rows = rows.where(F.size("vec") == size)
    n_blocks, n_groups = max(1, -(-n // BLOCK)), max(1, -(-asking // QUERY_GROUP))
    copies = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    indexed = (
        rows.withColumn("copy", copies)
        .where(F.col("copy") <= k + 1)
        .withColumn("block", F.pmod(F.xxhash64("vec"), F.lit(n_blocks)))
        .withColumn("of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))))
    )
    queries = (
        rows.where("asks")
        .withColumn("of", F.pmod(F.xxhash64("id"), F.lit(n_groups)))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    )
    met = indexed.select("block", "of", F.lit(False).alias("asks"), "id", "vec").union(
        queries.select("block", "of", F.lit(True).alias("asks"), "id", "vec")
    )
    ordered = met.repartition("block", "of").sortWithinPartitions("block", "of", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for answers in search_blocks(batches, size, k):
            columns = zip(*answers, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score"]
            )

    each = ordered.mapInArrow(run, "query_id long, vec_id long, score double")
    best = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_blocks(batches: Iterable[pa.RecordBatch], size: int, k: int) -> Iterator[list[tuple]]:
    """Answers of each batch of queries; rows (block, of, asks, id, vec) come with a block's vectors before its queries."""
    place, index, held, asked = None, None, [], []

    def answers() -> Iterator[list[tuple]]:
        nonlocal asked
        if asked and index:
            queries = _gathered(asked)
            for at in range(0, len(queries.ids), BATCH):
                if out := list(index.search(queries.part(at, at + BATCH), k)):
                    yield out
        asked = []

    for b in batches:
        keys = np.stack([b.column(i).to_numpy() for i in (0, 1)], axis=1)
        asks = b.column(2).to_numpy(zero_copy_only=False)
        ids = b.column(3).to_numpy()
        raw = b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1
        for part in np.split(np.arange(b.num_rows), cuts) if b.num_rows else ():
            if (key := tuple(keys[part[0]].tolist())) != place:
                yield from answers()
                place, index, held = key, None, []
            if not asks[part[0]]:
                held.append((ids[part], raw[part]))
                continue
            if held:
                index, held = CollisionIndex(_gathered(held)), []
            asked.append((ids[part], raw[part]))
            if sum(len(i) for i, _ in asked) >= BATCH:
                yield from answers()
    yield from answers()


def _gathered(parts: list[tuple]) -> Vectors:
    return Vectors(*(np.concatenate(c) for c in zip(*parts, strict=True)))
