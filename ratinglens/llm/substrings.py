"""Exact removal of repeated passages, found by difference-cover anchors.

Two equal windows start anywhere, so no fixed grid meets both. With a difference cover D of a period v there is, for any two
starts, a shift below v that takes both to positions in D modulo v. Hence every pair of equal windows of `window` words
shares an anchor: window - v + 1 equal words at cover positions of both. Only those positions are hashed and shuffled
(5 of 18 for windows of 35 words). Where an anchor repeats, all windows that contain it are hashed whole; windows that repeat are removed.

Identical texts are treated once: all their windows repeat, and one copy speaks for them elsewhere. A task shuffles a
hash that it sees several times itself only once, so a passage in very many documents stays small.

A null text has no words. Texts shorter than a window keep all words. Repeated rows count as copies, also with the same
id; null ids are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.llm.common import map_rows, spaced_words, text_key
from ratinglens.session import staged

#: The period at most; half the window otherwise.
PERIOD = 21
#: Words whose hashes a worker remembers.
REMEMBERED = 500_000
_BASE = 0xD1342543DE82EF95 | 1
_SCHEMA = "h long, key long, pos long"


@functools.cache
def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set whose differences give every residue of the period."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("the period must be positive")


class WordHasher:
    """Hashes of all windows of a width in one text, from prefix sums of word hashes times powers, modulo 2^64."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def words(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            return np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            known.update((w, xxhash.xxh64_intdigest(w, 7)) for w in set(words) if w not in known)
            return np.array([known[w] for w in words], dtype=np.uint64)

    def windows(self, hashes: np.ndarray, width: int, twist: int = 0) -> np.ndarray:
        n = len(hashes)
        if n < width:
            return np.zeros(0, dtype=np.uint64)
        self._powers(n)
        if twist:
            hashes = (hashes ^ np.uint64(twist)) * np.uint64(0x9FB21C651E98DF25)
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(hashes * self.up[:n], dtype=np.uint64)))
        out = (sums[width:] - sums[:-width]) * self.down[: n - width + 1]
        return (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


# `pos` of a shuffled row holds, from the top: 32 further bits of the hash (windows only), 30 bits of position, and
# two marks. LOCAL: this place is known to repeat and only passes through. AGAIN: the hash repeats in the task it is from.
LOCAL, AGAIN = 1, 2
_PLACE = (1 << 30) - 1


def _combined(h: np.ndarray, key: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Rows of one task (pos without marks) such that each hash is shuffled once.

    A hash with several places goes once, marked AGAIN; its other places are marked LOCAL and dealt by chance.
    """
    order = np.lexsort((pos, key, h))
    h, key, pos = h[order], key[order], pos[order]
    check = pos >> 32
    same_hash = (h[1:] == h[:-1]) & (check[1:] == check[:-1])
    fresh = np.concatenate(([True], ~(same_hash & (key[1:] == key[:-1]) & (pos[1:] == pos[:-1]))))
    h, key, pos, check = h[fresh], key[fresh], pos[fresh], check[fresh]
    first = np.concatenate(([True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])))
    several = np.diff(np.concatenate((np.flatnonzero(first), [len(h)]))) > 1
    group = np.cumsum(first) - 1
    marks = np.where(first, np.where(several[group], AGAIN, 0), LOCAL)
    spread = key.view(np.uint64) * np.uint64(_BASE) + pos.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = np.where(first, h, spread.view(np.int64))
    return np.stack((h, key, pos | marks), axis=1)


def _hashed(source: DataFrame, hashes, rows_at_once: int = 2_000_000) -> DataFrame:
    """Map rows (key, text, ...) to shuffled rows; hashes(row, hasher) gives (hash, pos) arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = WordHasher(), [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                h, pos = hashes(row, hasher)
                if len(h):
                    held.append((h.view(np.int64), np.full(len(h), row[0], dtype=np.int64), pos))
                    size += len(h)
                if size >= rows_at_once:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    def pack(held: list[tuple]) -> pa.RecordBatch:
        rows = _combined(*(np.concatenate(c) for c in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=["h", "key", "pos"])

    return source.mapInArrow(run, _SCHEMA)


def _repeated(rows: DataFrame) -> DataFrame:
    """(key, places) of hashes that occur at several places, in one shuffle by hash and one by text.

    A partition is read in order of the hash, one batch at a time; of the last hash only one row is carried on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, told = np.zeros((0, 3), dtype=np.int64), False
        for b in batches:
            if not b.num_rows:
                continue
            rows = np.stack([c.to_numpy() for c in b.columns], axis=1)
            local = (rows[:, 2] & LOCAL) > 0
            passed, rows = rows[local], np.concatenate((carried, rows[~local]))
            if len(rows):
                h, key, pos = rows.T
                new = np.concatenate(([True], (h[1:] != h[:-1]) | (pos[1:] >> 32 != pos[:-1] >> 32)))
                other = ~new & np.concatenate(([False], (key[1:] != key[:-1]) | (pos[1:] >> 2 != pos[:-1] >> 2)))
                group = np.cumsum(new) - 1
                repeats = np.bincount(group, weights=other | ((pos & AGAIN) > 0)) > 0
                chosen = repeats[group] & (new | other)
                if len(carried) and told:
                    chosen[0] = False
                carried, told = rows[-1:].copy(), bool(repeats[-1])
                carried[0, 2] |= AGAIN * told
                rows = rows[chosen]
            out = np.concatenate((passed, rows))
            if len(out):
                place = (out[:, 2] >> 2) & _PLACE
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[:, 1])), pa.array(place)], names=["key", "place"])

    # rows of a hash with different further bits must not interleave
    ordered = rows.repartition("h").sortWithinPartitions("h", F.expr("shiftright(pos, 32)"), "key", "pos")
    return ordered.mapInArrow(run, "key long, place long").groupBy("key").agg(F.collect_set("place").alias("places"))


def _anchors(window: int, period: int):
    cover = np.zeros(period, dtype=bool)
    cover[list(difference_cover(period))] = True
    width = window - period + 1

    def hashes(row: tuple, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
        found = hasher.windows(hasher.words(spaced_words(row[1])), width)
        at = np.flatnonzero(cover[np.arange(len(found)) % period])
        return found[at], at << 2

    return hashes


def _whole_windows(window: int, period: int):
    def hashes(row: tuple, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
        words = hasher.words(spaced_words(row[1]))
        found = hasher.windows(words, window)
        edge = np.zeros(len(found) + window + 1, dtype=np.int64)
        anchors = np.array(row[3], dtype=np.int64)
        np.add.at(edge, np.minimum(np.maximum(anchors - period + 1, 0), len(found)), 1)
        np.add.at(edge, np.minimum(anchors + 1, len(found)), -1)
        at = np.flatnonzero(np.cumsum(edge)[: len(found)] > 0)
        check = hasher.windows(words, window, twist=0x5851F42D4C957F2D)[at] >> np.uint64(33)
        return found[at], (check.astype(np.int64) << 32) | (at << 2)

    return hashes


def removals(docs: DataFrame, text: str = "text", window: int = 35) -> DataFrame:
    """(key, text, n, places): each distinct text, its copies, and the starts of its repeated windows (null if none).

    key is `text_key` of the documents.
    """
    period = max(1, min(PERIOD, (window + 1) // 2))
    keyed = docs.select(text_key(text).alias("key"), F.col(text).alias("text"))
    anchors = staged(_repeated(_hashed(keyed, _anchors(window, period))), "anchors").withColumnRenamed("places", "anchors")
    # the same columns on both uses, so that the texts are shuffled once
    texts = keyed.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("n"))
    windows = _repeated(_hashed(texts.join(anchors, "key").select("key", "text", "n", "anchors"), _whole_windows(window, period)))
    return texts.join(windows, "key", "left").select("key", "text", "n", "places")


def kept_words(text: str | None, n: int, places: list[int] | None, window: int) -> tuple[int, list[bytes]]:
    """(number of words, the words that stay)."""
    words = spaced_words(text)
    if n > 1 and len(words) >= window:
        return len(words), []
    if not places:
        return len(words), words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.array(places, dtype=np.int64)
    edge[starts] += 1
    ends, often = np.unique(starts + window, return_counts=True)
    edge[ends] -= often
    return len(words), [w for w, gone in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if gone <= 0]


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 35, digest: bool = False
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept words joined by a space, or with `digest` their SHA-256."""

    def rows(source: Iterable[tuple]) -> Iterable[tuple]:
        for key, body, n, places in source:
            total, kept = kept_words(body, n, places, window)
            joined = b" ".join(kept)
            yield key, total, total - len(kept), hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "replace")

    done = map_rows(removals(docs, text, window), "key long, n_words long, n_removed long, kept string", rows, batch=512)
    ids = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("key"))
    return ids.join(done, "key").select(F.col("doc_id").alias(doc_id), "n_words", "n_removed", "kept")


def sql(window: int = 35) -> str:
    """The removals as SQL over `documents`, from all windows of all texts."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), g AS (
  SELECT r, k, array_to_string(words[k : k + {window - 1}], ' ') AS gram FROM d, unnest(range(1, len(words) - {window - 2})) AS t(k)
), gone AS (
  SELECT DISTINCT r, j FROM (SELECT r, k FROM g QUALIFY count(*) OVER (PARTITION BY gram) > 1), unnest(range(k, k + {window})) AS t(j)
), w AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM d
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS body FROM w ANTI JOIN gone USING (r, j) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
