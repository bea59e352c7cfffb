"""Benchmark decontamination with an FM-index per training shard.

A shard is one Arrow batch of documents. Its words become numbers of the benchmark's vocabulary; stretches that are
broken by a word outside the vocabulary, or shorter than the shortest test window, cannot hold a window and are left
out of the index, which is exact. The rest is sorted by suffixes, its Burrows-Wheeler transform is kept in a wavelet
matrix, all windows are searched backwards at once, and their places are found by walking to sampled suffix positions.

The distinct windows and their items are found by a Spark job and cut into blocks of a bounded number of windows. The
driver and the executors hold one block at a time; with several, each is searched in a pass of its own, and the places
and items of a text are merged by 128 bits of its hash.

Null texts and texts without words have no hits. Items without words have no window. Items with a null id mark words
but are not listed; repeated item rows and ids count once. An empty benchmark or document table gives no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import batched

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratinglens.llm.common import add_columns, map_rows, plain_words
from ratinglens.session import staged

WINDOW = 10
#: Distinct windows that the driver and the executors hold at a time, on average; more are searched pass after pass.
BLOCK_WINDOWS = 100_000
#: Texts of a shard where windows are searched pass after pass.
SHARD_TEXTS = 1_000
SAMPLED_EVERY = 16

_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@dataclass
class Windows:
    """The distinct windows of a block of items: numbered words, windows by length, and the items of each window."""

    words: dict[bytes, int] = field(default_factory=dict)
    by_length: dict[int, np.ndarray] = field(default_factory=dict)
    items: dict[int, list[list[str]]] = field(default_factory=dict)


def windows_of(rows: list[tuple[str, list[str]]]) -> Windows:
    """From (words joined by spaces, items) of each window."""
    out = Windows()
    found = [([out.words.setdefault(w, len(out.words) + 1) for w in window.encode().split(b" ")], items) for window, items in sorted(rows)]
    for width in sorted({len(numbers) for numbers, _ in found}):
        chosen = [(numbers, items) for numbers, items in found if len(numbers) == width]
        out.by_length[width] = np.array([numbers for numbers, _ in chosen], dtype=np.int64)
        out.items[width] = [items for _, items in chosen]
    return out


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(window, items): each distinct window with the sorted ids of its items, written to the shared folder."""

    def rows(source: Iterable[tuple]) -> Iterable[tuple]:
        for item, body in source:
            words = plain_words(body)
            width = min(size, len(words))
            for window in {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} if words else ():
                yield window.decode("utf-8", "replace"), item

    found = map_rows(benchmark.select(F.col(item_id).cast("string"), F.col(text)), "window string, item string", rows)
    return staged(found.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")), "benchmark-windows")


class WaveletMatrix:
    """Rank of a symbol before a place, in as many steps as a symbol has bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.zeros = bits, []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level) & 1
            self.zeros.append(np.concatenate(([0], np.cumsum(1 - ones))))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        start = np.zeros_like(place)
        for level, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            start = np.where(one, zeros[-1] + start - zeros[start], zeros[start])
            place = np.where(one, zeros[-1] + place - zeros[place], zeros[place])
        return place - start


class FmIndex:
    """Finds number sequences in a text of numbers; 0 separates stretches and is never part of a pattern."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        text = np.concatenate((text, [0])).astype(np.int64)
        order = suffix_order(text)
        self.last = text[order - 1]  # the symbol before each sorted suffix
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))))
        self.matrix = WaveletMatrix(self.last, max(1, int(n_symbols).bit_length()))
        # a walk ends at the latest where a stretch starts, so it never has to step over a separator
        sampled = (order % SAMPLED_EVERY == 0) | (self.last == 0)
        self.sampled = sampled
        self.sample_at = np.cumsum(sampled) - 1
        self.samples = order[sampled]
        self.size = len(text)

    def step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.matrix.rank(symbol, place)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, place in the text) of every occurrence of patterns of one length."""
        alive = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.size, dtype=np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, column]
            low, high = self.step(symbol, low), self.step(symbol, high)
            some = high > low
            alive, low, high = alive[some], low[some], high[some]
        found = high - low
        pattern = np.repeat(alive, found)
        row = np.repeat(low - np.concatenate(([0], np.cumsum(found)[:-1])), found) + np.arange(found.sum())
        return pattern, self.locate(row)

    def locate(self, row: np.ndarray) -> np.ndarray:
        place = np.zeros(len(row), dtype=np.int64)
        walking, steps = np.arange(len(row)), 0
        while len(walking):
            done = self.sampled[row]
            place[walking[done]] = self.samples[self.sample_at[row[done]]] + steps
            walking, row, steps = walking[~done], row[~done], steps + 1
            row = self.step(self.last[row], row)
        return place


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in sorted order; separators (0) differ by their place, so no comparison passes one."""
    n = len(text)
    cuts = text == 0
    rank = np.where(cuts, np.cumsum(cuts) - 1, text + cuts.sum())
    width = 1
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: max(0, n - width)] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


def search_shard(texts: list, block: Windows) -> list[tuple[int, np.ndarray, list[str]]]:
    """Per text: its number of words, the places of its hit words, and the items found."""
    lengths = np.array([len(plain_words(t)) for t in texts], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    cover = np.zeros(starts[-1] + 1, dtype=np.int64)
    items: list[set[str]] = [set() for _ in texts]
    numbers = np.zeros(starts[-1], dtype=np.int32)
    get = block.words.get
    for k, t in enumerate(texts):
        numbers[starts[k] : starts[k + 1]] = [get(w, 0) for w in plain_words(t)]
    text, at = stretches(numbers, starts, min(block.by_length, default=1))
    if len(text):
        index = FmIndex(text, len(block.words))
        for width, patterns in block.by_length.items():
            pattern, place = index.search(patterns)
            begin = at[place]
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + width, -1)
            owner = np.searchsorted(starts, begin, side="right") - 1
            for pair in np.unique(np.stack((owner, pattern), axis=1), axis=0):
                items[pair[0]].update(block.items[width][pair[1]])
    hit = np.cumsum(cover[:-1]) > 0
    return [
        (int(lengths[k]), np.flatnonzero(hit[starts[k] : starts[k + 1]]), sorted(items[k])) for k in range(len(texts))
    ]


def stretches(numbers: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of known words of one text, at least so long, each closed by a 0; and the place of each symbol."""
    known = numbers > 0
    opens = known.copy()
    opens[1:] &= ~known[:-1]
    inner = starts[(starts > 0) & (starts < len(numbers))]
    opens[inner] = known[inner]
    stretch = np.cumsum(opens) - 1
    place = np.flatnonzero(known)
    if not len(place):
        return np.zeros(0, dtype=np.int64), place
    sizes = np.bincount(stretch[place])
    place = place[sizes[stretch[place]] >= least]
    if not len(place):
        return np.zeros(0, dtype=np.int64), place
    ends = np.flatnonzero(np.concatenate((stretch[place][1:] != stretch[place][:-1], [True]))) + 1
    text = np.insert(numbers[place].astype(np.int64), ends, 0)
    at = np.insert(place, ends, -1)
    return text, at


def _blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> Iterator[tuple[int, Broadcast]]:
    """(number of blocks, one of them), one after the other; the driver holds one block of windows at a time."""
    table = benchmark_windows(benchmark, item_id, text, size)
    n = max(1, -(-table.count() // BLOCK_WINDOWS))
    for k in range(n):
        rows = table.where(F.pmod(F.xxhash64("window"), F.lit(n)) == k).collect()
        yield n, table.sparkSession.sparkContext.broadcast(windows_of([(r["window"], r["items"]) for r in rows]))


def _keys(text: str) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(F.col(text)).alias("_a"), F.xxhash64(F.lit(1), F.col(text)).alias("_b")]


def _hits(docs: DataFrame, text: str, blocks: Iterator[tuple[int, Broadcast]], first: Broadcast) -> DataFrame:
    """(_a, _b, hit, items): places of the hit words and the items found, for each distinct text with hits in any block."""
    parts = []
    for block in _chained(first, blocks):

        def rows(source: Iterable[tuple], block: Broadcast = block) -> Iterable[tuple]:
            for batch in batched(source, SHARD_TEXTS):
                for (a, b, _), (_, hit, items) in zip(batch, search_shard([r[2] for r in batch], block.value), strict=True):
                    if len(hit):
                        yield a, b, hit.tolist(), items

        narrow = docs.where(F.col(text).isNotNull()).select(*_keys(text), F.col(text))
        parts.append(staged(map_rows(narrow, "_a long, _b long, hit array<int>, items array<string>", rows), "leaks"))
        block.unpersist()
    # copies of a text have equal lists, so a text has at most one of each block
    merged = reduce(DataFrame.unionByName, parts).groupBy("_a", "_b")
    return merged.agg(*(F.sort_array(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in ("hit", "items")))


def _chained(first: Broadcast, others: Iterator[tuple[int, Broadcast]]) -> Iterator[Broadcast]:
    yield first
    for _, block in others:
        yield block


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep_text: bool = True,
) -> DataFrame:
    """Add n_words, n_hit and item_ids (sorted, comma-joined), and n_items to each document.

    A window is `window` consecutive words of an item, or all words of a shorter item.
    """
    blocks = _blocks(benchmark, item_id, item_text, window)
    n, first = next(blocks)
    if n == 1:

        def values(texts: list) -> list[tuple]:
            found = search_shard(texts, first.value)
            return [(n, len(hit), len(items), ",".join(items)) for n, hit, items in found]

        return add_columns(docs, text, "n_words long, n_hit long, n_items long, item_ids string", values, keep_text)
    counted = add_columns(docs.withColumns({"_a": _keys(text)[0], "_b": _keys(text)[1]}), text, "n_words long", _numbers_of_words, keep_text)
    joined = counted.drop("n_hit", "n_items", "item_ids").join(_hits(docs, text, blocks, first), ["_a", "_b"], "left")
    numbers = {"n_hit": F.size("hit"), "n_items": F.size("items")}
    added = {name: F.coalesce(number, F.lit(0)).cast("long") for name, number in numbers.items()}
    found = joined.withColumns(added | {"item_ids": F.coalesce(F.array_join("items", ","), F.lit(""))})
    return found.drop("_a", "_b", "hit", "items")


def _numbers_of_words(texts: list) -> list[tuple]:
    return [(len(plain_words(t)),) for t in texts]


def without_words(text: str, hit: np.ndarray) -> str:
    """The text without the spans of its hit words; words next to each other go with what stands between them."""
    spans = [m.span() for m in _WORD.finditer(text)]
    kept, upto = [], 0
    breaks = np.flatnonzero(np.diff(hit) > 1) + 1
    for run in np.split(hit, breaks):
        kept.append(text[upto : spans[run[0]][0]])
        upto = spans[run[-1]][1]
    return "".join([*kept, text[upto:]])


def remove_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The documents with every word that a test window covers cut out of the text; other columns stay."""
    blocks = _blocks(benchmark, item_id, item_text, window)
    n, first = next(blocks)
    if n == 1:

        def values(texts: list) -> list[tuple]:
            found = search_shard(texts, first.value)
            return [(without_words(t, hit) if len(hit) else t,) for t, (_, hit, _) in zip(texts, found, strict=True)]

        return add_columns(docs, text, f"{text} string", values).select(*docs.columns)

    def cut(source: Iterable[tuple]) -> Iterable[tuple]:
        for a, b, body, hit in source:
            yield a, b, without_words(body, np.array(hit))

    keyed = docs.withColumns({"_a": _keys(text)[0], "_b": _keys(text)[1]})
    hits = _hits(docs, text, blocks, first).drop("items")
    texts = keyed.select("_a", "_b", F.col(text).alias("_body")).join(hits, ["_a", "_b"]).groupBy("_a", "_b").agg(
        F.first("_body").alias("_body"), F.first("hit").alias("hit")
    )
    found = map_rows(texts, "_a long, _b long, _cut string", cut)
    joined = keyed.join(found, ["_a", "_b"], "left").withColumn(text, F.coalesce("_cut", F.col(text)))
    return joined.select(*docs.columns)


def sql(window: int = WINDOW) -> str:
    """The findings for each document as SQL over `documents` and `benchmark`."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, {words} AS words FROM documents
), b AS (
  SELECT item_id, {words} AS words FROM benchmark
), w AS (
  SELECT DISTINCT item_id, least({window}, len(words)) AS m, words[k : k + least({window}, len(words)) - 1] AS g
  FROM b, unnest(range(1, len(words) - least({window}, len(words)) + 2)) AS t(k) WHERE len(words) > 0
), found AS (
  SELECT r, k, m, item_id FROM (
    SELECT r, k, m, words[k : k + m - 1] AS g
    FROM d, (SELECT DISTINCT m FROM w) AS widths, unnest(range(1, len(words) - m + 2)) AS t(k)
  ) JOIN w USING (g, m)
), hit AS (
  SELECT r, count(DISTINCT j) AS n FROM found, unnest(range(k, k + m)) AS t(j) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM found GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""
