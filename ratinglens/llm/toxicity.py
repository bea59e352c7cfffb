"""Toxicity by compression distance: two zstandard dictionaries, one fitted on toxic and one on ordinary text.

A window is one word with its borders, set behind a carrier that both dictionaries hold, so that even a short window is
coded and not stored. Its two lengths, less those of the bare carrier, form a cell. Weights of the cells are the log-odds
of a window of toxic text falling there, from all windows of labelled rows that the measuring dictionaries have not seen;
only a cell that the toxic dictionary codes shorter may speak for toxicity. A document takes the mean weight of all its
windows, repeated ones too, so its length does not matter but how much of it leans to toxic text; the calibrated threshold
becomes a score of 0.5. STEADY windows of ordinary weight are added, so that a few words do not decide alone.

The toxic dictionary holds words whose 5-letter parts make up a far larger share of toxic text; the other one holds the
most frequent words of ordinary text.

Null and empty texts have no windows and score like ordinary text. Without toxic labels every
score is 0. Rows are scored one by one: repeated rows and null ids change nothing; a null label is no label.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections import Counter

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.llm.common import add_columns, map_rows
from ratinglens.llm.sampling import labelled_sample

#: Labelled documents used for fitting: toxic and ordinary ones at most.
TOXIC_ROWS, ORDINARY_ROWS = 2_000, 4_000
TOXIC_BYTES, ORDINARY_BYTES = 8_192, 32_768
PART = 5
#: A part marks toxic text if it has this share of the toxic windows (three at least) and so many times the share that it has
#: of ordinary ones; a word with such a part enters the dictionary if the same contrast holds for it.
PART_SHARE, CONTRAST = 5e-5, 10
#: Windows of ordinary weight added to each document, and the score's steepness.
STEADY, SLOPE = 10, 40
#: Counts that a task holds at a time.
HELD = 200_000
#: Lengths from here on are taken together.
LONGEST = 63
#: Windows that a worker remembers in each of two generations.
REMEMBERED = 150_000
CARRIER = b"window of text to be measured by its compressed length: "
_EDGES = ".,!?|:;\"'()[]{}*#$%&-"

_SETTINGS = dict(window_log=17, chain_log=13, hash_log=13, search_log=5, min_match=3, target_length=64)


def windows(text: str | None) -> list[str]:
    return [w.strip(_EDGES) for w in (text or "").lower().split()]


def _parts(window: str) -> list[str]:
    bordered = f" {window} "
    return [bordered[i : i + PART] for i in range(max(1, len(bordered) - PART + 1))]


class Lengths:
    """The compressed lengths of a window under both dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        settings = zstandard.ZstdCompressionParameters(
            **_SETTINGS,
            strategy=zstandard.STRATEGY_BTULTRA,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        self.coders = []
        for content in (ordinary, toxic):
            held = zstandard.ZstdCompressionDict(content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=settings)
            self.coders.append(zstandard.ZstdCompressor(dict_data=held, compression_params=settings))
        self.bare = [len(c.compress(CARRIER)) for c in self.coders]

    def cell(self, window: str) -> tuple[int, int]:
        body = CARRIER + f" {window} ".encode("utf-8", "surrogatepass")
        (ordinary_coder, toxic_coder), (ordinary_bare, toxic_bare) = self.coders, self.bare
        ordinary, toxic = len(ordinary_coder.compress(body)) - ordinary_bare, len(toxic_coder.compress(body)) - toxic_bare
        return min(ordinary, LONGEST), min(toxic, LONGEST)


class Model:
    def __init__(self, toxic: bytes, ordinary: bytes, weights: dict[tuple[int, int], float], usual: float, threshold: float):
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights
        self.usual, self.threshold = usual, threshold

    def scorer(self):
        lengths, known, older = Lengths(self.toxic, self.ordinary), {}, {}

        def score(text: str | None) -> float:
            nonlocal known, older
            total, n = STEADY * self.usual, STEADY
            counts = Counter(windows(text))
            weights = list(map(known.get, counts))
            if None in weights:
                for k, w in enumerate(counts):
                    if weights[k] is None:
                        if (weight := older.get(w)) is None:
                            weight = self.weights.get(lengths.cell(w), 0.0)
                        weights[k] = known[w] = weight
            for weight, times in zip(weights, counts.values(), strict=True):
                total += weight * times
                n += times
            if len(known) > REMEMBERED:  # windows met again soon come over from the older generation
                older, known = known, {}
            return 1 / (1 + math.exp(min(SLOPE * (self.threshold - total / n), 700)))

        return score


def _dictionary(words: Counter, size: int) -> bytes:
    """The most frequent words, the best ones last, where a match costs least."""
    chosen, used = [], 0
    for word, _ in sorted(words.items(), key=lambda x: (-x[1], x[0])):
        entry = f" {word} ".encode("utf-8", "surrogatepass")
        if used + len(entry) <= size:
            chosen.append(entry)
            used += len(entry)
    return b"".join(reversed(chosen))


def fit(rows: list[tuple[str, str]]) -> Model | None:
    """A model from (text, label) rows in memory, label "1" being toxic; None without toxic or without ordinary rows."""
    toxic, ordinary = ([Counter(windows(t)) for t, y in rows if y == mark] for mark in ("1", "0"))
    if not toxic or not ordinary:
        return None
    halves = [(toxic[k::2], ordinary[k::2]) for k in (0, 1)]
    if not all(map(len, (*halves[0], *halves[1]))):
        halves = [(toxic, ordinary)] * 2
    # each half's windows are measured by dictionaries made of the other half
    met = [[_cells(Lengths(*_dictionaries(*map(_sum, halves[1 - k]))), part) for part in halves[k]] for k in (0, 1)]
    weights, usual, threshold = calibrate(met[0][0] + met[1][0], met[0][1] + met[1][1])
    return Model(*_dictionaries(_sum(toxic), _sum(ordinary)), weights, usual, threshold)


def calibrate(toxic: list[Counter], ordinary: list[Counter]) -> tuple[dict[tuple[int, int], float], float, float]:
    """(weight of each cell, mean weight of ordinary windows, threshold) from the cells of each document."""
    in_toxic, in_ordinary = _sum(toxic), _sum(ordinary)
    n_toxic, n_ordinary = in_toxic.total(), in_ordinary.total()
    weights = {
        c: math.log((in_toxic[c] + 0.5) / (n_toxic + 1) * (n_ordinary + 1) / (in_ordinary[c] + 0.5)) for c in in_toxic | in_ordinary
    }
    weights = {c: w if c[1] < c[0] else min(w, 0.0) for c, w in weights.items()}
    usual = sum(weights[c] * n for c, n in in_ordinary.items()) / max(1, n_ordinary)

    def mean(cells: Counter) -> float:
        return (STEADY * usual + sum(weights[c] * n for c, n in cells.items())) / (STEADY + cells.total())

    best = sorted((mean(cells), k == 0) for k, group in enumerate((toxic, ordinary)) for cells in group)
    # the cut with the fewest errors, in the middle of its gap
    wrong = least = sum(not y for _, y in best)
    threshold = best[0][0] - 1
    for k, (value, is_toxic) in enumerate(best):
        wrong += 1 if is_toxic else -1
        after = best[k + 1][0] if k + 1 < len(best) else value + 2 / SLOPE
        if after > value and wrong < least:
            least, threshold = wrong, (value + after) / 2
    return weights, usual, threshold


def _sum(counts: list[Counter]) -> Counter:
    out: Counter = Counter()
    for c in counts:
        out.update(c)
    return out


def _dictionaries(words: Counter, usual: Counter) -> tuple[bytes, bytes]:
    """The contents of the toxic and of the ordinary dictionary, from the windows of toxic and of ordinary text."""
    scale, enough = usual.total() / max(1, words.total()), max(3, PART_SHARE * words.total())
    in_toxic, in_ordinary = _part_counts(words), _part_counts(usual)
    telling = {p for p, n in in_toxic.items() if n >= enough and n * scale >= CONTRAST * (in_ordinary[p] + 0.5)}
    marked = {w for w, n in words.items() if n * scale >= CONTRAST * usual[w] and not telling.isdisjoint(_parts(w))}
    return (
        _dictionary(Counter({w: words[w] for w in marked}), TOXIC_BYTES),
        _dictionary(Counter({w: n for w, n in usual.items() if w not in marked}), ORDINARY_BYTES),
    )


def _part_counts(words: Counter) -> Counter:
    """Windows that hold each part."""
    out: Counter = Counter()
    for w, n in words.items():
        for p in set(_parts(w)):
            out[p] += n
    return out


def _cells(lengths: Lengths, texts: list[Counter]) -> list[Counter]:
    """How many windows of each text fall in each cell."""
    cell, out = functools.cache(lengths.cell), []
    for words in texts:
        cells: Counter = Counter()
        for w, n in words.items():
            cells[cell(w)] += n
        out.append(cells)
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """Fit on a bounded sample of the labelled rows given; leave held-out rows out of `labels`."""
    sample = labelled_sample(docs, labels, label, {"1": TOXIC_ROWS, "0": ORDINARY_ROWS}, doc_id, text)
    sample = sample.select(F.expr("cast(label = '1' as int) toxic"), F.expr("(place - 1) % 2 half"), "text").persist()
    try:
        return _fit_sample(sample)
    finally:
        sample.unpersist()


def _fit_sample(sample: DataFrame) -> Model | None:
    """The model that fit() gives, from (toxic, half, text) rows: texts are read in tasks, counts come to the driver."""
    there = {(r["toxic"], r["half"]) for r in sample.select("toxic", "half").distinct().collect()}
    if len({toxic for toxic, _ in there}) < 2:
        return None
    found = map_rows(sample, "toxic int, half int, word string, n long", _count_words)
    sums = [F.sum(F.when((F.col("toxic") == t) & (F.col("half") == h), F.col("n")).otherwise(0)).alias(f"n{t}{h}") for t in (1, 0) for h in (0, 1)]
    words = found.groupBy("word").agg(*sums).persist()
    names = words.columns[1:]
    try:
        totals = words.agg(*(F.coalesce(F.sum(n), F.lit(0)) for n in names)).first()
        # toxic and ordinary counts of each half and of both
        sides = [("n10", "n00", totals[0], totals[2]), ("n11", "n01", totals[1], totals[3])]
        sides.append(("n10 + n11", "n00 + n01", totals[0] + totals[1], totals[2] + totals[3]))
        parts = map_rows(words, f"word string, {', '.join(f'{n} long' for n in names)}", _count_parts)
        parts = parts.groupBy("word").agg(*(F.sum(n).alias(n) for n in names))
        contents = [_contents(words, parts, *side) for side in (sides if len(there) == 4 else sides[2:])]
    finally:
        words.unpersist()
    measures = contents[1::-1] if len(there) == 4 else contents * 2

    def measured(rows):
        for toxic, half, text in rows:
            cell, cells = _remembered_cell(*measures[half]), Counter()
            for w, n in Counter(windows(text)).items():
                cells[cell(w)] += n
            yield toxic, pickle.dumps(cells)

    met = [(r["toxic"], pickle.loads(r["cells"])) for r in map_rows(sample, "toxic int, cells binary", measured).collect()]
    weights, usual, threshold = calibrate(*([cells for t, cells in met if t == kind] for kind in (1, 0)))
    return Model(*contents[-1], weights, usual, threshold)


def _contents(words: DataFrame, parts: DataFrame, toxic: str, ordinary: str, n_toxic: int, n_ordinary: int) -> tuple[bytes, bytes]:
    """What _dictionaries() gives, from the counts of words and parts; the driver gets no more than fits."""
    scale, enough = n_ordinary / max(1, n_toxic), max(3, PART_SHARE * n_toxic)
    contrast = f"({toxic}) * {scale!r}D >= {CONTRAST} * (({ordinary}) + 0.5D) and ({toxic}) >= {enough!r}"
    telling = {r["word"] for r in parts.where(contrast).select("word").collect()}
    counts = words.select("word", F.expr(toxic).alias("t"), F.expr(ordinary).alias("o"))

    def mark(rows):
        for w, t, o in rows:
            is_marked = t > 0 and t * scale >= CONTRAST * o and not telling.isdisjoint(_parts(w))
            if (n := t if is_marked else o) > 0:
                yield w, int(is_marked), n

    chosen = map_rows(counts, "word string, marked int, n long", mark)
    out = []
    for marked, size in ((1, TOXIC_BYTES), (0, ORDINARY_BYTES)):
        fitting = chosen.where((F.col("marked") == marked) & (F.octet_length("word") + 2 <= size))
        top = fitting.orderBy(F.desc("n"), "word").limit(size // 2).collect()  # an entry has two bytes at least
        out.append(_dictionary(Counter({r["word"]: r["n"] for r in top}), size))
    return out[0], out[1]


def _count_words(rows):
    held: Counter = Counter()
    for toxic, half, text in rows:
        for w, n in Counter(windows(text)).items():
            held[toxic, half, w] += n
        if len(held) > HELD:
            yield from ((*key, n) for key, n in held.items())
            held.clear()
    yield from ((*key, n) for key, n in held.items())


def _count_parts(rows):
    held: dict = {}
    for word, *counts in rows:
        for p in set(_parts(word)):
            held[p] = [a + b for a, b in zip(held[p], counts, strict=True)] if p in held else counts
        if len(held) > HELD:
            yield from ((p, *n) for p, n in held.items())
            held.clear()
    yield from ((p, *n) for p, n in held.items())


@functools.lru_cache(maxsize=2)
def _remembered_cell(toxic: bytes, ordinary: bytes):
    """The cell of a window, with the cells of earlier tasks of the same Python worker remembered."""
    return functools.lru_cache(REMEMBERED)(Lengths(toxic, ordinary).cell)


@functools.lru_cache(maxsize=1)
def _scorer(model: bytes):
    _remembered_cell.cache_clear()  # fitting is over
    return pickle.loads(model).scorer()


def score_toxicity(docs: DataFrame, model: Model | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add score (0 to 1) and predicted (1 if the score is at least 0.5) to each row."""
    packed = pickle.dumps(model)

    def values(texts: list) -> list[tuple]:
        score = _scorer(packed) if model else lambda text: 0.0
        return [(s, int(s >= 0.5)) for s in map(score, texts)]

    return add_columns(docs, text, "score double, predicted int", values, keep_text)
