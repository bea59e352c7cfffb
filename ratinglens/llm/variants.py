"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

A word's vector counts its letters. One edit changes it little: an inserted or deleted letter gives a squared distance of
one, a replaced letter two. Words are blocked by length and by how many of their letters fall into each of GROUPS classes
of letters. An edit raises one class by one, lowers one, or moves one letter from a class to another, so near words lie in
the same block or in adjacent ones of the same or the next length. In a task one block of words meets itself and the words that
visit from adjacent blocks: a NumPy product of the two count matrices gives all squared distances, pairs at most two
apart are kept, and the edit is verified on the letters. Blocks over CHUNK words are split into chunks; a word
goes to all chunks of a block, so no task holds more than one chunk and one batch of visitors, and no pair is lost.

A worker folds the near pairs of a chunk into one row a word (number, best partner) before the shuffle. Pointers to the
preferred form are doubled until they stand still: counts at least double along a chain, so that takes few rounds.

Null and empty texts have no words, an id of null counts as the empty text where letters are dropped, and repeated rows
count each. Of equally frequent near words the smallest in code-point order is taken. An empty table gives an empty
result. Other columns of the table are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.llm.common import map_rows
from ratinglens.session import staged

#: A word needs so many code points and occurrences.
MIN_LENGTH, MIN_COUNT = 5, 3
#: One run in so many loses a letter, by the checksum of its document and itself.
DROP_EVERY = 97
#: A preferred form is at least so many times as frequent.
FORM_RATIO = 2
#: Classes of letters in a block's key.
GROUPS = 5
#: Words of a block in one task at most, and visitors that meet them at a time.
CHUNK, VISITORS = 2048, 4096
#: Different words that a worker counts before it passes them on.
REMEMBERED = 400_000
#: Up to this length the products of letter counts are exact in single precision.
_SINGLE = 2000

# Latin-1 bytes: A-Z becomes lower case, a-z and from 0xC0 on stay, all others are blanks
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))
#: Number of each letter: a to z, then U+00C0 to U+00FF.
_NUMBER = np.array([b - 97 if 97 <= b <= 122 else b - 166 if b >= 192 else 0 for b in range(256)])
_ALPHABET = 90


def runs(text: str | None) -> list[bytes]:
    """Runs of letters in Latin-1, lower-cased in A-Z; other characters than Latin-1 separate."""
    return [] if text is None else text.encode("latin-1", "replace").translate(_LETTERS).split()


def thinned(doc_id: object, run: bytes) -> bytes:
    """The run, without one letter if DROP_EVERY divides the checksum of its document and itself."""
    body = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(body, zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode()))
    if h % DROP_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, doc_id: str, text: str, min_length: int, min_count: int) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences; each task sums its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for b in batches:
            for own_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for word, n in Counter(r for r in runs(body) if len(r) >= min_length).items():
                    if len(word := thinned(own_id, word)) >= min_length:
                        held[word] += n
                if len(held) >= REMEMBERED:
                    yield pack(held)
                    held = Counter()
        yield pack(held)

    def pack(held: Counter[bytes]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], type=pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), type=pa.int64())], names=["word", "n"])

    counted = docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _blocks(words: list[bytes]) -> np.ndarray:
    """How many letters of each class each word has."""
    sizes = np.array([len(w) for w in words])
    letters = _NUMBER[np.frombuffer(b"".join(words), dtype=np.uint8)]
    cells = np.repeat(np.arange(len(words)) * GROUPS, sizes) + letters % GROUPS
    return np.bincount(cells, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def dealt(words: DataFrame) -> DataFrame:
    """(block, home, word, n): each word at home in its block, and once for each adjacent block that it visits.

    Of two adjacent blocks, words visit that of shorter words, or of equal lengths that with the lesser first class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            own = _blocks([w.encode("latin-1") for w in b.column(0).to_pylist()])
            yield pack(b, own, np.arange(len(own)), True)
            for i in range(GROUPS):
                has = np.flatnonzero(own[:, i])
                step = own[has]
                step[:, i] -= 1
                yield pack(b, step, has, False)
                for j in range(i + 1, GROUPS):
                    other = step.copy()
                    other[:, j] += 1
                    yield pack(b, other, has, False)

    def pack(b: pa.RecordBatch, blocks: np.ndarray, rows: np.ndarray, home: bool) -> pa.RecordBatch:
        ends = np.arange(len(rows) + 1, dtype=np.int32) * (4 * GROUPS)
        keys = pa.Array.from_buffers(
            pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(blocks.astype("<u4").tobytes())]
        )
        columns = [keys, pa.array(np.full(len(rows), home)), b.column(0).take(rows), b.column(1).take(rows)]
        return pa.RecordBatch.from_arrays(columns, names=["block", "home", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "block binary, home boolean, word string, n long")


class Words:
    """Words of one length with their counts and letter-count vectors."""

    def __init__(self, words: list[bytes], counts: list[int]):
        self.words, self.n, self.length = words, np.array(counts, dtype=np.int64), len(words[0])
        self.codes = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), self.length)
        cells = np.arange(len(words))[:, None] * _ALPHABET + _NUMBER[self.codes]
        kind = np.float32 if self.length <= _SINGLE else np.float64
        self.vectors = np.bincount(cells.ravel(), minlength=len(words) * _ALPHABET).reshape(-1, _ALPHABET).astype(kind)
        self.squares = (self.vectors**2).sum(axis=1)
        # place among these by falling count, then code points
        self.order = np.lexsort((np.array(words), -self.n))
        self.place = np.argsort(self.order)


def near_pairs(home: Words, other: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of words one edit apart; other has words of the same length or of one more, or is home itself."""
    distance = home.vectors @ other.vectors.T
    distance *= -2
    distance += home.squares[:, None]
    distance += other.squares
    i, j = np.nonzero(distance <= 2.5)
    if other is home:
        i, j = i[i < j], j[i < j]
    found = [verified(home, other, i[at : at + 65536], j[at : at + 65536]) for at in range(0, len(i), 65536)]
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (i, j)


def verified(home: Words, other: Words, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = home.codes[i], other.codes[j]
    if home.length == other.length:
        good = (a != b).sum(axis=1) == 1
    else:  # what agrees from the front and from the back covers the shorter word
        front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
        back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        good = front + back >= home.length
    return i[good], j[good]


def _folded(own: Words, other: Words, i: np.ndarray, j: np.ndarray) -> Iterable[tuple]:
    """(word, number of near words, count of the best, the best) for the words of `own` in pairs (i, j)."""
    number = np.bincount(i, minlength=len(own.words))
    best = np.full(len(own.words), len(other.words))
    np.minimum.at(best, i, other.place[j])
    for k in np.flatnonzero(number).tolist():
        top = other.order[best[k]]
        yield own.words[k].decode("latin-1"), int(number[k]), int(other.n[top]), other.words[top].decode("latin-1")


def _of_chunk(home: Words, visitors: dict[int, list[tuple]]) -> Iterable[tuple]:
    for rows in visitors.values():
        other = Words([w for w, _ in rows], [n for _, n in rows])
        i, j = near_pairs(home, other)
        if len(i):
            yield from _folded(home, other, i, j)
            yield from _folded(other, home, j, i)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best) for each of the words (word, n) that has near words; best has its count negated as `n`."""
    rows = dealt(words)
    large = rows.where("home").groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > CHUNK)
    # a written table has a known size: Spark broadcasts it only if it is small
    large = staged(large.select("block", F.ceil(F.col("size") / CHUNK).alias("k")), "large-blocks")
    own = F.pmod(F.xxhash64("word"), F.col("k"))
    chunks = F.sequence(F.when(F.col("home"), own).otherwise(F.lit(0).cast("long")), F.col("k") - 1)
    met = (
        rows.join(large, "block", "left")
        .withColumn("k", F.coalesce("k", F.lit(1).cast("long")))
        .withColumn("chunk", F.explode(chunks))
        .select("block", "chunk", (~F.col("home") | (F.col("chunk") != own)).alias("visits"), "word", "n")
    )
    ordered = met.repartition("block", "chunk").sortWithinPartitions("block", "chunk", "visits")

    def found(source: Iterable[tuple]) -> Iterable[tuple]:
        place, held, home, visitors = None, [], None, {}
        for block, chunk, visits, word, n in source:
            if (block, chunk) != place:
                yield from ended(held, home, visitors)
                place, held, home, visitors = (block, chunk), [], None, {}
            code = word.encode("latin-1")
            if not visits:
                held.append((code, n))
            elif held or home:
                if home is None:
                    home, held = Words(*map(list, zip(*held, strict=True))), []
                    yield from _at_home(home)
                same = visitors.setdefault(len(code), [])
                same.append((code, n))
                if len(same) >= VISITORS:
                    yield from _of_chunk(home, {0: same})
                    del visitors[len(code)]
        yield from ended(held, home, visitors)

    def ended(held: list[tuple], home: Words | None, visitors: dict) -> Iterable[tuple]:
        if held:
            yield from _at_home(Words(*map(list, zip(*held, strict=True))))
        elif home:
            yield from _of_chunk(home, visitors)

    parts = map_rows(ordered, "word string, number long, best_n long, best string", found)
    return parts.groupBy("word").agg(
        F.sum("number").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    )


def _at_home(home: Words) -> Iterable[tuple]:
    i, j = near_pairs(home, home)
    if len(i):
        yield from _folded(home, home, np.concatenate((i, j)), np.concatenate((j, i)))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the chain of forms. Each round doubles the steps of every pointer."""
    steps = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = staged(steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "forms")
        if new.where("further is not null").isEmpty():
            return new.select("word", "root")
        steps = new.select("word", "root")


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the texts.

    form is the most frequent near word if it is at least FORM_RATIO times as frequent, root the end of the chain of
    forms from the word (itself without a form).
    """
    if min_length < 1:
        raise ValueError("min_length from 1")
    words = staged(word_counts(docs, doc_id, text, min_length, min_count), "words")
    best_n = -F.col("best.n")
    judged = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(best_n >= FORM_RATIO * F.col("n"), F.struct(F.col("best.word").alias("word"), best_n.alias("n"))).alias("form"),
    )
    judged = staged(judged.select("word", F.col("form.word").alias("form"), "n", "n_near", F.col("form.n").alias("form_n")), "judged")
    ends = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
