"""Token ids of whole texts by a tokenizer file, with the pieces of a text remembered inside a Python worker."""

from __future__ import annotations

import functools
import os
import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Pieces that a worker remembers in each of two generations.
REMEMBERED = 220_000
#: Characters of texts that are encoded together.
CHARS_AT_ONCE = 1 << 22
#: New pieces that are encoded as one text.
JOINED = 1_024

# A space before a visible character always starts a piece of its own for a byte-level vocabulary, and a line break is one.
_JOINS = re.compile(r" ?(?:[!-~]|\w)")
#: Signs of which a run is a token group of its own, or several, between an ASCII letter and the end of a piece.
_SIGNS = ".,!?|;:#*$%&"


def _among(chars: str) -> np.ndarray:
    """For each byte, whether it is one of these ASCII characters."""
    return np.isin(np.arange(256), list(chars.encode()))


_SPACE, _SIGN, _LETTER = _among(" \t\n\r\x0b\x0c"), _among(_SIGNS), _among(string.ascii_letters)
_VISIBLE = _among("".join(map(chr, range(33, 127))))
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


@functools.cache
def _word_characters() -> np.ndarray:
    """For each code point, whether it is matched by \\w."""
    return np.array([c.isalnum() or c == "_" for c in map(chr, range(0x110000))])


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points beyond ASCII that start at these places of UTF-8 bytes."""
    lead, *rest = (data[np.minimum(at + k, len(data) - 1)].astype(np.int64) for k in range(4))
    one, two, three = (b & 0x3F for b in rest)
    low = (lead & 0x1F) << 6 | one
    middle = (lead & 0x0F) << 12 | one << 6 | two
    return np.where(lead < 0xE0, low, np.where(lead < 0xF0, middle, (lead & 0x07) << 18 | one << 12 | two << 6 | three))


class PieceEncoder:
    """Encodes texts piece by piece; the ids equal those of the tokenizer on the whole text.

    A byte-level tokenizer cuts a text before each space that precedes a visible character, whatever stands
    around it. One that drops white space and case cuts it at white space. So pieces between such places are encoded
    alone, once; signs that end a piece are a piece apart from the word before them.

    The texts of a call are cut and put together as columns: only pieces that differ pass through Python.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.no_truncation()
        ids = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in (" a", "a", "A")]
        self.keeps_space, self.keeps_case = ids[0] != ids[1], ids[1] != ids[2]
        # byte-level vocabularies write each byte as one character
        vocabulary, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix or ""
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.id_bytes[number] = len(token.removesuffix(suffix))
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def pieces(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts in a row, and how many of them come before each text and after the last."""
        bodies = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        edges = np.cumsum([0, *map(len, bodies)])
        if self.keeps_space:
            starts = self._space_starts(data, edges)
        else:
            data, starts, edges = self._words(data, edges)
        run = _SIGN[data]
        run[1:] &= ~run[:-1]
        runs, ends = np.flatnonzero(run), np.append(np.flatnonzero(starts)[1:], len(data))
        ends = ends[_SIGN[data[ends - 1]]] if len(data) else ends[:0]
        # a run that goes on into further pieces starts in the first of them, so all their cuts are at the ends of pieces
        signs = runs[np.searchsorted(runs, ends) - 1]
        starts[signs[_LETTER[data[signs - 1]]]] = True
        cuts = np.append(np.flatnonzero(starts), len(data))
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, buffers), np.searchsorted(cuts, edges)

    def _space_starts(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where pieces start: before a space or a line break that precedes a visible character, and after that break."""
        gap = (data == 32) | (data == 10)
        gap[edges[1:][edges[1:] > 0] - 1] = False  # the next character is not of the same text
        starts = gap.copy()
        starts[:-1] &= _VISIBLE[data[1:]]
        wide = np.flatnonzero(gap[:-1] & (data[1:] >= 0x80))
        if len(wide):
            starts[wide] = _word_characters()[_code_points(data, wide + 1)]
        starts[1:] |= starts[:-1] & (data[:-1] == 10)
        starts[edges[edges < len(data)]] = True
        return starts

    def _words(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes without white space, where words start among them, and the edges of the texts there."""
        inside = ~_SPACE[data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        first = edges[edges < len(data)]
        starts[first] = inside[first]
        ends = edges.tolist()
        sizes = (np.count_nonzero(inside[a:b]) for a, b in zip(ends, ends[1:], strict=False))
        kept = data[inside]
        return kept if self.keeps_case else _LOWER[kept], starts[inside], np.cumsum([0, *sizes])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; none for a null."""
        pieces, edges = self.pieces(texts)
        if not len(pieces):
            return [b""] * len(texts)
        met = pieces.dictionary_encode()
        ids = self._looked_up(met.dictionary.to_numpy(zero_copy_only=False).tolist())
        _, offsets, packed = pa.array(ids, pa.large_binary()).take(met.indices).buffers()
        cuts, whole = np.frombuffer(offsets, dtype=np.int64)[edges].tolist(), memoryview(packed)
        return [bytes(whole[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def _looked_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of different pieces."""
        known, older = self.known, self.older
        found = list(map(known.get, pieces))
        missing = [p for p, ids in zip(pieces, found, strict=True) if ids is None]
        if missing:
            # all new pieces are known while these texts are put together; what is not to stay leaves after it
            new = [p for p in missing if p not in older]
            fresh = {p: older[p] for p in missing if p in older}
            fresh.update(zip(new, self._encoded(new), strict=True))
            known.update(fresh)
            found = list(map(known.__getitem__, pieces))
        if missing:
            for p in fresh if len(fresh) > REMEMBERED else [p for p in fresh if len(p) > 64]:
                del known[p]
        if len(known) > REMEMBERED:  # what is met again soon comes over from the older generation
            self.older, self.known = known, {}
        return found

    def encode_rows(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        """(key, ids) for each (key, text), encoded some texts at a time."""
        held: list[tuple] = []
        size = 0
        for row in rows:
            held.append(row)
            size += len(row[1] or "")
            if size >= CHARS_AT_ONCE:
                yield from zip([k for k, _ in held], self.encode([t for _, t in held]), strict=True)
                held, size = [], 0
        yield from zip([k for k, _ in held], self.encode([t for _, t in held]), strict=True)

    def _encoded(self, new: list[bytes]) -> list[bytes]:
        """The ids of new pieces."""
        texts = [p.decode("utf-8", "surrogatepass") for p in new]
        if self.keeps_space:
            spaced, bare, odd = [], [], []
            for t in texts:
                (odd if not _JOINS.match(t) else spaced if t[0] == " " else bare).append(t)
        else:
            spaced, bare, odd = texts, [], []
        found = dict(zip(odd, self._one_by_one(odd), strict=True))
        for way, own in ((self._together, spaced), (self._after_breaks, bare)):
            for at in range(0, len(own), JOINED):
                part = own[at : at + JOINED]
                found.update(zip(part, way(part), strict=True))
        return [found[t] for t in texts]

    def _one_by_one(self, bodies: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(bodies, add_special_tokens=False)]

    def _together(self, bodies: list[str]) -> list[bytes]:
        return self._as_one(bodies, "" if self.keeps_space else " ")

    def _after_breaks(self, bodies: list[str]) -> list[bytes]:
        """Pieces without a space before them, each after a line break, which has one id."""
        return [ids[4:] for ids in self._as_one(["\n" + b for b in bodies], "")]

    def _as_one(self, bodies: list[str], between: str) -> list[bytes]:
        """Encodes pieces as one text and cuts the ids where pieces end, by the bytes that each id stands for.

        If an end of a piece is not the end of an id, because a piece changes its length, the pieces are encoded one by one.
        """
        text = between.join(bodies)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        reached = np.cumsum(self.id_bytes[ids])
        ends = np.cumsum([len(b) if b.isascii() else len(b.encode("utf-8", "surrogatepass")) for b in bodies])
        at = np.searchsorted(reached, ends)
        if not len(ids) or reached[-1] != ends[-1] or (reached[at] != ends).any():
            return self._one_by_one(bodies)
        packed, cuts = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
        return [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder for each file and Python worker."""
    return PieceEncoder(path)


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file; only its name is part of a query."""
    import public_tokenizers

    return public_tokenizers.path(name)
