"""Language identification in two steps: a family first, then one language of it.

Both steps are linear support vector machines on hashed character 1- to 3-grams of letters. Families are told apart one
against the rest; the languages of a family one against one, where each machine's margin counts for its winner. The
machines are fitted on whole texts of a bounded, documented sample of rows; prediction reads whole texts in Arrow batches.

A null text, or one without a letter, is `und` with score 0. Without a single learned language everything is
`und`; with one, every text with letters is of that language, with score 1. Rows are judged one by one, so repeated rows and
null ids change nothing; null labels are not learned.
"""

from __future__ import annotations

import functools
import pickle
import re
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame

from ratinglens.llm.common import add_columns, map_rows
from ratinglens.llm.sampling import labelled_sample

#: Training documents of each language at most, and training stretches of so many characters taken from each.
ROWS_PER_LANGUAGE, STRETCHES, STRETCH_CHARS = 400, 3, 240
UNDETERMINED = "und"

#: Language codes by family. Any other label is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb yi fy",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk",
    "semitic": "ar he mt am",
    "indic": "hi bn mr gu pa ur ne si",
    "iranian": "fa ps ku tg",
    "dravidian": "ta te kn ml",
    "sinitic": "zh yue wuu",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_BUCKETS = (1 << 11, 1 << 12, 1 << 13)
SIZE = sum(_BUCKETS)
_LETTER = re.compile(r"[^\W\d_]")
#: Code points of a text that are looked at together.
_BLOCK = 1 << 18


def family_of(language: str) -> str:
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], language)


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool)


def grams(text: str) -> np.ndarray:
    """The number of each hashed gram; what is not a letter counts as one separating sign."""
    counts = np.zeros(SIZE, dtype=np.float64)
    before = np.zeros(0, dtype=np.uint64)  # the last signs of the block before, whose grams reach into this one
    for at in range(0, len(text), _BLOCK):
        codes = np.frombuffer(text[at : at + _BLOCK].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = np.concatenate((before, np.where(_letters()[codes], codes, 0).astype(np.uint64)))
        codes = codes[np.concatenate(([True], (codes[1:] > 0) | (codes[:-1] > 0)))]
        mixed, base = np.zeros(len(codes), dtype=np.uint64), 0
        for order, size in enumerate(_BUCKETS):
            mixed = (mixed[: len(codes) - order] + codes[order:]) * np.uint64(0x9E3779B97F4A7C15) if len(codes) > order else mixed[:0]
            mixed = mixed ^ (mixed >> np.uint64(29))
            new = mixed[max(0, len(before) - order) :]  # grams within what was carried over are counted
            counts[base : base + size] += np.bincount((new >> np.uint64(13)).astype(np.int64) % size, minlength=size)
            mixed, base = mixed[:-1], base + size
        before = codes[-(len(_BUCKETS) - 1) :]
    return counts


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, values): gram counts of damped size, of length 1 together, and a constant at the last place."""
    counts = grams(text)
    at = np.flatnonzero(counts)
    values = np.sqrt(counts[at])
    norm = np.linalg.norm(values)
    return np.append(at, SIZE), np.append(values / norm if norm else values, 1.0)


def machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 10.0, rounds: int = 12) -> np.ndarray:
    """Weights of a linear support vector machine (hinge loss) by dual coordinate ascent; y is 1 or -1."""
    weights, alpha = np.zeros(SIZE + 1), np.zeros(len(rows))
    norms = [float(values @ values) for _, values in rows]
    order = np.random.default_rng(1)
    bound = {s: cost * len(y) / (2 * max(1, (y == s).sum())) for s in (1, -1)}  # both sides weigh the same
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            step = (1 - y[i] * (weights[at] @ values)) / norms[i]
            new = min(max(alpha[i] + step, 0.0), bound[y[i]])
            weights[at] += (new - alpha[i]) * y[i] * values
            alpha[i] = new
    return weights


class Model:
    """Weights for each family and for each pair of languages of a family."""

    def __init__(self, families: list[str], languages: dict[str, list[str]]):
        self.families, self.languages = families, languages
        self.pairs = [(f, a, b) for f in families for a, b in combinations(languages[f], 2)]
        self.weights = np.zeros((SIZE + 1, len(families) + len(self.pairs)))
        self.slope = 1.0
        #: The smallest score of a training stretch whose language was found.
        self.least = 0.0

    def _decide(self, margins: np.ndarray) -> tuple[str, float]:
        """(language, smallest margin by which it won)."""
        k = len(self.families)
        order = np.argsort(-margins[:k], kind="stable")
        family = self.families[order[0]]
        lead = (margins[order[0]] - margins[order[1]]) / 2 if k > 1 else np.inf
        votes = {name: [0, 0.0, np.inf] for name in self.languages[family]}
        for (f, a, b), m in zip(self.pairs, margins[k:], strict=True):
            if f == family:
                winner = votes[a if m >= 0 else b]
                winner[0] += 1
                winner[1] += abs(m)
                winner[2] = min(winner[2], abs(m))
        language = max(votes, key=lambda name: votes[name][:2])
        return language, float(min(lead, votes[language][2]))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        at, values = features(text)
        return self.decide(values @ self.weights[at])

    def decide(self, margins: np.ndarray) -> tuple[str, float]:
        """(language, score)."""
        language, margin = self._decide(margins)
        return language, 1.0 if np.isinf(margin) else float(1 / (1 + np.exp(-self.slope * margin)))


def _stretches(text: str) -> list[str]:
    """A training text and short parts of it, so that texts of any length are judged alike."""
    step = max(1, (len(text) - STRETCH_CHARS) // max(1, STRETCHES - 1))
    starts = sorted({min(k * step, max(0, len(text) - STRETCH_CHARS)) for k in range(STRETCHES)})
    return [s for s in (text, *(text[k : k + STRETCH_CHARS] for k in starts)) if _LETTER.search(s)]


def fit(texts: list[tuple[str, str]]) -> Model:
    """A model from (text, language) rows."""
    return fit_features([(features(s), language) for text, language in texts for s in _stretches(text)])


def fit_features(pairs: list[tuple[tuple[np.ndarray, np.ndarray], str]]) -> Model:
    """A model from (features, language) of the training stretches."""
    names = sorted({language for _, language in pairs})
    families = sorted({family_of(n) for n in names})
    model = Model(families, {f: [n for n in names if family_of(n) == f] for f in families})
    if len(names) < 2:
        return model
    rows = [found for found, _ in pairs]
    language = np.array([n for _, n in pairs])
    family = np.array([family_of(n) for n in language])
    columns = []
    for f in families:
        columns.append(machine(rows, np.where(family == f, 1, -1)) if len(families) > 1 else np.zeros(SIZE + 1))
        if len(families) == 2:
            columns.append(-columns[0])
            break
    for _, a, b in model.pairs:
        own = np.flatnonzero((language == a) | (language == b))
        columns.append(machine([rows[i] for i in own], np.where(language[own] == a, 1, -1)))
    model.weights = np.stack(columns, axis=1)
    model.slope = 4.0
    found = [model.decide(values @ model.weights[at]) for at, values in rows]
    model.least = min((score for (name, score), own in zip(found, language, strict=True) if name == own), default=0.0)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "lang", doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on at most ROWS_PER_LANGUAGE documents of each language in labels (doc_id, label)."""
    sample = labelled_sample(docs, labels, label, ROWS_PER_LANGUAGE, doc_id, text).select("label", "place", "text")
    # whole texts are read in the tasks; the driver gets features, whose number is bounded
    found = map_rows(sample, "label string, place int, part int, places binary, sizes binary", _stretch_features).collect()
    found.sort(key=lambda r: (r["place"], r["label"], r["part"]))
    return fit_features([((np.frombuffer(r["places"], np.int64), np.frombuffer(r["sizes"])), r["label"]) for r in found])


def _stretch_features(rows):
    for label, place, text in rows:
        for part, stretch in enumerate(_stretches(text)):
            at, values = features(stretch)
            yield label, place, part, at.astype(np.int64).tobytes(), values.tobytes()


@functools.lru_cache(maxsize=2)
def _loaded(model: bytes) -> Model:
    return pickle.loads(model)


def identify(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add lang_pred and score to each row."""
    weights, model.weights = model.weights, model.weights.astype(np.float32)
    packed = pickle.dumps(model)
    model.weights = weights

    def values(texts: list) -> list[tuple]:
        loaded = _loaded(packed)
        return [loaded.predict(t) for t in texts]

    return add_columns(docs, text, "lang_pred string, score double", values, keep_text)
