"""License scan: an Aho-Corasick automaton over normalised words, and license expressions read by a shunting yard.

Null and empty texts have no words: counts 0, null positions, empty label strings, score 0. Repeated rows and ids are
scanned one by one. The whole text is scanned; places may overlap.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
from pyspark.sql import DataFrame

from ratinglens.llm.common import add_columns, plain_words

#: Phrases whose places are counted, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Further notices by their words, the label each names, and how sure it is.
NOTICES = {
    "permission is hereby granted free of charge": ("mit", 0.9),
    "licensed under the apache license version 2 0": ("apache-2.0", 0.95),
    "gnu lesser general public license": ("lgpl", 0.95),
    "gnu affero general public license": ("agpl", 0.95),
    "general public license version 2": ("gpl-2.0", 0.9),
    "general public license version 3": ("gpl-3.0", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd 2 clause": ("bsd-2-clause", 0.9),
    "bsd 3 clause": ("bsd-3-clause", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "cc by 4 0": ("cc-by-4.0", 0.9),
    "cc by sa 4 0": ("cc-by-sa-4.0", 0.9),
    "cc by nc 4 0": ("cc-by-nc-4.0", 0.9),
    "cc by nd 4 0": ("cc-by-nd-4.0", 0.9),
    "cc by nc sa 4 0": ("cc-by-nc-sa-4.0", 0.9),
    "cc0 1 0": ("cc0-1.0", 0.9),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.95),
    "all rights reserved": ("all-rights-reserved", 0.4),
}
BASE_SURE, TAG_SURE = 0.8, 0.99
TAG = "spdx license identifier"

#: Identifiers whose terms ask for no more than attribution, as an expression is judged by.
PERMISSIVE = frozenset(
    "mit mit-0 apache-2.0 bsd-2-clause bsd-3-clause 0bsd isc zlib unlicense cc0-1.0 cc-by-4.0 bsl-1.0".split()
)

_TAG_LINE = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.ASCII)
_TOKEN = re.compile(r"[a-z0-9][a-z0-9.+:-]*|[()]")
_BINDS = {"with": 3, "and": 2, "or": 1}


def postfix(tokens: list[str]) -> list[str] | None:
    """Operands and operators in postfix order, or None if the expression is malformed."""
    out: list[str] = []
    waiting: list[str] = []
    operand = True  # what may come next
    for token in tokens:
        if token == "(":
            if not operand:
                return None
            waiting.append(token)
        elif token == ")":
            if operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif token in _BINDS:
            if operand:
                return None
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def read_tag(rest: str) -> tuple[set[str], bool] | None:
    """What the longest well-formed expression at the start of a tag's line tells; other text may follow it.

    Full stops and the like after an identifier belong to the sentence.
    """
    tokens = [t.rstrip(".:+-") + "+" * t.endswith("+") if t not in "()" else t for t in _TOKEN.findall(rest.lower())]
    # an operand that follows an operand ends the expression; operators and open parentheses without an end are dropped
    depth, operand, best = 0, True, 0
    for k, token in enumerate(tokens):
        if token == "(" and operand:
            depth += 1
        elif token == ")" and not operand and depth:
            depth -= 1
        elif token in _BINDS and not operand:
            operand = True
        elif token not in _BINDS and token not in "()" and operand:
            operand = False
        else:
            break
        if not operand and not depth:
            best = k + 1
    return _read(tokens[:best])


def read_expression(expression: str) -> tuple[set[str], bool] | None:
    """The licences an expression names and whether it can be met by permissive ones alone; None if malformed.

    `A with E` names licence A under exception E and is as permissive as A.
    """
    return _read(_TOKEN.findall(expression.lower()))


def _read(tokens: list[str]) -> tuple[set[str], bool] | None:
    order = postfix(tokens)
    if order is None:
        return None
    stack: list[tuple[set[str], bool]] = []
    for token in order:
        if token in _BINDS:
            (right, right_ok), (left, left_ok) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, left_ok))
            else:
                stack.append((left | right, left_ok or right_ok if token == "or" else left_ok and right_ok))
        else:
            stack.append(({token}, token in PERMISSIVE))
    return stack[0]


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        machine.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    machine.make_automaton()
    return machine


def scan(text: str | None) -> tuple:
    """Counts, positions, labels and score of one text, in the order of SCHEMA."""
    words = plain_words(text)
    body = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    n_base, first, last, ended, upto = 0, None, None, 0, 0
    base: set[str] = set()
    sure: dict[str, float] = {}
    tagged = False
    for end, (phrase, length) in _automaton().iter(body):
        ended += body.count(" ", upto, end + 1)  # words that end up to here, plus one
        upto = end + 1
        if phrase in BASE:
            start = ended - 1 - length
            n_base += 1
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
            base.add(BASE[phrase])
            sure[BASE[phrase]] = max(sure.get(BASE[phrase], 0), BASE_SURE)
        elif phrase == TAG:
            tagged = True
        else:
            label, by = NOTICES[phrase]
            sure[label] = max(sure.get(label, 0), by)
    permissive = None
    if tagged:
        for expression in _TAG_LINE.findall(text.lower()):
            if (read := read_tag(expression)) is not None:
                permissive = read[1] if permissive is None else permissive and read[1]
                sure |= dict.fromkeys(read[0], TAG_SURE)
    doubt = 1.0
    for by in sure.values():
        doubt *= 1 - by
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(sure)), permissive, 1 - doubt


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "permissive boolean, score double"
)


def scan_licenses(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add the findings of `scan` to each row; `permissive` judges tagged expressions and is null without one."""
    return add_columns(docs, text, SCHEMA, lambda texts: [scan(t) for t in texts], keep_text)
