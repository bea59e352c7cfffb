"""Text and multi-value normalisation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratinglens.labels import PLACEHOLDERS

# The Unicode white space characters. Listed, since Java's own
# Unicode class misses four of them and is slow to match.
_OTHER_SPACE = r"[\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_SPACE = rf"[ {_OTHER_SPACE[1:]}"
# Runs that are not one blank already: a text without them is passed on as it is.
_UNEVEN = rf"{_OTHER_SPACE}{_SPACE}*| {_SPACE}+"


_SPACES = "".join(map(chr, (32, *range(9, 14), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(c, F.lit(_SPACES))


def squeeze(c: Column) -> Column:
    """Collapse runs of Unicode white space to one blank and trim."""
    return F.trim(F.regexp_replace(c, _UNEVEN, " "))


def without_placeholder(text: Column, placeholders: Sequence[str] = PLACEHOLDERS) -> Column:
    """NULL for a text that stands for a missing value, in any letter case."""
    return F.when(~F.lower(text).isin(*placeholders), text)


def clean_text(c: Column) -> Column:
    """Squeezed text; a placeholder becomes NULL."""
    return without_placeholder(squeeze(c))


def split_parts(c: Column, separator: str = "/") -> Column:
    """Trimmed, non-empty parts in source order (duplicates kept)."""
    return F.array_remove(F.split(strip(c), rf"{_SPACE}*{separator}{_SPACE}*"), "")


def multivalue(c: Column, separator: str = "/") -> Column:
    """Distinct parts in first-seen order; NULL for no text, empty for no parts."""
    return F.array_distinct(split_parts(c, separator))


def join_parts(parts: Column, glue: str = " / ") -> Column:
    """Joined text; no parts give NULL."""
    return F.nullif(F.array_join(parts, glue), F.lit(""))


def canonical_multivalue(text: Column) -> Column:
    """Squeezed multi-value text with distinct parts under the canonical separator.

    Squeezed text holds single blanks only, so its parts need no further trimming.
    """
    return join_parts(F.array_distinct(F.array_remove(F.split(text, " ?/ ?"), "")))


def normalise_multivalue(c: Column) -> Column:
    """Placeholder-aware multi-value text in canonical form."""
    return canonical_multivalue(clean_text(c))


def canonical_parts(c: Column) -> Column:
    """Parts of a text that is already in canonical form."""
    return F.split(c, " / ")


def any_changed(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True where normalisation altered at least one of the (before, after) columns.

    A missing value and the text ``<NA>`` count as the same value.
    """
    tests = [F.coalesce(a, F.lit("<NA>")) != F.coalesce(b, F.lit("<NA>")) for a, b in pairs]
    return reduce(lambda x, y: x | y, tests)


def join_names(items: Column, limit: int | None = None) -> Column:
    """Names of an array of structs; the limit counts items before empty names go."""
    if limit is not None:
        items = F.slice(items, 1, limit)
    named = F.filter(items, lambda item: item["name"] != "")
    kept = F.transform(named, lambda item: strip(item["name"]))
    return F.coalesce(F.array_join(kept, " / "), F.lit(""))


def entity_id_of_url(url: Column) -> Column:
    """Digits after ``/subject/``; empty text when the URL carries none."""
    return F.coalesce(F.regexp_extract(url, r"/subject/(\d+)/?", 1), F.lit(""))


def main_part(parts: Column) -> Column:
    return F.try_element_at(parts, F.lit(1))


def null_tokens(c: Column, tokens: Sequence[str]) -> Column:
    """Text that a CSV reader with missing-value tokens would have read as missing."""
    return F.when(~c.isin(*tokens), c)
