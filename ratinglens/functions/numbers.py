"""Strict and lenient number parsing of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratinglens.labels import LONGEST_RUNTIME, OLDEST_YEAR

_NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_LONG_LIMIT = 9.2e18


def to_number(c: Column) -> Column:
    """Double, or NULL for anything that is not a plain decimal number."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMERIC), F.trim(text).try_cast("double"))


def nonnegative_integer(c: Column) -> Column:
    """BIGINT for whole numbers of at least zero; everything else is NULL, never rounded."""
    value = integer_or_null(c)
    return F.when(value >= 0, value)


def integer_or_null(c: Column) -> Column:
    """BIGINT for any whole number, also one written with a fraction of zero or an exponent."""
    exact = F.trim(c.cast("string")).try_cast("bigint")
    number = to_number(c)
    whole = F.when((number % 1 == 0) & (F.abs(number) < _LONG_LIMIT), number.cast("bigint"))
    return F.coalesce(exact, whole)


def valid_rating(score: Column, votes: Column, top: float = 10.0) -> Column:
    """Never NULL: score in (0, top] and at least one vote."""
    return F.coalesce((score > 0) & (score <= top) & (votes > 0), F.lit(False))


def valid_year(year: Column, newest: Column, oldest: int = OLDEST_YEAR) -> Column:
    """Never NULL: a whole year between the oldest plausible one and the row's limit."""
    return F.coalesce((year % 1 == 0) & (year >= oldest) & (year <= newest), F.lit(False))


def first_number(c: Column) -> Column:
    """First run of digits in a text, as BIGINT."""
    return F.regexp_extract(c.cast("string"), r"(\d+)", 1).try_cast("bigint")


def runtime_minutes(c: Column, longest: int = LONGEST_RUNTIME) -> Column:
    minutes = first_number(c)
    return F.when(minutes.between(1, longest), minutes).cast("int")


def star_value(c: Column, best: int = 5) -> Column:
    stars = first_number(c)
    return F.when(stars.between(1, best), stars).cast("int")


def useful_votes(c: Column) -> Column:
    """Bad or missing is 0, as is a number beyond BIGINT; negatives are 0, fractions are floored."""
    number = to_number(c)
    return F.coalesce(F.when(number.between(0, _LONG_LIMIT), F.floor(number).cast("bigint")), F.lit(0).cast("bigint"))


def integer_or_zero(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")).try_cast("int"), F.lit(0))
