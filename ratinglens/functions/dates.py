"""Capture times with an explicit zone, and dates of partial precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratinglens.labels import OLDEST_YEAR, ZH, Labels

# The input formats of the contract.
_ZONE_AT_END = r"(?i)(Z|[+-]\d{2}:?\d{2})$"
_PARTIAL = r"^\d{4}(?:-\d{1,2}(?:-\d{1,2})?)?$"


def _with_dashes(c: Column) -> Column:
    """Dates written with slashes or points, and compact ones, in the usual form; other texts as they are."""
    compact = F.regexp_replace(c, r"^(\d{4})(\d\d)(\d\d)[T ](\d\d):?(\d\d):?(\d\d)", "$1-$2-$3T$4:$5:$6")
    return F.when(c.rlike(r"^\d{4}-"), c).otherwise(F.regexp_replace(compact, r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})", "$1-$2-$3"))


def capture_instant(c: Column) -> Column:
    """UTC instant; NULL when the text has no date, no zone suffix, or does not parse."""
    text = _with_dashes(F.trim(c))
    return F.when(text.rlike(r"^\d{4}-") & text.rlike(_ZONE_AT_END), F.try_to_timestamp(text))


def capture_local_year(c: Column) -> Column:
    """Year as written in the source text, so a zone shift cannot move it."""
    year = F.regexp_extract(c, r"^(\d{4})", 1).try_cast("int")
    return F.when(capture_instant(c).isNotNull(), year)


def naive_time(c: Column) -> Column:
    """Wall-clock time of one row, NULL when it does not parse."""
    return c.try_cast("timestamp_ntz")


def zoned_time(c: Column) -> Column:
    return F.try_to_timestamp(c)


def partial_date(
    c: Column, newest_year: Column, oldest_year: int = OLDEST_YEAR, labels: Labels = ZH
) -> Column:
    """Struct (year, month, day, iso, precision); no missing month or day is invented."""
    text = F.trim(c)
    shaped = text.rlike(_PARTIAL)
    pieces = F.split(F.when(shaped, text), "-")
    year, month, day = (F.get(pieces, F.lit(i)).try_cast("int") for i in range(3))
    plausible = shaped & year.between(oldest_year, newest_year)
    first = F.make_date(year, month, F.lit(1))
    on_calendar = month.between(1, 12) & (day >= 1) & (day <= F.day(F.last_day(first)))
    parsed = F.when(plausible & on_calendar, F.date_add(first, day - 1))
    precision = (
        F.when(c.isNull(), labels.missing)
        .when(~shaped | ~plausible, labels.invalid)
        .when(day.isNotNull(), F.when(parsed.isNotNull(), labels.day).otherwise(labels.invalid))
        .when(month.isNotNull(), F.when(month.between(1, 12), labels.month).otherwise(labels.invalid))
        .otherwise(labels.year)
    )
    return F.struct(
        F.when(shaped, year).alias("year"),
        F.when(plausible, month).alias("month"),
        F.when(plausible, day).alias("day"),
        F.date_format(parsed, "yyyy-MM-dd").alias("iso"),
        precision.alias("precision"),
    )


def date_in_text(c: Column) -> Column:
    """First ``YYYY[-M[-D]]`` found in a text, zero padded; empty text when none."""
    found = F.regexp_extract(c, r"\d{4}(-\d\d?){0,2}", 0)
    padded = F.transform(F.split(found, "-"), lambda part, i: F.when(i == 0, part).otherwise(F.lpad(part, 2, "0")))
    return F.coalesce(F.array_join(padded, "-"), F.lit(""))
