"""Entity cleaning with audit, and comment cleaning."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.contracts import fields_of, require_columns
from ratinglens.functions.dates import capture_instant, naive_time, partial_date, zoned_time
from ratinglens.functions.numbers import (
    integer_or_null,
    nonnegative_integer,
    runtime_minutes,
    star_value,
    to_number,
    useful_votes,
    valid_rating,
    valid_year,
)
from ratinglens.functions.rating import flags_text, origin_class, participation, shrunk_score
from ratinglens.functions.text import any_changed, canonical_multivalue, canonical_parts, main_part, squeeze, without_placeholder
from ratinglens.labels import HOME_PLACE, SPECIAL_PLACES, STUDY_YEARS, ZH, Labels
from ratinglens.operators.audit import audit_counts, quality_report, rule_table
from ratinglens.operators.ordered import exact_quantiles
from ratinglens.operators.snapshot import keep_last, latest_snapshot
from ratinglens.report_texts import ZH_TEXTS, ReportTexts, texts_of
from ratinglens.session import staged

TEXT_FIELDS = (
    "entity_id", "title", "original_title", "directors", "actors",
    "release_date", "categories", "places", "runtime", "captured_at",
)
MULTI_FIELDS = ("categories", "places")
DERIVED_FIELDS = (
    "release_year", "release_month", "release_day", "release_iso", "release_precision",
    "runtime_min", "main_category", "category_count", "origin", "short_rate", "long_rate",
    "in_rating_sample", "in_study_period", "shrunk_score", "quality_flags",
)

#: The texts that a column of the cleaned table is made of, beside the id and the capture time, for those that need few.
SOURCES = {
    "year": ("year",),
    "score": ("score", "votes"),
    "votes": ("votes",),
    "categories": ("categories",),
    "origin": ("places",),
    "short_rate": ("short_count", "votes"),
    "long_rate": ("long_count", "votes"),
    "in_rating_sample": ("score", "votes"),
    "in_study_period": ("year",),
}


@dataclass(frozen=True)
class EntityRules:
    """What may differ from one entity table to the next."""

    ties: Sequence[str] = ("seq",)
    years: tuple[int, int] = STUDY_YEARS
    home: str = HOME_PLACE
    special: Sequence[str] = SPECIAL_PLACES
    labels: Labels = ZH
    # class of a row without a place; `labels.imported` gives the older habit of
    # classifying after the gap was filled with "unknown"
    placeless: str | None = None


@dataclass(frozen=True)
class CleanEntities:
    """Cleaned table; the report and the rule table are planned when asked for."""

    cleaned: DataFrame
    counts: Callable[[], DataFrame]
    texts: ReportTexts = ZH_TEXTS
    years: tuple[int, int] = STUDY_YEARS

    @property
    def report(self) -> DataFrame:
        return quality_report(self.counts(), self.texts, self.years)

    @property
    def rules(self) -> DataFrame:
        return rule_table(self.counts(), self.texts, self.years)


def normalise_entities(raw: DataFrame) -> DataFrame:
    """Canonical text columns plus ``_changed``, the mask of altered rows."""
    kept = [c for c in raw.columns if c not in TEXT_FIELDS]
    # one step per projection: a text used twice in one expression would be built twice
    squeezed = raw.select(
        *kept,
        *[F.col(c).cast("string").alias(f"_raw_{c}") for c in TEXT_FIELDS],
        *[squeeze(F.col(c).cast("string")).alias(c) for c in TEXT_FIELDS],
    )
    named = squeezed.withColumns({c: without_placeholder(F.col(c)) for c in TEXT_FIELDS})
    final = named.withColumns({c: canonical_multivalue(F.col(c)) for c in MULTI_FIELDS})
    changed = any_changed([(F.col(f"_raw_{c}"), F.col(c)) for c in TEXT_FIELDS])
    return final.select(*kept, *TEXT_FIELDS, changed.alias("_changed"))


def narrowed(raw: DataFrame, columns: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """The raw rows with only the texts that the given columns of ``SOURCES`` are made of; the other ones are NULL.

    What would make those texts, sort and carry them is then neither run nor written.
    """
    needed = {"entity_id", "captured_at", *ties, *(source for c in columns for source in SOURCES[c])}
    empty = {f.name: F.lit(None).cast(f.dataType) for f in raw.schema if f.name in fields_of("details") and f.name not in needed}
    return raw.withColumns(empty)


def entity_snapshot(raw: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Newest capture per entity id in canonical text; rows without id are dropped.

    Only id and capture time are normalised before the snapshot, the other texts of its survivors after it.
    """
    bare = {c: without_placeholder(squeeze(F.col(c).cast("string"))) for c in ("entity_id", "captured_at")}
    keyed = raw.withColumns({"_id": bare["entity_id"], "_captured": capture_instant(bare["captured_at"])})
    newest = latest_snapshot(keyed.where(F.col("_id").isNotNull()), "_id", "_captured", ties)
    return normalise_entities(newest.drop("_id"))


def mark_entities(snapshot: DataFrame, rules: EntityRules) -> DataFrame:
    """Typed and derived columns, with one mask column per kind of defect."""
    labels = rules.labels
    start, end = rules.years
    counts = ("votes", "short_count", "long_count")
    typed = snapshot.select(
        *[c for c in fields_of("details") if c not in (*counts, "score", "year")],
        "_captured",
        *[nonnegative_integer(F.col(c)).alias(c) for c in counts],
        to_number(F.col("score")).alias("_score"),
        to_number(F.col("year")).alias("_year"),
        # year as written, so that no zone shift can move it
        F.when(F.col("_captured").isNotNull(), F.substring("captured_at", 1, 4).try_cast("int")).alias("_local_year"),
        canonical_parts(F.col("categories")).alias("_categories"),
        canonical_parts(F.col("places")).alias("_places"),
    )
    newest_known = typed.agg(F.coalesce(F.max("_local_year"), F.lit(end + 1)).alias("y")).scalar()
    checked = typed.withColumns(
        {
            "in_rating_sample": valid_rating(F.col("_score"), F.col("votes")),
            "_newest": F.coalesce(F.col("_local_year"), newest_known) + 1,
            "runtime_min": runtime_minutes(F.col("runtime")),
        }
    ).withColumns(
        {
            "score": F.when(F.col("in_rating_sample"), F.col("_score")),
            "_year_ok": valid_year(F.col("_year"), F.col("_newest")),
            "_release": partial_date(F.col("release_date"), F.col("_newest"), labels=labels),
            "short_rate": participation(F.col("short_count"), F.col("votes")),
            "long_rate": participation(F.col("long_count"), F.col("votes")),
        }
    )
    valid = typed.where(valid_rating(F.col("_score"), F.col("votes"))).select("_score", "votes")
    prior_mean = valid.agg(F.avg("_score").alias("c")).scalar()
    prior_votes = exact_quantiles(valid, "votes", {"m": 0.5}).scalar()
    unknown = F.lit(labels.unknown)
    placed = origin_class(F.col("_places"), rules.home, rules.special, labels)
    if rules.placeless is not None:
        placed = F.when(F.col("_places").isNull(), rules.placeless).otherwise(placed)
    marked = checked.select(
        "*",
        F.when(F.col("_year_ok"), F.col("_year")).cast("int").alias("year"),
        F.col("_release.year").alias("release_year"),
        F.col("_release.month").alias("release_month"),
        F.col("_release.day").alias("release_day"),
        F.col("_release.iso").alias("release_iso"),
        F.col("_release.precision").alias("release_precision"),
        F.coalesce(main_part(F.col("_categories")), unknown).alias("main_category"),
        F.coalesce(F.size("_categories"), F.lit(1)).alias("category_count"),
        placed.alias("origin"),
        F.col("_year").isNull().alias("_year_missing"),
        (F.col("_year").isNotNull() & ~F.col("_year_ok")).alias("_year_invalid"),
        F.col("captured_at").isNull().alias("_capture_missing"),
        (F.col("captured_at").isNotNull() & F.col("_captured").isNull()).alias("_capture_invalid"),
        F.col("_categories").isNull().alias("_category_missing"),
        F.col("_places").isNull().alias("_place_missing"),
        (F.col("votes").isNull() | F.col("short_count").isNull() | F.col("long_count").isNull()).alias(
            "_count_invalid"
        ),
        (~F.col("in_rating_sample") & (F.coalesce("short_count", F.lit(0)) > 0)).alias("_comments_without_rating"),
        F.when(
            F.col("in_rating_sample"), shrunk_score(F.col("score"), F.col("votes"), prior_mean, prior_votes)
        ).alias("shrunk_score"),
    )
    return marked.withColumns(
        {
            "in_study_period": F.coalesce(F.col("year").between(start, end), F.lit(False)),
            "quality_flags": flags_text(
                [
                    (~F.col("in_rating_sample"), labels.no_rating),
                    (F.col("_comments_without_rating"), labels.comments_without_rating),
                    (F.col("_count_invalid"), labels.count_invalid),
                    (F.col("_year_missing"), labels.year_missing),
                    (F.col("_year_invalid"), labels.year_invalid),
                    (F.col("_capture_missing"), labels.capture_missing),
                    (F.col("_capture_invalid"), labels.capture_invalid),
                    (F.col("release_precision") == labels.missing, labels.release_missing),
                    (F.col("release_precision") == labels.invalid, labels.release_invalid),
                    (F.col("runtime_min").isNull(), labels.runtime_bad),
                    (F.col("_category_missing"), labels.category_missing),
                    (F.col("_place_missing"), labels.place_missing),
                    (F.col("short_rate") > 1, labels.short_over),
                    (F.col("long_rate") > 1, labels.long_over),
                ],
                labels.normal,
            ),
        }
    )


def finish_entities(marked: DataFrame, labels: Labels) -> DataFrame:
    """Contract columns plus derived columns; gaps in categories and places are named."""
    final = marked.withColumns(
        {
            "categories": F.coalesce("categories", F.lit(labels.unknown)),
            "places": F.coalesce("places", F.lit(labels.unknown)),
            "captured_at": F.col("_captured"),
        }
    )
    return final.select(*fields_of("details"), *DERIVED_FIELDS)


def clean_entities(
    raw: DataFrame, rules: EntityRules = EntityRules(), stage: bool = True, audit: bool = False, columns: Sequence[str] = ()
) -> CleanEntities:
    """Cleaned table, quality report and rule table.

    The snapshot is written once to the shared folder: the scalar passes, the
    report and the result then read narrow Parquet columns instead of repeating
    the snapshot shuffle. Without ``stage`` nothing runs here. With ``audit`` all
    rows are normalised and written once, for the snapshot and for the report and
    the rule table, which else normalise the raw input once more. With ``columns``,
    of ``SOURCES``, the cleaned table has the id and these alone, and only their
    texts are read; there is no report then.
    """
    require_columns(raw, fields_of("details"), "entity details")
    if columns:
        if audit:
            raise ValueError("the report needs all columns")
        narrow = entity_snapshot(narrowed(raw, columns, rules.ties), rules.ties)
        marked = mark_entities(staged(narrow, "entity-snapshot") if stage else narrow, rules)
        return CleanEntities(finish_entities(marked, rules.labels).select("entity_id", *columns), _no_counts)
    normalised = normalise_entities(raw)
    # ties are broken by the raw texts, so a text among them needs the raw rows
    if stage and audit and not set(rules.ties) & set(TEXT_FIELDS):
        normalised = staged(normalised, "normalised-entities")
        keyed = normalised.where(F.col("entity_id").isNotNull()).withColumn("_captured", capture_instant(F.col("captured_at")))
        snapshot = latest_snapshot(keyed, "entity_id", "_captured", rules.ties)
    else:
        snapshot = entity_snapshot(raw, rules.ties)
    if stage:
        snapshot = staged(snapshot, "entity-snapshot")
    marked = mark_entities(snapshot, rules)
    return CleanEntities(
        finish_entities(marked, rules.labels),
        lambda: audit_counts(normalised, marked, rules.years, rules.labels),
        texts_of(rules.labels),
        rules.years,
    )


def _no_counts() -> DataFrame:
    raise ValueError("the report needs all columns")


def clean_comments(raw: DataFrame, order_by: Sequence[str] = ("seq",)) -> DataFrame:
    """Last row per (comment, label), with typed star, votes, position and times."""
    require_columns(raw, fields_of("comments"), "comments")
    last = keep_last(raw, ["comment_id", "sample_label"], order_by)
    return last.select(
        "comment_id",
        "entity_id",
        "title",
        "star",
        "body",
        useful_votes(F.col("useful")).alias("useful"),
        naive_time(F.col("commented_at")).alias("commented_at"),
        "sample_label",
        integer_or_null(F.col("position")).alias("position"),
        zoned_time(F.col("captured_at")).alias("captured_at"),
        star_value(F.col("star")).alias("star_value"),
    )
