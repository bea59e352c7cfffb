"""Quality report and rule table of the entity cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.labels import STUDY_YEARS, ZH, Labels
from ratinglens.report_texts import ZH_TEXTS, ReportTexts

# Report lines: metric, scope, count column. Counts of the raw input come
# from the struct `raw`, the others from the unique rows.
_METRICS = [
    ("rows_in", "raw", "raw.rows"),
    ("missing_id", "raw", "raw.missing_id"),
    ("duplicate_id", "raw", "duplicates"),
    ("cleaned_rows", "raw", "clean"),
    ("no_valid_rating", "unique", "no_rating"),
    ("rating_sample", "unique", "rating_sample"),
    ("study_sample", "unique", "study_sample"),
    ("before_period", "unique", "before_period"),
    ("after_period", "unique", "after_period"),
    ("year_missing", "unique", "year_missing"),
    ("year_invalid", "unique", "year_invalid"),
    ("capture_missing", "unique", "capture_missing"),
    ("capture_invalid", "unique", "capture_invalid"),
    ("release_not_day", "unique", "release_not_day"),
    ("runtime_bad", "unique", "runtime_bad"),
    ("category_missing", "unique", "category_missing"),
    ("place_missing", "unique", "place_missing"),
    ("original_title_missing", "raw", "raw.original_title_missing"),
    ("directors_missing", "raw", "raw.directors_missing"),
    ("actors_missing", "raw", "raw.actors_missing"),
    ("count_invalid", "unique", "count_invalid"),
    ("comments_without_rating", "unique", "comments_without_rating"),
]

# Hits of each rule.
_HITS = {
    "R01": "raw.changed",
    "R02": "duplicates",
    "R03": "raw.missing_id",
    "R04": "no_rating",
    "R05": "count_invalid",
    "R06": "year_bad",
    "R07": "release_not_day",
    "R08": "runtime_bad",
    "R09": "clean",
    "R10": "rating_sample",
    "R11": "study_sample",
    "R12": "rating_sample",
    "R13": "capture_bad",
}


def audit_counts(normalised: DataFrame, marked: DataFrame, years: tuple[int, int], labels: Labels = ZH) -> DataFrame:
    """One row holding every count of both scopes: one aggregation per scope."""
    missing = {
        f"{c}_missing": F.count_if(F.col(c).isNull())
        for c in ("original_title", "directors", "actors", "categories", "places")
    }
    has_id = F.col("entity_id").isNotNull()
    raw = normalised.agg(
        F.count("*").alias("rows"),
        F.count_if(~has_id).alias("missing_id"),
        F.count_if(has_id & F.col("_changed")).alias("changed"),
        *[expr.alias(name) for name, expr in missing.items()],
    )
    masks = {
        "no_rating": ~F.col("in_rating_sample"),
        "rating_sample": F.col("in_rating_sample"),
        "study_sample": F.col("in_study_period"),
        "before_period": F.col("year") < years[0],
        "after_period": F.col("year") > years[1],
        "year_missing": F.col("_year_missing"),
        "year_invalid": F.col("_year_invalid"),
        "year_bad": F.col("_year_missing") | F.col("_year_invalid"),
        "capture_missing": F.col("_capture_missing"),
        "capture_invalid": F.col("_capture_invalid"),
        "capture_bad": F.col("_capture_missing") | F.col("_capture_invalid"),
        "release_not_day": F.col("release_precision") != labels.day,
        "runtime_bad": F.col("runtime_min").isNull(),
        "category_missing": F.col("_category_missing"),
        "place_missing": F.col("_place_missing"),
        "count_invalid": F.col("_count_invalid"),
        "comments_without_rating": F.col("_comments_without_rating"),
    }
    unique = marked.agg(F.count("*").alias("clean"), *[F.count_if(m).alias(n) for n, m in masks.items()])
    combined = unique.withColumn("raw", raw.select(F.struct(*raw.columns).alias("raw")).scalar())
    return combined.withColumn("duplicates", F.col("raw.rows") - F.col("raw.missing_id") - F.col("clean"))


def quality_report(counts: DataFrame, texts: ReportTexts = ZH_TEXTS, years: tuple[int, int] = STUDY_YEARS) -> DataFrame:
    """Long form: one line per metric with its count and share of the scope."""
    size = {"raw": F.col("raw.rows"), "unique": F.col("clean")}
    scopes = {"raw": texts.raw, "unique": texts.unique}
    lines = [
        F.struct(
            F.lit(i).alias("line"),
            F.lit(_of_period(texts.metrics[name][0], years)).alias("metric"),
            F.lit(scopes[scope]).alias("scope"),
            F.col(column).alias("n"),
            F.try_divide(F.col(column), F.nullif(size[scope], F.lit(0))).alias("share"),
            F.lit(texts.metrics[name][1]).alias("note"),
        )
        for i, (name, scope, column) in enumerate(_METRICS, 1)
    ]
    return counts.select(F.inline(F.array(*lines)))


def rule_table(counts: DataFrame, texts: ReportTexts = ZH_TEXTS, years: tuple[int, int] = STUDY_YEARS) -> DataFrame:
    """Every cleaning rule with the number of rows it hit."""
    names = ("field", "criterion", "action", "hit_kind", "reason", "rejected")
    lines = [
        F.struct(
            F.lit(rule).alias("rule"),
            *[F.lit(_of_period(v, years)).alias(n) for n, v in zip(names, texts.rules[rule], strict=True)],
            F.col(column).alias("hits"),
        )
        for rule, column in _HITS.items()
    ]
    return counts.select(F.inline(F.array(*lines)))


def _of_period(text: str, years: tuple[int, int]) -> str:
    return text.replace("{start}", str(years[0])).replace("{end}", str(years[1]))
