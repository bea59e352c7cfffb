"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Null text counts as empty. An empty text has no words, all counts 0, and fails the base rule. Rows are judged one by
one, so repeated rows and null or repeated ids change nothing; columns of the input whose names clash with the
columns added here are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his this are or from at an which have had "
    "le la les de des du et un une en que qui dans pour par sur au est pas plus "
    "der die das und ist nicht ein eine von zu mit den dem auf für im es als auch "
    "el los las del una y se por con para su al como más lo"
).split()

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A measure that must lie in [low, high]; a null measure passes."""

    measure: str
    low: float = float("-inf")
    high: float = float("inf")


#: Ratios that the method judges beyond the base rule.
RULES = (
    Rule("mean_word_length", 2.0, 20.0),
    Rule("symbol_ratio", high=0.25),
    Rule("stop_word_ratio", 0.002),
    Rule("duplicate_line_ratio", high=0.5),
)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules use: one narrow pass, no shuffle."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    stop = [form for w in STOP_WORDS for form in (w, w.capitalize())]
    # Each 3-word window as its hash and its start. Sorted, equal windows are neighbours.
    windows = F.when(
        F.size("_words") >= 3,
        F.sort_array(
            F.transform(
                F.slice(F.arrays_zip("_words", _after("_words", 1), _after("_words", 2)), F.lit(1), F.size("_words") - 2),
                lambda w, i: F.struct(F.xxhash64(w).alias("h"), i.alias("i")),
            )
        ),
    )
    pairs = F.array_compact(
        F.zip_with(
            F.col("_windows"),
            _after("_windows", 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        )
    )
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, _same_words))))
    # each window covers three words, less what the next repeated window covers
    covered = F.aggregate(
        F.zip_with("_starts", _after("_starts", 1), lambda i, after: F.least(F.lit(3), F.coalesce(after - i, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    first = docs.withColumns({"_words": words, "_lines": lines, "_body": body})
    second = first.withColumns(
        {
            "_windows": windows,
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_body", F.lit(SYMBOLS)).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stop))).cast("long"),
        }
    )
    third = second.withColumn("_starts", F.when(F.size("_windows") >= 2, starts))
    return third.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(*_SCRATCH)


_SCRATCH = ("_words", "_lines", "_body", "_windows", "_starts")


def _after(array: str, skipped: int) -> Column:
    """The array without its first elements."""
    return F.slice(F.col(array), F.lit(skipped + 1), F.greatest(F.size(array) - skipped, F.lit(0)))


def _same_words(pair: Column) -> Column:
    """Whether two windows of equal hash have the same words."""
    i, j = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
    same = F.lit(True)
    for ahead in range(3):
        same = same & (F.get(F.col("_words"), i + ahead) == F.get(F.col("_words"), j + ahead))
    return same


def ratios() -> dict[str, Column]:
    """The measures by name, from the counts of `measures`."""
    n = F.nullif(F.col("n_words"), F.lit(0))
    return {
        "mean_word_length": F.col("word_chars") / n,
        "symbol_ratio": F.col("n_symbols") / n,
        "stop_word_ratio": F.col("n_stop_words") / n,
        "duplicate_line_ratio": F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)),
    }


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add counts, `base_failed`, `failed_rules` and `kept` to each row."""
    known = ratios()
    fails = [
        F.when((known[r.measure] < r.low) | (known[r.measure] > r.high), F.lit(r.measure)) for r in rules
    ]
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = measures(docs, text).withColumns(
        {"base_failed": base, "failed_rules": F.array_compact(F.array(*fails)) if fails else F.array().cast("array<string>")}
    )
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def sql() -> str:
    """The judged counts, verdict included, as SQL over `documents`."""
    stop = ", ".join(f"'{form}'" for w in STOP_WORDS for form in (w, w.capitalize()))
    measured = {
        "mean_word_length": "word_chars / nullif(n_words, 0)",
        "symbol_ratio": "n_symbols / nullif(n_words, 0)",
        "stop_word_ratio": "n_stop_words / nullif(n_words, 0)",
        "duplicate_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
    }
    passed = [
        f"coalesce({measured[r.measure]} {sign} {bound}, true)"
        for r in RULES
        for sign, bound in ((">=", r.low), ("<=", r.high))
        if abs(bound) != float("inf")
    ]
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), g AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM d, unnest(range(1, len(words) - 1)) AS t(i)
), twice AS (
  SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1
), covered AS (
  SELECT r, count(DISTINCT j) AS n FROM twice, unnest([i, i + 1, i + 2]) AS t(j) GROUP BY r
), lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), counted AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    len(list_filter(words, lambda w: list_contains([{stop}], w))) AS n_stop_words, coalesce(lines.n, 0) AS n_lines
  FROM d LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
), base AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND {" AND ".join(passed)} AS kept FROM base"""
