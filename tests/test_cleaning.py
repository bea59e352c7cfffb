"""Cleaning with audit, on the cases the data contract names."""

from __future__ import annotations

import math

import pytest

from ratinglens.contracts import ContractError, bronze_schema, fields_of
from ratinglens.labels import ZH
from ratinglens.operators.stats import star_metrics
from ratinglens.report_texts import ZH_TEXTS
from ratinglens.plans.cleaning import DERIVED_FIELDS, SOURCES, EntityRules, clean_comments, clean_entities, narrowed

BASE = dict(
    entity_id="k-40", title="Quiet  Harbour", original_title="", directors="I. Vale", actors="M. Orr / P. Sand", year="2014",
    release_date="2014-09", categories="悬疑 / 动画", places="法国", runtime="97 min", score="6.5", votes="640",
    short_count="32", long_count="16", captured_at="2024-05-20T06:30:00Z",
)


def table(spark, *changes):
    names = [*fields_of("details"), "seq"]
    rows = [tuple((BASE | c | {"seq": i})[n] for n in names) for i, c in enumerate(changes)]
    schema = bronze_schema("details").add("seq", "integer")
    return spark.createDataFrame(rows, schema)


def clean(spark, *changes, rules=EntityRules()):
    result = clean_entities(table(spark, *changes), rules)
    return {r["entity_id"]: r for r in result.cleaned.collect()}, result


def metric(result, name):
    published = ZH_TEXTS.metrics[name][0].replace("{start}", "2005").replace("{end}", "2025")
    return {r["metric"]: r["n"] for r in result.report.collect()}[published]


def hits(result, rule):
    return {r["rule"]: r["hits"] for r in result.rules.collect()}[rule]


def flags(row):
    return set(row["quality_flags"].split(";"))


def test_contract_columns(spark):
    _, result = clean(spark, {})
    assert result.cleaned.columns == [*fields_of("details"), *DERIVED_FIELDS]


@pytest.mark.parametrize("column", ["score", "captured_at", "entity_id"])
def test_a_missing_column_is_named(spark, column):
    with pytest.raises(ContractError, match=column):
        clean_entities(table(spark, {}).drop(column))


def test_latest_of_three_captures(spark):
    captures = [("2024-05-20T06:30:00Z", "second"), ("2024-05-21T01:00:00+09:00", "third"), ("2023-01-01T00:00:00Z", "first")]
    rows, result = clean(spark, *({"captured_at": at, "title": f" {name}\tcut "} for at, name in captures))
    assert rows["k-40"]["title"] == "third cut"
    assert metric(result, "duplicate_id") == 2 and hits(result, "R01") == 3


def test_repeated_parts_count_once(spark):
    rows, result = clean(spark, {"categories": "动画/ 动画 /悬疑/动画", "places": " 法国 / 中国大陆"})
    row = rows["k-40"]
    assert (row["categories"], row["main_category"], row["category_count"]) == ("动画 / 悬疑", "动画", 2)
    assert row["origin"] == ZH.coproduction and row["short_rate"] == pytest.approx(32 / 640)
    assert hits(result, "R09") == 1


@pytest.mark.parametrize(("score", "votes"), [("0", "0"), ("0.0", "640"), ("11", "640"), ("6.5", "0"), ("n", "640")])
def test_unusable_scores(spark, score, votes):
    rows, result = clean(spark, {"score": score, "votes": votes}, {"entity_id": "k-41"})
    assert rows["k-40"]["score"] is None and not rows["k-40"]["in_rating_sample"]
    assert ZH.no_rating in flags(rows["k-40"]) and rows["k-41"]["in_rating_sample"]
    assert metric(result, "no_valid_rating") == 1 and metric(result, "rating_sample") == 1


@pytest.mark.parametrize("bad", ["-640", "64.5", "many", "1e400"])
@pytest.mark.parametrize("column", ["votes", "short_count", "long_count"])
def test_bad_counts(spark, column, bad):
    rows, result = clean(spark, {column: bad})
    assert rows["k-40"][column] is None and ZH.count_invalid in flags(rows["k-40"])
    assert metric(result, "count_invalid") == 1


@pytest.mark.parametrize(("text", "minutes"), [(None, None), ("unknown", None), ("0 min", None), ("97 min", 97), ("1 h 97", 1)])
def test_runtimes(spark, text, minutes):
    rows, result = clean(spark, {"runtime": text})
    assert rows["k-40"]["runtime_min"] == minutes
    assert (ZH.runtime_bad in flags(rows["k-40"])) == (minutes is None) == (metric(result, "runtime_bad") == 1)


@pytest.mark.parametrize(("year", "flag"), [(None, "year_missing"), ("1702", "year_invalid"), ("2099", "year_invalid"), ("x", "year_missing")])
def test_unusable_years(spark, year, flag):
    rows, result = clean(spark, {"year": year}, {"entity_id": "k-41"})
    assert rows["k-40"]["year"] is None and getattr(ZH, flag) in flags(rows["k-40"])
    assert metric(result, flag) == 1 and hits(result, "R06") == 1


@pytest.mark.parametrize(("text", "flag"), [(None, "capture_missing"), ("yesterday", "capture_invalid"), ("2024-05-20 06:30:00", "capture_invalid"), ("06:30:00Z", "capture_invalid")])
def test_unusable_capture_times(spark, text, flag):
    rows, result = clean(spark, {"captured_at": text})
    assert rows["k-40"]["captured_at"] is None and getattr(ZH, flag) in flags(rows["k-40"])
    assert metric(result, flag) == 1 and hits(result, "R13") == 1


def test_any_valid_capture_beats_an_invalid_one(spark):
    rows, _ = clean(spark, {"title": "kept", "captured_at": "1999-01-01T00:00:00Z"}, {"title": "lost", "captured_at": "soon"})
    assert rows["k-40"]["title"] == "kept"


def test_year_limit_is_the_year_as_written(spark):
    # at 01:30 in the far east the year is already the next one; as an instant it is not
    east, west = "2025-01-01T01:30:00+10:00", "2024-12-31T20:00:00-06:00"
    rows, _ = clean(
        spark,
        {"entity_id": "e6", "year": "2026", "captured_at": east},
        {"entity_id": "e7", "year": "2027", "captured_at": east},
        {"entity_id": "w5", "year": "2025", "captured_at": west},
        {"entity_id": "w6", "year": "2026", "captured_at": west},
    )
    assert {k: r["year"] for k, r in rows.items()} == {"e6": 2026, "e7": None, "w5": 2025, "w6": None}


def test_study_period_and_shrinkage(spark):
    given = [("a", "2012", "5.0", "30"), ("b", "1975", "7.0", "90"), ("c", "2016", "9.0", "240")]
    rows, result = clean(spark, *({"entity_id": k, "year": y, "score": s, "votes": v, "short_count": "31"} for k, y, s, v in given))
    assert [rows[k]["in_study_period"] for k in "abc"] == [True, False, True]
    assert metric(result, "before_period") == 1
    # the prior is the mean score, its weight the median of the votes
    assert rows["a"]["shrunk_score"] == pytest.approx((30 * 5 + 90 * 7) / 120)
    assert ZH.short_over in flags(rows["a"]) and ZH.short_over not in flags(rows["b"])


def test_gaps(spark):
    rows, result = clean(spark, {"entity_id": ""}, {"places": "", "categories": None, "actors": None})
    row = rows["k-40"]
    assert (row["categories"], row["places"], row["origin"]) == (ZH.unknown,) * 3
    assert (metric(result, "missing_id"), metric(result, "cleaned_rows"), metric(result, "actors_missing")) == (1, 1, 1)
    filled, _ = clean(spark, {"places": None}, rules=EntityRules(placeless=ZH.imported))
    assert filled["k-40"]["origin"] == ZH.imported


def test_empty_input_and_staged_result(spark):
    empty = clean_entities(table(spark, {}).where("false"), stage=False)
    assert empty.cleaned.count() == 0
    assert {r["share"] for r in empty.report.collect()} == {None}
    given = table(spark, {}, {"entity_id": "k-41", "score": "x"}, {"title": "later"})
    staged = clean_entities(given)
    plain = clean_entities(given, stage=False)
    assert sorted(staged.cleaned.collect()) == sorted(plain.cleaned.collect())


def comments(spark, rows):
    names = [*fields_of("comments"), "seq"]
    base = dict(
        comment_id="n-1", entity_id="k-40", title="Quiet Harbour", star="4星", body="…", useful="6", commented_at="2024-03-02",
        sample_label="最新", position="12", captured_at="2024-05-20T06:30:00Z",
    )
    made = [tuple((base | r | {"seq": i})[n] for n in names) for i, r in enumerate(rows)]
    return spark.createDataFrame(made, bronze_schema("comments").add("seq", "integer"))


def test_last_row_of_a_comment_wins_and_useful_ones_weigh_more(spark):
    given = comments(spark, [{"star": "2星"}, {}, {"comment_id": "n-2", "star": "2星", "useful": "2"}, {"comment_id": "n-3", "star": "3星", "useful": "0"}])
    cleaned = clean_comments(given)
    assert cleaned.count() == 3
    row = star_metrics(cleaned).collect()[0]
    assert row["mean_star"] == 3.0 and row["useful_weighted_star"] == pytest.approx((4 * 6 + 2 * 2) / 8)
    assert row["mean_star"] < row["log_weighted_star"]
    assert row["star_entropy"] == pytest.approx(math.log2(3))


def test_without_useful_votes_the_plain_mean_counts(spark):
    stars = [("2星", "-1"), ("5星", "none"), ("7星", "1e30"), ("—", "0")]
    given = comments(spark, [{"comment_id": f"n-{i}", "star": s, "useful": u, "title": None} for i, (s, u) in enumerate(stars)])
    rows = star_metrics(clean_comments(given)).collect()
    assert len(rows) == 1 and rows[0]["rated"] == 2 and rows[0]["useful_weighted_star"] == 3.5


def test_rows_normalised_once_give_the_same_tables(spark):
    rows = table(spark, {}, {"entity_id": " k-40 ", "captured_at": "2024-05-21T06:30:00Z", "title": "later"}, {"entity_id": None}, {"entity_id": "k-41", "directors": None})

    def tables(rules, audit):
        made = clean_entities(rows, rules, audit=audit)
        return [sorted(map(str, t.collect())) for t in (made.cleaned, made.report, made.rules)]

    for rules in (EntityRules(), EntityRules(ties=("title", "seq"))):
        assert tables(rules, True) == tables(rules, False)


@pytest.mark.parametrize("column", SOURCES)
def test_few_columns_read_few_texts(spark, column):
    given = table(spark, {}, {"score": "0", "captured_at": None}, {"entity_id": "k-41", "places": "", "categories": " NULL ", "votes": "x"}, {"entity_id": None})
    whole = clean_entities(given).cleaned.select("entity_id", column)
    part = clean_entities(given, columns=[column])
    assert sorted(map(str, part.cleaned.collect())) == sorted(map(str, whole.collect()))
    read = narrowed(given, [column], ("seq",)).first().asDict()
    assert {c for c, v in read.items() if v is not None} <= {"entity_id", "captured_at", "seq", *SOURCES[column]}
    with pytest.raises(ValueError):
        _ = part.report
