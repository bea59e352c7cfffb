"""Column functions on hand-made values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ratinglens.functions import dates, numbers, payload, rating, text
from ratinglens.labels import ZH


def values(spark, inputs, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("c"))).collect()]


def test_only_uneven_space_is_rewritten(spark):
    spaces = [" ", "\t", "\n", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000"]
    texts = ["a b c", "", " ", "  ", *(f"{x}a{y}{z}b{y}" for x in ["", *spaces] for y in spaces for z in ["", *spaces])]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.t for r in df.select(text.squeeze(F.col("t")).alias("t")).collect()]
    assert got == [" ".join(t.split()) for t in texts]
    even = df.where(F.col("t") == "a b c")
    assert even.where(F.col("t").rlike(text._UNEVEN)).count() == 0


def test_text_is_squeezed_and_placeholders_are_missing(spark):
    given = ["  a \t b　c ", "NaN", " NULL ", "暂无", "<NA>", "", None, "none such"]
    assert values(spark, given, text.clean_text) == ["a b c", None, None, None, None, None, None, "none such"]


def test_multivalue_keeps_first_seen_order(spark):
    given = ["x / x / y", " y/x ", "/ /", None, "a /b/ a"]
    assert values(spark, given, text.normalise_multivalue) == ["x / y", "y / x", None, None, "a / b"]
    assert values(spark, ["b　/ a/b"], text.multivalue) == [["b", "a"]]


def test_changed_treats_na_text_as_missing(spark):
    df = spark.createDataFrame([("<NA>", None), ("a", "a"), (" a", "a"), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(text.any_changed([(F.col("a"), F.col("b"))])).collect()]
    assert got == [False, False, True, False]


def test_names_are_limited_before_empty_ones_go(spark):
    people = [[("A ",), ("",), (None,), ("B",)]]
    kind = "array<struct<name:string>>"
    assert values(spark, people, lambda c: text.join_names(c, 3), kind) == ["A"]
    assert values(spark, people, text.join_names, kind) == ["A / B"]
    assert values(spark, [None], text.join_names, kind) == [""]


def test_entity_id_of_url(spark):
    given = ["https://x/subject/37450627/", "https://x/subject/12", "https://x/none", None]
    assert values(spark, given, text.entity_id_of_url) == ["37450627", "12", "", ""]


def test_counts_are_never_rounded(spark):
    given = ["12", " 7 ", "4.0", "1e3", "-1", "1.5", "text", "inf", "nan", "12d", "", None, "9007199254740993"]
    want = [12, 7, 4, 1000, None, None, None, None, None, None, None, None, 9007199254740993]
    assert values(spark, given, numbers.nonnegative_integer) == want


def test_useful_votes_and_stars(spark):
    assert values(spark, ["9", "-3", "x", "2.7", None, "1e30", "-1e30"], numbers.useful_votes) == [9, 0, 0, 2, 0, 0, 0]
    assert values(spark, ["5星", "未评分", "10 stars", "3", None], numbers.star_value) == [5, None, None, 3, None]


def test_runtime(spark):
    given = ["120分钟", "no", "0 min", "1440", "1441", "99999999999999999999", None]
    assert values(spark, given, numbers.runtime_minutes) == [120, None, None, 1440, None, None, None]


def test_lenient_integer(spark):
    assert values(spark, ["3", "x", None, "1.5"], numbers.integer_or_zero) == [3, 0, 0, 0]


def test_capture_time_needs_a_zone(spark):
    given = [
        "2026-01-01T00:00:00+08:00", "2026-01-01T00:00:00+0800", "2026-01-01T00:00:00Z",
        "2026-01-01 12:00:00", "not-a-time", "10:00:00Z", None,
    ]
    got = values(spark, given, lambda c: F.date_format(dates.capture_instant(c), "yyyy-MM-dd HH"))
    assert got == ["2025-12-31 16", "2025-12-31 16", "2026-01-01 00", None, None, None, None]
    assert values(spark, ["2024-12-31T23:30:00-08:00", "2024"], dates.capture_local_year) == [2024, None]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("2020-01-02", (2020, 1, 2, "2020-01-02", "日")),
        ("2020-1-2", (2020, 1, 2, "2020-01-02", "日")),
        ("2020-01", (2020, 1, None, None, "月")),
        ("2020-13", (2020, 13, None, None, "异常")),
        ("2020", (2020, None, None, None, "年")),
        ("2020-02-30", (2020, 2, 30, None, "异常")),
        ("2020-02-29", (2020, 2, 29, "2020-02-29", "日")),
        ("2021-02-29", (2021, 2, 29, None, "异常")),
        ("2020-00-01", (2020, 0, 1, None, "异常")),
        ("2020-01-00", (2020, 1, 0, None, "异常")),
        ("unknown", (None, None, None, None, "异常")),
        ("0000", (0, None, None, None, "异常")),
        ("9999-01", (9999, None, None, None, "异常")),
        (None, (None, None, None, None, "缺失")),
    ],
)
def test_partial_date(spark, given, want):
    assert tuple(values(spark, [given], lambda c: dates.partial_date(c, F.lit(2027)))[0]) == want


def test_date_in_text(spark):
    given = ["2026(x)", "on 2020-1-2 here", "2020-1", "no", None]
    assert values(spark, given, dates.date_in_text) == ["2026", "2020-01-02", "2020-01", "", ""]


def test_origin_classes(spark):
    """Home alone, home with others, special areas alone or with others, abroad, and nothing usable."""
    own = {"home": "Freeland", "special": ("Northport", "Eastport")}
    cases = {
        ("Eastport", "Northport"): ZH.special, ("Sorland",): ZH.imported, ("Sorland", "Freeland"): ZH.coproduction,
        ("Freeland",): ZH.home, (): ZH.unknown, ("Eastport", "Sorland"): ZH.coproduction, ("Northport",): ZH.special,
        ("Freeland", "Eastport"): ZH.coproduction, ("null",): ZH.unknown, ("Sorland", "Westmark"): ZH.imported,
    }
    got = values(spark, [list(c) for c in cases], lambda c: rating.origin_class(c, **own), "array<string>")
    assert got == list(cases.values())
    assert values(spark, [None], rating.origin_class, "array<string>") == [ZH.unknown]


def test_wilson_and_entropy_edges(spark):
    df = spark.createDataFrame([(0, 0), (0, 10), (10, 10)], "k int, n int")
    low, high = rating.wilson_bounds(F.col("k"), F.col("n"))
    rows = df.orderBy("n", "k").select(low, high).collect()
    assert tuple(rows[0]) == (None, None)
    assert rows[1][0] == pytest.approx(0.0, abs=1e-12) and rows[1][1] == pytest.approx(0.277533, abs=1e-5)
    assert rows[2][1] == pytest.approx(1.0)
    entropy = rating.entropy_bits([F.col("k"), F.col("n") - F.col("k")], F.col("n"))
    assert [r[0] for r in df.orderBy("n", "k").select(entropy).collect()] == [0.0, 0.0, 0.0]


def test_failure_reasons(spark):
    rows = [(None, None), (404, "{}"), (200, "[]"), (200, "{broken"), (200, '{"rating": "x"}'), (200, '{"rating": null}')]
    df = spark.createDataFrame(rows, "status int, body string")
    got = [r[0] for r in df.select(payload.failure_reason(F.col("status"), F.col("body"))).collect()]
    assert got == [ZH.network_failure, "HTTP 404", ZH.parse_failure, ZH.parse_failure, ZH.parse_failure, None]


def test_capture_times_in_other_layouts(spark):
    given = ["2026/01/01 10:00:00+08:00", "20260101T020000Z", "2026-01-01T02:00:00Z", "2026.1.1 02:00:00Z", "02:00:00Z", "2026/01/01 10:00:00"]
    got = values(spark, given, lambda c: F.date_format(dates.capture_instant(c), "yyyy-MM-dd HH:mm"))
    assert got == ["2026-01-01 02:00"] * 3 + [got[3], None, None]


def test_strip_takes_every_white_space_and_no_other_character(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [*(f"{s}{s}a{s}b{s}" for s in spaces), "\u200ba\u200b", "", " ", "\ufeffa"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(text.strip(F.col("t"))).collect()
    assert [r[0] for r in found] == [t.strip() for t in texts]


def test_a_rating_is_written_out_once(spark):
    bodies = {'{"rating": {"value": 1}}': True, '{"rating": null}': True, "{}": True, '{"rating": ""}': True, '{"rating": 0.0}': True, '{"rating": []}': True,
              '{"rating": false}': True, '{"rating": -0}': True, '{"rating": "x"}': False, '{"rating": 1}': False, '{"rating": 0.5}': False, '{"rating": [0]}': False,
              '{"rating": "null"}': False, '{"rating": true}': False}
    rows = spark.createDataFrame([(b, 200) for b in bodies], "body string, status int").select("status", "body", F.parse_json("body").alias("payload"))
    tested = rows.select("body", payload.payload_reason(F.col("status"), F.col("payload")).isNull().alias("ok"))
    assert {r.body: r.ok for r in tested.collect()} == bodies
    assert tested._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator") == 1
