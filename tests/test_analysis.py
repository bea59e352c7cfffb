"""From dirty rows to the result tables."""

from __future__ import annotations

import pytest

from ratinglens.contracts import RESULT_HEADERS, bronze_schema, empty_table, export_result
from ratinglens.operators.categories import grouped_category_share, sliding_category_share
from ratinglens.operators.stats import star_metrics
from ratinglens.plans.analysis import analysis_tables
from ratinglens.plans.cleaning import clean_comments, clean_entities
from ratinglens.session import staged
from tests.test_cleaning import comments, table
from workload.standins import entities


def test_all_result_tables(spark):
    rows = [
        {"entity_id": str(i), "year": str(2004 + i), "score": str(5 + i % 4), "votes": str(10 * i), "categories": "a / b" if i % 2 else "b",
         "places": "中国大陆" if i % 3 else "日本"}
        for i in range(1, 9)
    ]
    cleaned = staged(clean_entities(table(spark, *rows)).cleaned, "cleaned")
    metrics = star_metrics(clean_comments(comments(spark, [{"entity_id": "1"}, {"entity_id": "1", "comment_id": "r2", "star": "3星"}])))
    links = spark.createDataFrame([("1", "t"), ("1", "t"), ("2", "t")], "entity_id string, tag string")
    candidates = spark.createDataFrame([(str(i),) for i in range(1, 11)], "entity_id string")
    state = spark.createDataFrame([("10", "不可用")], "entity_id string, status string")
    found = {name: df.collect() for name, df in analysis_tables(cleaned, metrics, links, candidates, state).items()}
    assert all(found.values())
    summary = {r.metric: r.value for r in found["summary"]}
    assert len(summary) == 17
    assert summary["valid_entities"] == 8 and summary["unavailable_ratio"] == pytest.approx(0.1)
    assert summary["period_entities"] == 8 and summary["yearly_min"] == 0
    assert summary["entities_with_comments"] == 1 and summary["sample_minus_score_mean"] == pytest.approx((4 + 3) / 2 * 2 - 6)
    assert len(found["yearly_counts"]) == 21 and {r.entities for r in found["tag_coverage"]} == {1}
    shares = {}
    for r in found["yearly_category_share"]:
        shares[r.year] = shares.get(r.year, 0) + r.share
    assert set(shares.values()) == {1.0}
    drops = [r.difference for r in found["shrinkage"]]
    assert drops == sorted(drops, reverse=True)


def test_absent_inputs_are_empty_tables(spark):
    cleaned = clean_entities(table(spark, {})).cleaned
    metrics = star_metrics(clean_comments(comments(spark, [{}]).where("false")))
    links = empty_table(spark, bronze_schema("tag_links"))
    nobody = spark.createDataFrame([], "entity_id string, status string")
    tables = analysis_tables(cleaned, metrics, links, nobody.select("entity_id"), nobody)
    assert tables["tag_coverage"].count() == 0
    summary = {r.metric: r.value for r in tables["summary"].collect()}
    assert summary["unavailable_ratio"] is None and summary["home_import_cohens_d"] is None


def test_result_tables_under_their_published_headers(spark):
    cleaned = clean_entities(table(spark, *[{"entity_id": str(i), "year": str(2004 + i)} for i in range(1, 4)]))
    metrics = star_metrics(clean_comments(comments(spark, [{"entity_id": "1"}])))
    links = spark.createDataFrame([("1", "t")], "entity_id string, tag string")
    state = spark.createDataFrame([("9", "不可用")], "entity_id string, status string")
    found = analysis_tables(staged(cleaned.cleaned, "cleaned"), metrics, links, links.select("entity_id"), state)
    found |= {"report": cleaned.report, "rules": cleaned.rules}
    assert set(found) == set(RESULT_HEADERS)
    for name, df in found.items():
        out = export_result(df, name)
        headers = list(RESULT_HEADERS[name].values())
        assert out.columns[: len(headers)] == headers
        assert name == "category_origin_table" or out.columns == headers
    summary = {tuple(r)[:2] for r in export_result(found["summary"], "summary").collect()}
    assert ("数据质量", "阶段二不可用比例") in summary and ("B", "2005-2025电影数") in summary and len(summary) == 17
    report = {r["指标"]: r for r in export_result(found["report"], "report").collect()}
    assert report["2005-2025类型趋势样本数"]["数量"] == 3 and report["原始记录数"]["统计口径"] == "原始输入"
    rules = {r["规则ID"]: r for r in export_result(found["rules"], "rules").collect()}
    assert rules["R11"]["判定标准"] == "上映年份在2005—2025" and rules["R02"]["命中类型"] == "删除记录" and len(rules) == 13


def test_shares_over_neighbouring_years_count_all_their_rows(spark):
    rows = [(2010, "a"), (2010, "b"), (2011, "b"), (2013, "a"), (2013, "b"), (2013, "b"), (2020, "a")]
    df = spark.createDataFrame(rows, "year int, categories string")
    got = {(r.year, r.category): r.share for r in sliding_category_share(df, (2010, 2014), 1).collect()}
    assert got == pytest.approx(
        {
            (2010, "a"): 1 / 3, (2010, "b"): 2 / 3, (2011, "a"): 1 / 3, (2011, "b"): 2 / 3, (2012, "b"): 3 / 4, (2012, "a"): 1 / 4,
            (2013, "a"): 1 / 3, (2013, "b"): 2 / 3, (2014, "a"): 1 / 3, (2014, "b"): 2 / 3,
        }
    )
    groups = {(r.span, r.category): r.share for r in grouped_category_share(df, (2010, 2020), 5).collect()}
    assert groups == pytest.approx({(2010, "a"): 2 / 6, (2010, "b"): 4 / 6, (2020, "a"): 1.0})


def test_origins_without_sets_of_places(spark, tmp_path):
    regions = ["ASIA", "AFRICA", "EUROPE", "MIDDLE EAST", "null", None]
    made = {
        "region": ([(i, r) for i, r in enumerate(regions)], "r_regionkey long, r_name string"),
        "nation": ([(i, i) for i in range(6)], "n_nationkey long, n_regionkey long"),
        "supplier": ([(i, i) for i in range(6)] + [(5, 2)], "s_suppkey long, s_nationkey long"),
        "part": ([(1, "STEEL"), (2, "TIN"), (2, "TIN"), (None, "TIN")], "p_partkey long, p_type string"),
        # every set of regions, one without lines, a repeated order and one without a key
        "orders": ([(k, 10.0, None) for k in [*range(64), 99, 1, None]], "o_orderkey long, o_totalprice double, o_orderdate date"),
        "lineitem": (
            [(k, 1, s, 2.0) for k in range(64) for s in range(6) if k >> s & 1] + [(7, 1, None, 1.0), (None, 1, 0, 1.0), (3, 2, 0, 4.0)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    columns = ("entity_id", "origin", "score", "votes", "short_rate")
    narrow, whole = entities(spark, str(tmp_path), columns), entities(spark, str(tmp_path)).select(*columns)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.collect()))
    assert "collect_set" not in narrow._jdf.queryExecution().optimizedPlan().toString()
