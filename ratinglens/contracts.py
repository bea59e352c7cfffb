"""Table contracts: fixed schemas, header aliases, and the checks around them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratinglens.report_texts import SUMMARY_ZH

# Source header -> column name, in contract order, per table.
HEADERS: dict[str, dict[str, str]] = {
    "candidates": {
        "豆瓣ID": "entity_id",
        "电影名称": "title",
        "搜索评分": "search_score",
        "URL": "url",
        "采集时间": "captured_at",
    },
    "tag_links": {
        "豆瓣ID": "entity_id",
        "标签": "tag",
        "标签内排名": "rank",
        "采集时间": "captured_at",
    },
    "details": {
        "豆瓣ID": "entity_id",
        "电影名称": "title",
        "原始片名": "original_title",
        "导演": "directors",
        "主演": "actors",
        "上映年份": "year",
        "首映日期": "release_date",
        "类型": "categories",
        "国家/地区": "places",
        "片长": "runtime",
        "豆瓣评分": "score",
        "评价人数": "votes",
        "短评总数": "short_count",
        "长评总数": "long_count",
        "采集时间": "captured_at",
    },
    "comments": {
        "短评ID": "comment_id",
        "豆瓣ID": "entity_id",
        "电影名称": "title",
        "评分": "star",
        "短评正文": "body",
        "有用数": "useful",
        "评论时间": "commented_at",
        "采样方式": "sample_label",
        "排序位置": "position",
        "采集时间": "captured_at",
    },
    "sample_progress": {
        "豆瓣ID": "entity_id",
        "电影名称": "title",
        "采样方式": "sample_label",
        "目标数": "target",
        "已采集数": "held",
        "状态": "status",
        "更新时间": "updated_at",
    },
    "failures": {
        "豆瓣ID": "entity_id",
        "电影名称": "title",
        "最后失败原因": "last_reason",
        "首次失败轮次": "first_round",
        "最后失败轮次": "last_round",
        "失败轮次数": "failed_rounds",
        "永久失败轮次数": "permanent_rounds",
        "连续永久失败轮次数": "permanent_streak",
        "状态": "status",
        "首次失败时间": "first_failed_at",
        "最后更新时间": "updated_at",
    },
    "failure_attempts": {
        "豆瓣ID": "entity_id",
        "电影名称": "title",
        "轮次": "round",
        "轮内尝试序号": "attempt",
        "尝试层级": "level",
        "失败原因": "reason",
        "失败时间": "failed_at",
    },
}

# Derived columns of the cleaned tables, for export under the source headers.
DERIVED_HEADERS = {
    "release_year": "首映年份_日期",
    "release_month": "首映月份",
    "release_day": "首映日",
    "release_iso": "首映日期标准化",
    "release_precision": "首映日期精度",
    "runtime_min": "片长分钟",
    "main_category": "主类型",
    "category_count": "类型数",
    "origin": "产地分类",
    "short_rate": "短评参与率",
    "long_rate": "长评参与率",
    "in_rating_sample": "纳入评分分析",
    "in_study_period": "纳入类型趋势分析",
    "shrunk_score": "贝叶斯加权评分",
    "quality_flags": "数据质量标记",
    "star_value": "评分值",
}


# Column name -> published header, in published order, per result table.
RESULT_HEADERS: dict[str, dict[str, str]] = {
    "report": {"metric": "指标", "scope": "统计口径", "n": "数量", "share": "占统计口径比例", "note": "说明"},
    "rules": {
        "rule": "规则ID", "field": "字段", "criterion": "判定标准", "action": "处理方式", "hit_kind": "命中类型", "reason": "选择原因",
        "rejected": "未采用方法", "hits": "命中记录数",
    },
    "shrinkage": {
        "entity_id": "豆瓣ID", "title": "电影名称", "score": "豆瓣评分", "votes": "评价人数", "shrunk_score": "贝叶斯加权评分",
        "difference": "收缩差值",
    },
    "quadrants": {"entity_id": "豆瓣ID", "title": "电影名称", "score": "豆瓣评分", "votes": "评价人数", "quadrant": "四象限"},
    "quadrant_counts": {"quadrant": "四象限", "n": "电影数"},
    "quadrant_sensitivity": {
        "score_threshold": "评分阈值", "vote_quantile": "评价人数分位数", "vote_threshold": "评价人数阈值", "high_niche": "高分小众数",
        "high_mass": "高分大众数",
    },
    "metric_comparison": {
        "entity_id": "豆瓣ID", "title": "电影名称", "sample_label": "采样方式", "rated": "有效评分样本数", "mean_star": "平均星级",
        "useful_weighted_star": "原始有用数加权星级", "log_weighted_star": "对数有用数加权星级", "five_star_share": "五星样本占比",
        "five_star_low": "五星占比95%CI下限", "five_star_high": "五星占比95%CI上限", "star_entropy": "星级分布熵", "score": "豆瓣评分",
        "sample_ten": "样本平均换算十分制", "sample_minus_score": "样本与总体评分差",
    },
    "yearly_counts": {"year": "上映年份", "n": "电影数"},
    "yearly_category_share": {"year": "上映年份", "category": "类型", "weight": "类型权重", "share": "类型占比"},
    "yearly_origin_share": {"year": "上映年份", "origin": "产地分类", "n": "电影数", "share": "产地占比"},
    "origin_statistics": {
        "origin": "产地分类", "n": "电影数", "mean_score": "评分均值", "median_score": "评分中位数", "median_votes": "评价人数中位数",
    },
    "category_origin_table": {"category": "类型"},
    "tag_coverage": {"year": "上映年份", "tag": "标签", "entities": "独立电影数"},
    "summary": {"module": "分析模块", "metric": "指标", "value": "数值"},
}


def fields_of(table: str) -> list[str]:
    return list(HEADERS[table].values())


def bronze_schema(table: str) -> T.StructType:
    """All-text schema: nothing is inferred, casting happens in cleaning."""
    return T.StructType([T.StructField(name, T.StringType()) for name in fields_of(table)])


class ContractError(ValueError):
    """A table does not carry the columns its contract asks for."""


def require_columns(df: DataFrame, columns: Iterable[str], table: str = "table") -> DataFrame:
    """Fail before any job, naming every missing column."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ContractError(f"{table} lacks required columns: {', '.join(missing)}")
    return df


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the contract columns in contract order; extra columns are dropped."""
    require_columns(df, columns)
    return df.select(*columns)


def check_same_header(existing: Sequence[str], wanted: Sequence[str], where: str) -> None:
    """Exact name and order test made before an append."""
    if list(existing) != list(wanted):
        raise ContractError(
            f"columns at {where} differ from the contract: found {list(existing)}, expected {list(wanted)}"
        )


def check_same_types(existing: DataFrame, new: DataFrame, where: str) -> None:
    """Exact type test made before an append; whether a column may be NULL plays no part."""
    odd = [f"{a} {t} in place of {u}" for (a, u), (_, t) in zip(existing.dtypes, new.dtypes, strict=True) if t != u]
    if odd:
        raise ContractError(f"column types at {where} differ: {', '.join(odd)}")


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def rename_headers(df: DataFrame, table: str) -> DataFrame:
    """Source headers to column names; columns outside the contract are kept as they are."""
    return df.withColumnsRenamed(HEADERS[table])


def export_headers(df: DataFrame, table: str) -> DataFrame:
    """Column names back to source headers, for tables handed to other tools."""
    names = {name: header for header, name in HEADERS[table].items()} | DERIVED_HEADERS
    return df.select([F.col(c).alias(names.get(c, c)) for c in df.columns])


def export_result(df: DataFrame, table: str) -> DataFrame:
    """A result table under its published headers and in their order; the names in a summary are the published ones.

    Columns without a header, such as the classes of the category table, follow as they are, but for line numbers.
    """
    names = RESULT_HEADERS[table]
    require_columns(df, names, table)
    if table == "summary":
        published = F.create_map(*(F.lit(x) for pair in SUMMARY_ZH.items() for x in pair))
        df = df.withColumns({c: F.coalesce(published[F.col(c)], F.col(c)) for c in ("module", "metric")})
    others = [c for c in df.columns if c not in names and c != "line"]
    return df.select(*(F.col(c).alias(header) for c, header in names.items()), *(F.col(f"`{c}`") for c in others))
