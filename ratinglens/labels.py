"""Label vocabularies for derived text values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Labels:
    """Every text value the operators write into a result."""

    # origin classes
    home: str
    special: str
    coproduction: str
    imported: str
    unknown: str
    # release date precision
    day: str
    month: str
    year: str
    missing: str
    invalid: str
    # quality flags, in output order
    no_rating: str
    comments_without_rating: str
    count_invalid: str
    year_missing: str
    year_invalid: str
    capture_missing: str
    capture_invalid: str
    release_missing: str
    release_invalid: str
    runtime_bad: str
    category_missing: str
    place_missing: str
    short_over: str
    long_over: str
    normal: str
    # quadrants
    high: str
    low: str
    mass: str
    niche: str
    # failure status and reasons
    pending: str
    recovered: str
    unavailable: str
    network_failure: str
    parse_failure: str
    # sample status
    done: str
    exhausted: str
    failed: str
    todo: str
    # star text
    star_suffix: str
    unrated: str


# The label texts of the published data contract.
ZH = Labels(
    home="中国大陆",
    special="港澳台",
    coproduction="合拍",
    imported="进口",
    unknown="未知",
    day="日",
    month="月",
    year="年",
    missing="缺失",
    invalid="异常",
    no_rating="无有效评分",
    comments_without_rating="无评分但有短评",
    count_invalid="计数字段异常",
    year_missing="上映年份缺失",
    year_invalid="上映年份异常",
    capture_missing="采集时间缺失",
    capture_invalid="采集时间异常",
    release_missing="首映日期缺失",
    release_invalid="首映日期异常",
    runtime_bad="片长缺失或异常",
    category_missing="类型缺失",
    place_missing="国家地区缺失",
    short_over="短评数大于评价人数",
    long_over="长评数大于评价人数",
    normal="正常",
    high="较高分",
    low="较低分",
    mass="大众",
    niche="小众",
    pending="待复核",
    recovered="已恢复",
    unavailable="不可用",
    network_failure="网络请求失败",
    parse_failure="JSON解析失败",
    done="完成",
    exhausted="已穷尽",
    failed="失败",
    todo="待采集",
    star_suffix="星",
    unrated="未评分",
)

EN = Labels(
    home="domestic",
    special="special",
    coproduction="co-production",
    imported="import",
    unknown="unknown",
    day="day",
    month="month",
    year="year",
    missing="missing",
    invalid="invalid",
    no_rating="no valid rating",
    comments_without_rating="comments without rating",
    count_invalid="count field invalid",
    year_missing="year missing",
    year_invalid="year invalid",
    capture_missing="capture time missing",
    capture_invalid="capture time invalid",
    release_missing="release date missing",
    release_invalid="release date invalid",
    runtime_bad="runtime missing or invalid",
    category_missing="category missing",
    place_missing="place missing",
    short_over="short comments exceed votes",
    long_over="long comments exceed votes",
    normal="normal",
    high="high",
    low="low",
    mass="mass",
    niche="niche",
    pending="pending",
    recovered="recovered",
    unavailable="unavailable",
    network_failure="network failure",
    parse_failure="JSON parse failure",
    done="done",
    exhausted="exhausted",
    failed="failed",
    todo="todo",
    star_suffix=" stars",
    unrated="unrated",
)

# Place names of the home market and its special regions.
HOME_PLACE = "中国大陆"
SPECIAL_PLACES = ("中国香港", "中国台湾", "中国澳门")

# Texts that stand for a missing value, compared in lower case.
PLACEHOLDERS = ("", "nan", "none", "null", "暂无", "<na>")

# Failure reasons that count as permanent.
PERMANENT_REASONS = ("HTTP 400", "HTTP 404", "HTTP 410")

# Study period, oldest plausible year, longest runtime in minutes.
STUDY_YEARS = (2005, 2025)
OLDEST_YEAR = 1888
LONGEST_RUNTIME = 1440
