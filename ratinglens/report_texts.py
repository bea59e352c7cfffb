"""Texts of the quality report, the rule table and the summary."""

from __future__ import annotations

from dataclasses import dataclass

from ratinglens.labels import ZH, Labels


@dataclass(frozen=True)
class ReportTexts:
    """Names of the scopes; name and note of each metric; field, criterion, action, kind of hit, reason and rejected option of each rule."""

    raw: str
    unique: str
    metrics: dict[str, tuple[str, str]]
    rules: dict[str, tuple[str, str, str, str, str, str]]


# The published texts; {start} and {end} are the years of the study.
ZH_TEXTS = ReportTexts(
    raw="原始输入",
    unique="清洗后唯一记录",
    metrics={
        "rows_in": ("原始记录数", "阶段二 movies.csv 输入行数"),
        "missing_id": ("缺失豆瓣ID记录数", "无稳定主键，无法关联，清洗表删除"),
        "duplicate_id": ("重复豆瓣ID记录数", "按采集时间保留最新快照"),
        "cleaned_rows": ("清洗后记录数", "保留全部有主键的唯一记录"),
        "no_valid_rating": ("无有效评分记录数", "评分置为空，不做均值填补"),
        "rating_sample": ("评分分析样本数", "评分>0且评价人数>0"),
        "study_sample": ("{start}-{end}类型趋势样本数", "只在课题B分析时筛选，不从清洗表删除"),
        "before_period": ("研究期前年份记录数", "保留，用于课题A和样本说明"),
        "after_period": ("研究期后年份记录数", "保留，不进入课题B"),
        "year_missing": ("上映年份缺失记录数", "置为空并标记为缺失"),
        "year_invalid": ("上映年份异常记录数", "置为空并标记"),
        "capture_missing": ("采集时间缺失记录数", "置为空并标记"),
        "capture_invalid": ("采集时间异常记录数", "无法解析或缺少时区，置为空并标记；去重时有效时间优先"),
        "release_not_day": ("首映日期非日精度记录数", "不虚构月份或日期"),
        "runtime_bad": ("片长缺失或异常记录数", "片长分钟置为空"),
        "category_missing": ("类型缺失记录数", "类型填为未知并标记"),
        "place_missing": ("国家地区缺失记录数", "国家地区填为未知并标记"),
        "original_title_missing": ("原始片名缺失记录数", "保留；可能表示没有单独的外文或原始片名"),
        "directors_missing": ("导演缺失记录数", "保留并披露"),
        "actors_missing": ("主演缺失记录数", "保留并披露"),
        "count_invalid": ("计数字段异常记录数", "置为空，不四舍五入或裁剪"),
        "comments_without_rating": ("无评分但有短评记录数", "保留短评总数，评分分析排除"),
    },
    rules={
        "R01": ("文本字段", "首尾/重复空白、占位符、多值分隔不一致", "去空白、占位符转缺失、类型和国家地区统一为“ / ”分隔", "格式标准化", "统一格式但不改变实体含义", "不对片名和人名做模糊合并"),
        "R02": ("豆瓣ID", "豆瓣ID重复", "按采集时间保留最新快照", "删除记录", "同一实体只保留一个分析时点", "不按电影名称去重，同名电影可能是不同作品"),
        "R03": ("豆瓣ID", "主键缺失", "从清洗表删除，原始表保留", "删除记录", "无法与标签、评论表可靠关联", "不人工生成替代ID"),
        "R04": ("豆瓣评分/评价人数", "评分不在(0,10]或评价人数<=0", "评分置为空，记录保留，排除课题A", "置空并排除", "0代表未形成有效评分，不代表作品得0分", "不以0分或总体均值填补"),
        "R05": ("评价人数/短评总数/长评总数", "非数字、负数或非整数", "置为空并标记", "置空", "计数必须为非负整数", "不四舍五入、不裁剪为0"),
        "R06": ("上映年份", "缺失、非整数、早于1888或晚于采集年份+1", "置为空并标记", "置空", "采用电影史和原始时区年份；单条时间无效时回退到数据集最大有效采集年，整列无效时回退到研究结束年+1", "不直接删除整行"),
        "R07": ("首映日期", "识别年、年月、完整日期和异常四种精度", "保留原文，另建标准日期和精度字段", "精度分类", "避免把只有年份的数据虚构为1月1日", "不强制填充缺失的月和日"),
        "R08": ("片长", "提取首个1—1440分钟整数", "生成片长分钟，无法提取则置空", "置空", "原始片长文本可能包含版本说明", "不丢弃原始片长文本"),
        "R09": ("国家/地区", "中国大陆、港澳台与海外组合", "分为中国大陆、合拍、港澳台、进口、未知", "派生字段", "避免把合拍片强行二分", "不简单按国产/进口二分类"),
        "R10": ("课题A样本", "评分>0且评价人数>0", "生成纳入评分分析标志", "纳入样本", "评分可信度分析需要有效评分和分母", "不按评价人数主观删掉小众作品"),
        "R11": ("课题B样本", "上映年份在{start}—{end}", "生成纳入类型趋势分析标志", "纳入样本", "与研究时间边界一致，清洗主表仍保留其他年份", "不提前删除研究期外数据"),
        "R12": ("贝叶斯加权评分", "C为有效样本均值，m为评价人数中位数", "对小样本极端评分向总体均值收缩", "派生指标", "保留小众作品，同时降低小样本波动影响", "不设置单一评价人数硬门槛"),
        "R13": ("采集时间", "时间缺失、不能解析或原文不含时区", "置为空并标记；去重时有效时间优先", "质量异常", "防止把无效时间误认为最新快照", "不根据文件顺序伪造采集时间"),
    },
)

EN_TEXTS = ReportTexts(
    raw="raw input",
    unique="unique cleaned rows",
    metrics={
        "rows_in": ("rows_in", "rows read"),
        "missing_id": ("missing_id", "no stable key: dropped from the cleaned table"),
        "duplicate_id": ("duplicate_id", "newest capture kept"),
        "cleaned_rows": ("cleaned_rows", "every keyed entity once"),
        "no_valid_rating": ("no_valid_rating", "score emptied, never imputed"),
        "rating_sample": ("rating_sample", "score above 0 and votes above 0"),
        "study_sample": ("study_sample", "selected at analysis time only"),
        "before_period": ("before_period", "kept, described with the sample"),
        "after_period": ("after_period", "kept, outside the trend study"),
        "year_missing": ("year_missing", "empty and flagged"),
        "year_invalid": ("year_invalid", "emptied and flagged"),
        "capture_missing": ("capture_missing", "empty and flagged"),
        "capture_invalid": ("capture_invalid", "unparsable or without zone: emptied and flagged"),
        "release_not_day": ("release_not_day", "no month or day is invented"),
        "runtime_bad": ("runtime_bad", "minutes emptied"),
        "category_missing": ("category_missing", "filled with unknown and flagged"),
        "place_missing": ("place_missing", "filled with unknown and flagged"),
        "original_title_missing": ("original_title_missing", "often has no separate original title"),
        "directors_missing": ("directors_missing", "kept and reported"),
        "actors_missing": ("actors_missing", "kept and reported"),
        "count_invalid": ("count_invalid", "emptied, neither rounded nor clipped"),
        "comments_without_rating": ("comments_without_rating", "comment count kept, outside the rating sample"),
    },
    rules={
        "R01": ("text fields", "white space, placeholders, uneven part separators", "normalise to one form", "format", "one form without changing the entity", "no fuzzy merging of names"),
        "R02": ("entity id", "id occurs more than once", "keep the newest capture", "rows dropped", "one observation per entity", "no merging by title"),
        "R03": ("entity id", "id missing", "drop from the cleaned table", "rows dropped", "cannot be linked to tags or comments", "no made-up ids"),
        "R04": ("score, votes", "score outside (0,10] or no votes", "empty the score, keep the row", "emptied and excluded", "zero means not rated", "no zero and no mean imputed"),
        "R05": ("counts", "not a whole number of at least zero", "empty and flag", "emptied", "counts are non-negative integers", "no rounding, no clipping"),
        "R06": ("year", "missing, fractional, too old or past capture year + 1", "empty and flag", "emptied", "limit from the local capture year, else the newest one known", "row is not dropped"),
        "R07": ("release date", "precision of year, month, day or invalid", "keep the text, add date and precision", "precision class", "a bare year is not January 1", "no forced month or day"),
        "R08": ("runtime", "first whole number of 1 to 1440 minutes", "add minutes, else empty", "emptied", "text may describe several cuts", "text is not discarded"),
        "R09": ("places", "home, special regions and foreign places", "classify in five classes", "derived field", "co-productions are a class of their own", "no two-way split"),
        "R10": ("rating sample", "valid score and votes", "add inclusion mark", "sample", "needs a score and a denominator", "no cut on popularity"),
        "R11": ("study sample", "year inside the study period", "add inclusion mark", "sample", "matches the study period", "rows outside are not deleted"),
        "R12": ("shrunk score", "overall mean and median votes of the valid sample", "shrink towards the mean", "derived measure", "damps extremes of small samples", "no hard vote threshold"),
        "R13": ("capture time", "missing, unparsable or without zone", "empty and flag; valid times win", "quality issue", "a bad time must not look newest", "no time from row order"),
    },
)


def texts_of(labels: Labels) -> ReportTexts:
    """The published texts go with the published labels."""
    return ZH_TEXTS if labels == ZH else EN_TEXTS


# Published names of the summary's modules and metrics.
SUMMARY_ZH = {
    "quality": "数据质量",
    "valid_entities": "有效电影数",
    "score_mean": "评分均值",
    "score_median": "评分中位数",
    "votes_score_spearman": "评价人数与评分Spearman",
    "short_rate_score_spearman": "短评参与率与评分Spearman",
    "short_rate_votes_spearman": "短评参与率与评价人数Spearman",
    "long_rate_score_spearman": "长评参与率与评分Spearman",
    "long_rate_votes_spearman": "长评参与率与评价人数Spearman",
    "entities_with_comments": "有短评评分的电影数",
    "sample_minus_score_mean": "热门短评样本与总体评分平均差",
    "period_entities": "2005-2025电影数",
    "yearly_min": "年度最小样本数",
    "yearly_median": "年度样本数中位数",
    "home_import_cohens_d": "中国大陆与进口评分Cohen_d",
    "candidates": "阶段一候选电影数",
    "unavailable": "阶段二确认不可用数",
    "unavailable_ratio": "阶段二不可用比例",
}
