"""Reading, shaping, normalising, validating and cleaning records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens import contracts
from ratinglens.functions.dates import capture_instant, capture_local_year, date_in_text, partial_date
from ratinglens.functions.numbers import (
    integer_or_zero,
    nonnegative_integer,
    runtime_minutes,
    to_number,
    valid_rating,
    valid_year,
)
from ratinglens.functions.rating import origin_class
from ratinglens.functions.text import clean_text, entity_id_of_url, join_parts, main_part, multivalue
from ratinglens.labels import EN
from ratinglens.operators.coverage import tag_completeness
from ratinglens.operators.crawl_log import page_outcomes
from ratinglens.operators.membership import held_counts, status_after_run
from ratinglens.operators.snapshot import source_order
from ratinglens.plans.cleaning import (
    clean_comments,
    clean_entities,
    entity_snapshot,
    mark_entities,
    normalise_entities,
)
from ratinglens.report_texts import EN_TEXTS
from ratinglens.session import durable_path, staged
from ratinglens.sources import landed, payloads, tables, versions
from workload.standins import (
    COMMENT_ORDER,
    HOME,
    LIMITS,
    QUALITY_FLAGS_SQL,
    RULES,
    SPECIAL,
    comments_raw,
    entities,
    entities_raw,
    table,
    with_ctes,
)


def _r(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


def _cleaned(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return clean_entities(entities_raw(spark, d), RULES, columns=columns).cleaned


def _marked(spark: SparkSession, d: str) -> DataFrame:
    snapshot = entity_snapshot(entities_raw(spark, d), RULES.ties)
    return mark_entities(staged(snapshot, "entity-snapshot"), RULES)


# --- sources and sinks ----------------------------------------------------------


def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Export under the source headers, scan back as text, missing-value tokens to NULL."""
    path = durable_path(spark, "details-csv")
    tables.export_csv(entities_raw(spark, d).drop("seq"), path, "details")
    found = tables.missing_as_null(tables.read_csv(spark, path, "details"))
    return found.select("entity_id", "title", "original_title", "year", "categories", "score", "captured_at")


CSV_SCAN = with_ctes(
    "entities_raw",
    body="""SELECT entity_id, title, nullif(original_title, '') AS original_title, year, categories, score, captured_at
            FROM entities_raw""",
)


def optional_source(spark: SparkSession, d: str) -> DataFrame:
    """An absent comment table is an empty one: every entity holds zero comments."""
    held = tables.read_optional(spark, durable_path(spark, "absent"), "comments").groupBy("entity_id").count()
    joined = entities(spark, d).select("entity_id", "year").join(held, "entity_id", "left")
    return joined.groupBy("year").agg(
        F.count("*").alias("entities"), F.sum(F.coalesce("count", F.lit(0))).cast("bigint").alias("comments")
    )


OPTIONAL_SOURCE = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS entities, CAST(0 AS BIGINT) AS comments
                     FROM orders GROUP BY 1"""


def optional_tables(spark: SparkSession, d: str) -> DataFrame:
    """Links per tag from a stored optional table and from an absent one, read the same way."""
    path = durable_path(spark, "tag-links")
    orders = table(spark, d, "orders")
    links = orders.select(
        F.col("o_orderkey").cast("string").alias("entity_id"), F.col("o_orderpriority").alias("tag"), F.lit("1").alias("rank"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("captured_at"),
    )
    tables.overwrite_table(links.where("entity_id % 2 = 0"), path, contracts.fields_of("tag_links"))
    both = [tables.read_optional(spark, p, "tag_links").withColumn("stored", F.lit(p == path)) for p in (path, f"{path}-absent")]
    tags = orders.select(F.col("o_orderpriority").alias("tag")).distinct()
    counted = both[0].unionByName(both[1]).groupBy("tag").agg(F.count_if("stored").alias("stored"), F.count_if(~F.col("stored")).alias("absent"))
    return tags.join(counted, "tag", "left").select("tag", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("stored", "absent")))


OPTIONAL_TABLES = """
SELECT o_orderpriority AS tag, count(*) FILTER (o_orderkey % 2 = 0) AS stored, CAST(0 AS BIGINT) AS absent FROM orders GROUP BY 1"""


def contract_append(spark: SparkSession, d: str) -> DataFrame:
    """Overwrite with one status class, append the others after the column test, read back."""
    path = durable_path(spark, "candidates")
    orders = table(spark, d, "orders")
    rows = orders.select(
        F.col("o_orderkey").cast("string").alias("entity_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderstatus").alias("search_score"),
        F.lit("").alias("url"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("captured_at"),
        F.col("o_orderstatus").alias("extra"),
    )
    columns = contracts.fields_of("candidates")
    tables.overwrite_table(rows.where("extra = 'F'"), path, columns)
    tables.append_table(rows.where("extra <> 'F'"), path, columns)
    return tables.read_parquet(spark, path, "candidates")


CONTRACT_APPEND = """SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, 'Order ' || o_orderkey AS title,
                     o_orderstatus AS search_score, '' AS url, strftime(o_orderdate, '%Y-%m-%d') AS captured_at FROM orders"""


def detail_responses(spark: SparkSession, d: str) -> DataFrame:
    """API responses made of orders and customers, with every kind of failure among them."""
    orders = table(spark, d, "orders")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    k = F.col("o_orderkey")
    people = F.transform(
        F.sequence(F.lit(1), (k % 20 + 1).cast("int")),
        lambda i: F.struct(
            F.when(i % 7 == 0, "").otherwise(F.concat(F.lit(" Actor "), i.cast("string"))).alias("name"),
            i.alias("rank"),
        ),
    )
    body = F.to_json(
        F.struct(
            F.concat(F.lit("Order "), k.cast("string")).alias("title"),
            F.when(k % 4 != 0, F.concat(F.lit("Original "), k.cast("string"))).alias("original_title"),
            F.year("o_orderdate").alias("year"),
            F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-M-d")).alias("release_date"),
            F.array(F.concat(F.date_format("o_orderdate", "yyyy-M"), F.lit("(x)"))).alias("pubdate"),
            F.array("c_mktsegment", "o_orderpriority").alias("genres"),
            F.array(F.struct(F.col("c_name").alias("name"))).alias("directors"),
            people.alias("actors"),
            F.when(k % 6 != 0, F.struct((k % 100 / 10).alias("value"), (k % 1000).alias("count"))).alias("rating"),
            (k % 77).alias("comment_count"),
        )
    )
    # one small file holds the orders: spread them before the bodies are built
    spread = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spread.join(customers, "o_custkey", "left").select(
        k.cast("string").alias("entity_id"),
        F.when(k % 17 == 0, 404).when(k % 19 == 0, F.lit(None)).otherwise(200).cast("int").alias("status"),
        F.when(k % 23 == 0, "[]").when(k % 29 == 0, "{broken").otherwise(body).alias("body"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'").alias("captured_at"),
    )


def landing(spark: SparkSession, d: str) -> str:
    """Folder of JSON lines with all responses; one order in 31 has a second line that breaks off."""
    path = durable_path(spark, "landed-lines")
    responses = detail_responses(spark, d)
    whole = responses.select(F.col("entity_id").cast("bigint").alias("key"), F.to_json(F.struct(*responses.columns)).alias("value"))
    key = F.col("key")
    lines = F.when(key % 31 == 0, F.array("value", F.expr("left(value, 40)"))).otherwise(F.array("value"))
    whole.select(F.explode(lines).alias("value")).write.text(path)
    return path


def landed_responses(spark: SparkSession, d: str) -> DataFrame:
    """The landed lines read back and stored, bodies parsed once."""
    table_path = durable_path(spark, "landed-details")
    landed.store(landed.read_landed(spark, landing(spark, d), "details"), table_path)
    return versions.read(spark, table_path)


def detail_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Landed files to contract rows."""
    return payloads.detail_rows(landed_responses(spark, d), EN)


_NAMES = ", ".join(f"CASE WHEN n >= {i} THEN 'Actor {i}' END" for i in range(1, 16) if i % 7)
DETAIL_PAYLOADS = f"""
SELECT CAST(k AS VARCHAR) AS entity_id, 'Order ' || k AS title,
       CASE WHEN k % 4 <> 0 THEN 'Original ' || k ELSE '' END AS original_title, c_name AS directors,
       concat_ws(' / ', {_NAMES}) AS actors, strftime(o_orderdate, '%Y') AS year,
       CASE WHEN k % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m') END AS release_date,
       c_mktsegment || ' / ' || o_orderpriority AS categories, '' AS places, '' AS runtime,
       CASE WHEN k % 6 <> 0 THEN CAST((k % 100) / 10 AS VARCHAR) ELSE '' END AS score,
       CASE WHEN k % 6 <> 0 THEN CAST(k % 1000 AS VARCHAR) ELSE '' END AS votes,
       CAST(k % 77 AS VARCHAR) AS short_count, '' AS long_count, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS captured_at
FROM (SELECT o_orderkey AS k, o_orderkey % 20 + 1 AS n, * FROM orders) o LEFT JOIN customer ON c_custkey = o_custkey
WHERE k % 17 <> 0 AND k % 19 <> 0 AND k % 23 <> 0 AND k % 29 <> 0"""


def payload_triage(spark: SparkSession, d: str) -> DataFrame:
    """Whole lines that tell of a failure."""
    return payloads.failed_responses(landed_responses(spark, d).where("malformed IS NULL"), EN)


PAYLOAD_TRIAGE = """
SELECT CAST(k AS VARCHAR) AS entity_id,
       CASE WHEN k % 17 = 0 THEN 'HTTP 404' WHEN k % 19 = 0 THEN 'network failure' ELSE 'JSON parse failure' END AS reason,
       strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS failed_at
FROM (SELECT o_orderkey AS k, o_orderdate FROM orders)
WHERE k % 17 = 0 OR k % 19 = 0 OR k % 23 = 0 OR k % 29 = 0"""


def landed_failures(spark: SparkSession, d: str) -> DataFrame:
    """Failures by reason, with the lines that broke off and the entities they still name."""
    failed = payloads.failed_responses(landed_responses(spark, d), EN)
    return failed.groupBy("reason").agg(
        F.count("*").alias("failures"), F.count("failed_at").alias("timed"), F.countDistinct("entity_id").alias("entities")
    )


LANDED_FAILURES = f"""
SELECT reason, count(*) AS failures, count(failed_at) AS timed, count(DISTINCT entity_id) AS entities
FROM ({PAYLOAD_TRIAGE}
      UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'JSON parse failure', NULL FROM orders WHERE o_orderkey % 31 = 0)
GROUP BY reason"""


def streamed_landing(spark: SparkSession, d: str) -> DataFrame:
    """The landing folder read as a stream, three files a batch, stored with parsed bodies, and shaped from the store."""
    table_path = durable_path(spark, "landed-stream")
    lines = landed.read_landed(spark, landing(spark, d), "details", stream=True, files_per_batch=3)
    landed.store_stream(lines, table_path, durable_path(spark, "landed-stream-checkpoint")).awaitTermination()
    return payloads.detail_rows(versions.read(spark, table_path), EN)


def comment_pages(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns as pages of at most 20 comments, the speaker inside."""
    turns = table(spark, d, "conversations")
    item = F.struct(
        F.col("turn").alias("turn"),
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.struct(F.col("role").alias("name")).alias("user"),
        F.when(F.col("turn") % 6 < 5, F.struct((F.col("turn") % 6 + 1).alias("value"))).alias("rating"),
        F.col("text").alias("comment"),
        F.length("text").alias("vote_count"),
        F.lit("2024-01-01 00:00:00").alias("create_time"),
    )
    grouped = turns.groupBy("conv_id", F.floor(F.col("turn") / 20).alias("page")).agg(
        F.array_sort(F.collect_list(item)).alias("interests")
    )
    return grouped.select(
        F.col("conv_id").cast("string").alias("entity_id"),
        F.concat(F.lit("Talk "), F.col("conv_id").cast("string")).alias("title"),
        F.element_at(F.array(*(F.lit(x) for x in LIMITS)), (F.col("conv_id") % 3 + 1).cast("int")).alias("sample_label"),
        (F.col("page") * 20).cast("int").alias("page_start"),
        F.lit(20).alias("asked"),
        F.when(F.col("conv_id") % 11 == 0, 503).otherwise(200).alias("status"),
        F.to_json(F.struct("interests", F.size("interests").alias("total"))).alias("body"),
        F.lit("2024-01-02T00:00:00Z").alias("captured_at"),
    )


def comment_payloads(spark: SparkSession, d: str) -> DataFrame:
    return payloads.comment_rows(comment_pages(spark, d), LIMITS, EN)


_PAGE_LABEL = "CASE conv_id % 3 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(LIMITS)) + " END"
_PAGE_LIMIT = "CASE conv_id % 3 " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(LIMITS.values())) + " END"
COMMENT_PAYLOADS = f"""
SELECT conv_id || '-' || turn AS comment_id, CAST(conv_id AS VARCHAR) AS entity_id, 'Talk ' || conv_id AS title,
       CASE WHEN turn % 6 < 5 THEN (turn % 6 + 1) || ' stars' ELSE 'unrated' END AS star, text AS body,
       CAST(length(text) AS VARCHAR) AS useful, '2024-01-01 00:00:00' AS commented_at, sample_label,
       CAST(rn AS VARCHAR) AS position, '2024-01-02T00:00:00Z' AS captured_at
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, {_PAGE_LABEL} AS sample_label,
             {_PAGE_LIMIT} AS quota FROM conversations)
WHERE rn <= quota AND conv_id % 11 <> 0"""


def comment_page_states(spark: SparkSession, d: str) -> DataFrame:
    """Bodies to page facts to outcome to the state of each sample, with the comments held."""
    pages = comment_pages(spark, d)
    keys = ["entity_id", "sample_label"]
    outcomes = page_outcomes(payloads.page_facts(pages))
    held = held_counts(payloads.comment_rows(pages, LIMITS, EN))
    limit = F.create_map(*[F.lit(x) for pair in LIMITS.items() for x in pair])[F.col("sample_label")]
    joined = outcomes.join(held, keys, "left").withColumn("held", F.coalesce("held", F.lit(0)))
    status = status_after_run(F.col("failed"), F.col("exhausted"), F.col("held"), limit, EN)
    return joined.select(*keys, "failed", "exhausted", "held", status.alias("status"))


COMMENT_PAGE_STATES = f"""
SELECT CAST(conv_id AS VARCHAR) AS entity_id, sample_label, failed, NOT failed AS exhausted, held,
       CASE WHEN failed THEN 'failed' WHEN held < quota THEN 'exhausted' ELSE 'done' END AS status
FROM (SELECT conv_id, {_PAGE_LABEL} AS sample_label, {_PAGE_LIMIT} AS quota, conv_id % 11 = 0 AS failed,
             CASE WHEN conv_id % 11 = 0 THEN 0 ELSE least(count(*), {_PAGE_LIMIT}) END AS held FROM conversations GROUP BY conv_id)"""


def search_responses(spark: SparkSession, d: str) -> DataFrame:
    """Orders as search results: one response per priority and block of a hundred keys."""
    orders = table(spark, d, "orders")
    k = F.col("o_orderkey")
    site = F.lit("https://movie.example.com/subject/")
    url = F.when(k % 7 == 0, "https://movie.example.com/none").otherwise(F.concat(site, k.cast("string"), F.lit("/")))
    item = F.struct(
        k.alias("k"),
        F.concat(F.lit("Order "), k.cast("string")).alias("title"),
        url.alias("url"),
        (k % 10).cast("string").alias("rate"),
    )
    pages = orders.groupBy(F.col("o_orderpriority").alias("tag"), F.floor(k / 100).alias("block")).agg(
        F.array_sort(F.collect_list(item)).alias("subjects")
    )
    return pages.select(
        "tag",
        F.substring("tag", 1, 1).cast("int").alias("tag_order"),
        (F.col("block") * 100).cast("int").alias("page_start"),
        F.lit(200).alias("status"),
        F.to_json(F.struct("subjects")).alias("body"),
        F.lit("2024-01-02T00:00:00Z").alias("captured_at"),
    )


def search_payloads(spark: SparkSession, d: str) -> DataFrame:
    return payloads.search_hits(search_responses(spark, d)).drop("captured_at")


SEARCH_PAYLOADS = """
SELECT CAST(k AS VARCHAR) AS entity_id, 'Order ' || k AS title, CAST(k % 10 AS VARCHAR) AS search_score,
       'https://movie.example.com/subject/' || k || '/' AS url, tag,
       CAST(substr(tag, 1, 1) AS INTEGER) AS tag_order, CAST(k // 100 * 100 + rn AS INTEGER) AS rank
FROM (SELECT o_orderkey AS k, o_orderpriority AS tag,
             row_number() OVER (PARTITION BY o_orderpriority, o_orderkey // 100 ORDER BY o_orderkey) AS rn FROM orders)
WHERE k % 7 <> 0"""


def search_tag_states(spark: SparkSession, d: str) -> DataFrame:
    """Bodies of search pages to facts to the completeness of a tag: blocks of 700 keys are tags, every ninth page failed once."""
    rows = search_responses(spark, d)
    start = F.col("page_start")
    pages = rows.select(
        F.concat("tag", F.lit(" "), F.floor(start / 700).cast("string")).alias("tag"),
        (start % 700 / 100).cast("int").alias("page"),
        F.when(start / 100 % 9 == 0, F.array(F.lit(503))).when(start / 100 % 5 == 0, F.array(F.lit(503), F.lit(200))).otherwise(F.array(F.lit(200))).alias("tries"),
        "body",
    ).select("tag", (F.col("page") * 5).alias("page_start"), F.lit(5).alias("asked"), F.explode("tries").alias("status"), "body")
    return tag_completeness(payloads.search_page_facts(pages), listed_at_most=30)


SEARCH_TAG_STATES = """
WITH pages AS (
    SELECT o_orderpriority || ' ' || (b // 7) AS tag, CAST(b % 7 * 5 AS INTEGER) AS s, n, b % 9 = 0 AS lost
    FROM (SELECT o_orderpriority, o_orderkey // 100 AS b, CAST(count(*) AS INTEGER) AS n FROM orders GROUP BY 1, 2)
), good AS (SELECT * FROM pages WHERE NOT lost
), listed AS (
    SELECT tag, min(pos) AS covered FROM (SELECT DISTINCT tag FROM pages) tags, range(0, 1000) r(pos)
    WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.tag = tags.tag AND g.s <= pos AND pos < g.s + g.n) GROUP BY 1
), gaps AS (
    SELECT tag, count(*) FILTER (s > reach) AS holes FROM
      (SELECT tag, s, coalesce(max(s + n) OVER (PARTITION BY tag ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM good) GROUP BY 1
), facts AS (
    SELECT tag, any_value(covered) AS covered, min(CASE WHEN NOT lost AND n < 5 AND s <= covered THEN s + n END) AS ends,
           count(*) FILTER (lost) AS failed_pages, min(CASE WHEN lost THEN s END) AS first_failed FROM pages JOIN listed USING (tag) GROUP BY 1
)
SELECT tag, CAST(covered AS INTEGER) AS covered, ends, coalesce(holes, 0) AS holes, failed_pages,
       covered >= least(coalesce(ends, 30), 30) AND coalesce(first_failed >= coalesce(ends, 30), true) AS complete
FROM facts LEFT JOIN gaps USING (tag)"""


def url_entity_ids(spark: SparkSession, d: str) -> DataFrame:
    """Page URLs, half of them rewritten to entity addresses."""
    pages = table(spark, d, "pages")
    url = F.when(
        F.col("page_id") % 2 == 0, F.concat(F.col("url"), F.lit("/subject/"), F.col("page_id").cast("string"), F.lit("/"))
    ).otherwise(F.col("url"))
    return pages.select("page_id", entity_id_of_url(url).alias("entity_id"))


URL_ENTITY_IDS = """
SELECT page_id, regexp_extract(CASE WHEN page_id % 2 = 0 THEN url || '/subject/' || page_id || '/' ELSE url END,
                               '/subject/([0-9]+)/?', 1) AS entity_id FROM pages"""


def dates_in_text(spark: SparkSession, d: str) -> DataFrame:
    """First date found anywhere in a whole text."""
    return table(spark, d, "documents").select("doc_id", date_in_text(F.col("text")).alias("found"))


DATES_IN_TEXT = """
SELECT doc_id, CASE WHEN y = '' THEN '' ELSE concat_ws('-', y, lpad(nullif(m, ''), 2, '0'), lpad(nullif(dd, ''), 2, '0')) END AS found
FROM (SELECT doc_id, regexp_extract(text, p, 1) AS y, regexp_extract(text, p, 2) AS m, regexp_extract(text, p, 3) AS dd
      FROM documents, (SELECT '([0-9]{4})(?:-([0-9]{1,2}))?(?:-([0-9]{1,2}))?' AS p))"""


# --- columns --------------------------------------------------------------------


def clean_texts(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents with white space collapsed."""
    text = clean_text(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(text).alias("digest"), F.length(text).alias("length"))


_SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
CLEAN_TEXTS = f"""
SELECT doc_id, md5(t) AS digest, CAST(length(t) AS INTEGER) AS length
FROM (SELECT doc_id, CASE WHEN lower(s) NOT IN ('', 'nan', 'none', 'null', '暂无', '<na>') THEN s END AS t
      FROM (SELECT doc_id, trim(regexp_replace(text, '{_SPACES}', ' ', 'g')) AS s FROM documents))"""


def multivalues(spark: SparkSession, d: str) -> DataFrame:
    """Distinct parts in first-seen order, main part and number of parts."""
    raw = entities_raw(spark, d).select("seq", multivalue(clean_text(F.col("categories"))).alias("parts"))
    return raw.select(
        "seq",
        join_parts(F.col("parts")).alias("categories"),
        main_part(F.col("parts")).alias("main_category"),
        F.size("parts").alias("category_count"),
    )


MULTIVALUES = with_ctes(
    "entities_norm",
    body="""SELECT seq, categories, nullif(split_part(categories, ' / ', 1), '') AS main_category,
                   CAST(len(string_split(categories, ' / ')) AS INTEGER) AS category_count FROM entities_norm""",
)


def changed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows altered by text normalisation, and missing values per column after it."""
    names = ["entity_id", "original_title", "directors", "actors", "categories", "places"]
    norm = normalise_entities(entities_raw(spark, d))
    return norm.agg(
        F.count("*").alias("n"),
        F.count_if("_changed").alias("changed"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in names],
    )


CHANGED_ROWS = with_ctes(
    "entities_norm",
    body="""SELECT count(*) AS n, count(*) FILTER (changed) AS changed,
        count(*) FILTER (entity_id IS NULL) AS entity_id_missing, count(*) FILTER (original_title IS NULL) AS original_title_missing,
        count(*) FILTER (directors IS NULL) AS directors_missing, count(*) FILTER (actors IS NULL) AS actors_missing,
        count(*) FILTER (categories IS NULL) AS categories_missing, count(*) FILTER (places IS NULL) AS places_missing
        FROM entities_norm""",
)


def strict_counts(spark: SparkSession, d: str) -> DataFrame:
    raw = entities_raw(spark, d)
    votes = nonnegative_integer(F.col("votes"))
    short = nonnegative_integer(F.col("short_count"))
    return raw.select(
        "seq", votes.alias("votes"), short.alias("short_count"), (votes.isNull() | short.isNull()).alias("invalid")
    )


STRICT_COUNTS = with_ctes(
    "entities_raw",
    body="""SELECT *, votes IS NULL OR short_count IS NULL AS invalid FROM (
              SELECT seq, CASE WHEN votes IN ('-1', '1.5') THEN NULL ELSE CAST(CAST(votes AS DOUBLE) AS BIGINT) END AS votes,
                     CAST(short_count AS BIGINT) AS short_count FROM entities_raw)""",
)


def valid_ratings(spark: SparkSession, d: str) -> DataFrame:
    raw = entities_raw(spark, d)
    score, votes = to_number(F.col("score")), nonnegative_integer(F.col("votes"))
    ok = valid_rating(score, votes)
    return raw.select("seq", ok.alias("valid"), F.when(ok, score).alias("score"))


VALID_RATINGS = with_ctes(
    "entities_raw",
    body="""SELECT seq, ok AS valid, CASE WHEN ok THEN s END AS score FROM (
              SELECT seq, try_cast(score AS DOUBLE) AS s,
                     coalesce(try_cast(score AS DOUBLE) > 0 AND votes NOT IN ('-1', '1.5') AND CAST(votes AS DOUBLE) > 0, false) AS ok
              FROM entities_raw)""",
)


def valid_years(spark: SparkSession, d: str) -> DataFrame:
    raw = entities_raw(spark, d)
    year = to_number(F.col("year"))
    newest = F.coalesce(capture_local_year(F.col("captured_at")), F.lit(2001)) + 1
    ok = valid_year(year, newest)
    return raw.select(
        "seq",
        F.when(ok, year).cast("int").alias("year"),
        year.isNull().alias("missing"),
        (year.isNotNull() & ~ok).alias("invalid"),
    )


VALID_YEARS = with_ctes(
    "entities_raw",
    body="""SELECT seq, CASE WHEN ok THEN CAST(y AS INTEGER) END AS year, y IS NULL AS missing, y IS NOT NULL AND NOT ok AS invalid
            FROM (SELECT seq, CAST(year AS DOUBLE) AS y, coalesce(CAST(year AS DOUBLE) % 1 = 0 AND CAST(year AS DOUBLE) BETWEEN 1888 AND
                    CASE WHEN captured_at LIKE '1999%' THEN 2000 ELSE 2002 END, false) AS ok FROM entities_raw)""",
)


def capture_times(spark: SparkSession, d: str) -> DataFrame:
    raw = entities_raw(spark, d)
    instant = capture_instant(F.col("captured_at"))
    return raw.select(
        "seq",
        F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("instant"),
        capture_local_year(F.col("captured_at")).alias("local_year"),
    )


CAPTURE_TIMES = with_ctes(
    "entities_raw",
    body=r"""SELECT seq, CASE WHEN zoned THEN strftime(CAST(captured_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS instant,
                    CASE WHEN zoned THEN CAST(substr(captured_at, 1, 4) AS INTEGER) END AS local_year
             FROM (SELECT *, regexp_matches(captured_at, '(Z|[+-]\d\d:\d\d)$') AS zoned FROM entities_raw)""",
)


def partial_dates(spark: SparkSession, d: str) -> DataFrame:
    date = partial_date(F.col("release_date"), F.lit(2002), labels=EN)
    return entities_raw(spark, d).select("seq", date.alias("p")).select("seq", "p.*")


PARTIAL_DATES = with_ctes(
    "entities_raw",
    body="""SELECT seq, y AS year, CASE WHEN ok THEN m END AS month, CASE WHEN ok THEN dd END AS day,
                   CASE WHEN ok AND dd IS NOT NULL THEN strftime(full_date, '%Y-%m-%d') END AS iso,
                   CASE WHEN release_date IS NULL THEN 'missing' WHEN NOT ok THEN 'invalid'
                        WHEN dd IS NOT NULL THEN CASE WHEN full_date IS NULL THEN 'invalid' ELSE 'day' END
                        WHEN m IS NOT NULL THEN CASE WHEN m BETWEEN 1 AND 12 THEN 'month' ELSE 'invalid' END
                        ELSE 'year' END AS precision
            FROM (SELECT *, try_cast(y || '-' || m || '-' || dd AS DATE) AS full_date, y IS NOT NULL AND y BETWEEN 1888 AND 2002 AS ok
                  FROM (SELECT seq, release_date, try_cast(split_part(release_date, '-', 1) AS INTEGER) AS y,
                               try_cast(nullif(split_part(release_date, '-', 2), '') AS INTEGER) AS m,
                               try_cast(nullif(split_part(release_date, '-', 3), '') AS INTEGER) AS dd FROM entities_raw))""",
)


def runtimes(spark: SparkSession, d: str) -> DataFrame:
    return entities_raw(spark, d).select("seq", runtime_minutes(F.col("runtime")).alias("runtime_min"))


RUNTIMES = with_ctes(
    "entities_raw",
    body="SELECT seq, try_cast(split_part(runtime, ' ', 1) AS INTEGER) AS runtime_min FROM entities_raw",
)


def origin_classes(spark: SparkSession, d: str) -> DataFrame:
    raw = entities_raw(spark, d).select("seq", multivalue(clean_text(F.col("places"))).alias("parts"))
    return raw.select("seq", origin_class(F.col("parts"), HOME, SPECIAL, EN).alias("origin"))


ORIGIN_CLASSES = with_ctes(
    "entities_raw",
    body="""SELECT seq, CASE WHEN places IS NULL THEN 'unknown' WHEN home + special > 0 AND total > home + special THEN 'co-production'
                   WHEN home = 1 AND total > 1 THEN 'co-production' WHEN home = 1 THEN 'domestic'
                   WHEN special > 0 THEN 'special' ELSE 'import' END AS origin
            FROM (SELECT seq, places, len(string_split(places, ' / ')) AS total, CAST(contains(places, 'ASIA') AS INTEGER) AS home,
                         CAST(contains(places, 'AFRICA') AS INTEGER) + CAST(contains(places, 'AMERICA') AS INTEGER) AS special
                  FROM entities_raw)""",
)


def lenient_integers(spark: SparkSession, d: str) -> DataFrame:
    """Bad integers count as zero."""
    return entities_raw(spark, d).select(
        "seq", integer_or_zero(F.col("votes")).alias("votes"), integer_or_zero(F.col("score")).alias("score")
    )


LENIENT_INTEGERS = with_ctes(
    "entities_raw",
    body="""SELECT seq, CASE WHEN contains(votes, '.') THEN 0 ELSE coalesce(try_cast(votes AS INTEGER), 0) END AS votes,
                   CASE WHEN contains(score, '.') THEN 0 ELSE coalesce(try_cast(score AS INTEGER), 0) END AS score FROM entities_raw""",
)


# --- whole cleaning -------------------------------------------------------------


def cleaned_entities(spark: SparkSession, d: str) -> DataFrame:
    cleaned = clean_entities(entities_raw(spark, d), RULES).cleaned
    return cleaned.withColumns(
        {
            "captured_at": F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss"),
            **{c: F.round(c, 6) for c in ("short_rate", "long_rate", "shrunk_score")},
        }
    )


CLEANED_ENTITIES = with_ctes(
    "entities_marked",
    body=f"""SELECT entity_id, title, original_title, directors, actors, year, release_date, categories, places, runtime, score, votes,
               short_count, long_count, strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS captured_at, release_year, release_month, release_day,
               release_iso, release_precision, runtime_min, main_category, category_count, origin, round(short_rate, 6) AS short_rate,
               round(long_rate, 6) AS long_rate, in_rating_sample, in_study_period, round(shrunk_score, 6) AS shrunk_score,
               {QUALITY_FLAGS_SQL} AS quality_flags FROM entities_marked""",
)


def cleaned_in_source_order(spark: SparkSession, d: str) -> DataFrame:
    """Snapshot rows back in input order, for export."""
    snapshot = entity_snapshot(entities_raw(spark, d), RULES.ties)
    return source_order(snapshot, "seq").select("seq", "entity_id", "title")


CLEANED_IN_SOURCE_ORDER = with_ctes("entities_snap", body="SELECT seq, entity_id, title FROM entities_snap ORDER BY seq")


def participation_rates(spark: SparkSession, d: str) -> DataFrame:
    return _cleaned(spark, d, "short_rate", "long_rate").select("entity_id", _r("short_rate"), _r("long_rate"))


PARTICIPATION_RATES = with_ctes(
    "entities_marked",
    body="SELECT entity_id, round(short_rate, 6) AS short_rate, round(long_rate, 6) AS long_rate FROM entities_marked",
)


def inclusion_flags(spark: SparkSession, d: str) -> DataFrame:
    return _cleaned(spark, d, "in_rating_sample", "in_study_period")


INCLUSION_FLAGS = with_ctes(
    "entities_marked", body="SELECT entity_id, in_rating_sample, in_study_period FROM entities_marked"
)


def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d).groupBy("quality_flags").agg(F.count("*").alias("n"))


QUALITY_FLAGS = with_ctes(
    "entities_marked", body=f"SELECT {QUALITY_FLAGS_SQL} AS quality_flags, count(*) AS n FROM entities_marked GROUP BY 1"
)


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    report = clean_entities(entities_raw(spark, d), RULES, audit=True).report
    return report.withColumn("share", F.round("share", 6))


_UNIQUE = {
    5: ("no_valid_rating", "NOT in_rating_sample"),
    6: ("rating_sample", "in_rating_sample"),
    7: ("study_sample", "in_study_period"),
    8: ("before_period", "year < 1996"),
    9: ("after_period", "year > 2000"),
    10: ("year_missing", "year_missing"),
    11: ("year_invalid", "year_invalid"),
    12: ("capture_missing", "capture_missing"),
    13: ("capture_invalid", "capture_invalid"),
    14: ("release_not_day", "release_precision <> 'day'"),
    15: ("runtime_bad", "runtime_min IS NULL"),
    16: ("category_missing", "category_missing"),
    17: ("place_missing", "place_missing"),
    21: ("count_invalid", "count_invalid"),
    22: ("comments_without_rating", "comments_without_rating"),
}
_RAW = {
    1: ("rows_in", "count(*)"),
    2: ("missing_id", "count(*) FILTER (entity_id IS NULL)"),
    3: ("duplicate_id", "count(entity_id) - count(DISTINCT entity_id)"),
    4: ("cleaned_rows", "count(DISTINCT entity_id)"),
    18: ("original_title_missing", "count(*) FILTER (original_title IS NULL)"),
    19: ("directors_missing", "count(*) FILTER (directors IS NULL)"),
    20: ("actors_missing", "count(*) FILTER (actors IS NULL)"),
}
def _texts(rows: dict) -> str:
    """A table of text constants: the key and its texts."""
    quoted = [", ".join("'" + t.replace("'", "''") + "'" for t in (key, *texts)) for key, texts in rows.items()]
    return "(VALUES " + ", ".join(f"({line})" for line in quoted) + ")"


QUALITY_REPORT = with_ctes(
    "entities_marked",
    body="SELECT line, metric, scope, n, share, note FROM ("
    + " UNION ALL ".join(
        [
            f"SELECT {i} AS line, '{m}' AS metric, 'raw input' AS scope, {e} AS n, round(({e}) / count(*), 6) AS share FROM entities_norm"
            for i, (m, e) in _RAW.items()
        ]
        + [
            f"SELECT {i}, '{m}', 'unique cleaned rows', count(*) FILTER ({e}), round(count(*) FILTER ({e}) / count(*), 6) FROM entities_marked"
            for i, (m, e) in _UNIQUE.items()
        ]
    )
    + f") JOIN {_texts(EN_TEXTS.metrics)} t(name, metric, note) USING (metric)",
)


def rule_hits(spark: SparkSession, d: str) -> DataFrame:
    return clean_entities(entities_raw(spark, d), RULES, audit=True).rules


RULE_HITS = with_ctes(
    "entities_marked",
    body=f"""SELECT rule, field, criterion, action, hit_kind, reason, rejected, hits FROM (
    SELECT 'R01' AS rule, 'text fields' AS field, 'format' AS hit_kind, count(*) FILTER (changed AND entity_id IS NOT NULL) AS hits FROM entities_norm
    UNION ALL SELECT 'R02', 'entity id', 'rows dropped', count(entity_id) - count(DISTINCT entity_id) FROM entities_norm
    UNION ALL SELECT 'R03', 'entity id', 'rows dropped', count(*) - count(entity_id) FROM entities_norm
    UNION ALL SELECT 'R04', 'score, votes', 'emptied and excluded', count(*) FILTER (NOT in_rating_sample) FROM entities_marked
    UNION ALL SELECT 'R05', 'counts', 'emptied', count(*) FILTER (count_invalid) FROM entities_marked
    UNION ALL SELECT 'R06', 'year', 'emptied', count(*) FILTER (year_missing OR year_invalid) FROM entities_marked
    UNION ALL SELECT 'R07', 'release date', 'precision class', count(*) FILTER (release_precision <> 'day') FROM entities_marked
    UNION ALL SELECT 'R08', 'runtime', 'emptied', count(*) FILTER (runtime_min IS NULL) FROM entities_marked
    UNION ALL SELECT 'R09', 'places', 'derived field', count(*) FROM entities_marked
    UNION ALL SELECT 'R10', 'rating sample', 'sample', count(*) FILTER (in_rating_sample) FROM entities_marked
    UNION ALL SELECT 'R11', 'study sample', 'sample', count(*) FILTER (in_study_period) FROM entities_marked
    UNION ALL SELECT 'R12', 'shrunk score', 'derived measure', count(*) FILTER (in_rating_sample) FROM entities_marked
    UNION ALL SELECT 'R13', 'capture time', 'quality issue', count(*) FILTER (capture_missing OR capture_invalid) FROM entities_marked
    ) JOIN {_texts(EN_TEXTS.rules)} t(rule, field, criterion, action, hit_kind, reason, rejected) USING (rule, field, hit_kind)""",
)


def cleaned_comments(spark: SparkSession, d: str) -> DataFrame:
    cleaned = clean_comments(comments_raw(spark, d), COMMENT_ORDER)
    return cleaned.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("commented_at", "captured_at")})


CLEANED_COMMENTS = with_ctes(
    "comments_clean",
    body="""SELECT * REPLACE (strftime(commented_at, '%Y-%m-%d %H:%M:%S') AS commented_at,
                              strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS captured_at) FROM comments_clean""",
)

QUERIES = {
    "csv_scan": (csv_scan, CSV_SCAN),
    "optional_source": (optional_source, OPTIONAL_SOURCE),
    "optional_tables": (optional_tables, OPTIONAL_TABLES),
    "contract_append": (contract_append, CONTRACT_APPEND),
    "detail_payloads": (detail_payloads, DETAIL_PAYLOADS),
    "payload_triage": (payload_triage, PAYLOAD_TRIAGE),
    "landed_failures": (landed_failures, LANDED_FAILURES),
    "streamed_landing": (streamed_landing, DETAIL_PAYLOADS),
    "comment_payloads": (comment_payloads, COMMENT_PAYLOADS),
    "comment_page_states": (comment_page_states, COMMENT_PAGE_STATES),
    "search_payloads": (search_payloads, SEARCH_PAYLOADS),
    "search_tag_states": (search_tag_states, SEARCH_TAG_STATES),
    "url_entity_ids": (url_entity_ids, URL_ENTITY_IDS),
    "dates_in_text": (dates_in_text, DATES_IN_TEXT),
    "clean_texts": (clean_texts, CLEAN_TEXTS),
    "multivalues": (multivalues, MULTIVALUES),
    "changed_rows": (changed_rows, CHANGED_ROWS),
    "strict_counts": (strict_counts, STRICT_COUNTS),
    "valid_ratings": (valid_ratings, VALID_RATINGS),
    "valid_years": (valid_years, VALID_YEARS),
    "capture_times": (capture_times, CAPTURE_TIMES),
    "partial_dates": (partial_dates, PARTIAL_DATES),
    "runtimes": (runtimes, RUNTIMES),
    "origin_classes": (origin_classes, ORIGIN_CLASSES),
    "lenient_integers": (lenient_integers, LENIENT_INTEGERS),
    "cleaned_entities": (cleaned_entities, CLEANED_ENTITIES),
    "cleaned_in_source_order": (cleaned_in_source_order, CLEANED_IN_SOURCE_ORDER),
    "participation_rates": (participation_rates, PARTICIPATION_RATES),
    "inclusion_flags": (inclusion_flags, INCLUSION_FLAGS),
    "quality_flags": (quality_flags, QUALITY_FLAGS),
    "quality_report": (quality_report, QUALITY_REPORT),
    "rule_hits": (rule_hits, RULE_HITS),
    "cleaned_comments": (cleaned_comments, CLEANED_COMMENTS),
}
