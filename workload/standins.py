"""The given tables in the roles the operators expect.

Each stand-in exists twice: as a DataFrame and, under the same name in ``CTE``,
as SQL for the check. An order plays a rated entity, its lines play its
comments, events play the collection log. Dirt is laid over the clean values by
rules on the key, the same rules on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.functions.rating import origin_class, participation
from ratinglens.labels import EN, PLACEHOLDERS
from ratinglens.plans.cleaning import EntityRules
from ratinglens.session import staged

YEARS = (1996, 2000)
HOME, SPECIAL = "ASIA", ("AFRICA", "AMERICA")
LIMITS = {"A": 3, "N": 2, "R": 4}
RULES = EntityRules(ties=("seq",), years=YEARS, home=HOME, special=SPECIAL, labels=EN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_ctes(*names: str, body: str) -> str:
    """SQL with the named stand-ins, and those they need, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in ordered) + "\n" + body


def _text(c: Column) -> Column:
    return c.cast("string")


ENTITY_COLUMNS = (
    "entity_id", "title", "year", "categories", "places", "origin", "score", "votes", "short_rate", "long_rate",
)
#: Those that need neither the parts nor the suppliers of an order.
PLAIN_COLUMNS = tuple(c for c in ENTITY_COLUMNS if c not in ("categories", "places", "origin"))


def order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: line count and quantities."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"))
    return lines.agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: line count, quantities, and the sets of part types and regions."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    places = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), "r_name")
    )
    # part types and regions are short fixed lists, so the sets stay small
    return (
        lines.join(parts, "l_partkey", "left")
        .join(places, "l_suppkey", "left")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(
            F.count("*").alias("lines"),
            F.sum("l_quantity").alias("quantity"),
            F.array_join(F.array_sort(F.collect_set("p_type")), " / ").alias("types"),
            F.array_join(F.array_sort(F.collect_set("r_name")), " / ").alias("regions"),
        )
    )


def order_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: line count, quantities, and the places of its regions as far as the origin class tells them apart.

    Flags instead of sets: they are aggregated by hash, and one region stands for all that are neither home nor special.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    # a part or supplier given twice counts its lines twice, as in order_lines
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    places = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), "r_name")
    )
    named = {name: F.col("r_name") == name for name in (HOME, *SPECIAL)}
    other = ~F.col("r_name").isin(*named) & ~F.lower("r_name").isin(*PLACEHOLDERS)
    flags = named | {"elsewhere": other}
    return (
        lines.join(parts, "l_partkey", "left")
        .join(places, "l_suppkey", "left")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"), *(F.bool_or(c).alias(n) for n, c in flags.items()))
        .select("k", "lines", "quantity", F.array_compact(F.array(*(F.when(F.col(n), n) for n in flags))).alias("regions"))
    )


def entities(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ENTITY_COLUMNS) -> DataFrame:
    """Clean entities: an order with its score, votes, categories and origin; parts and places are joined if asked for."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice", "o_orderdate")
    described = set(columns) - set(PLAIN_COLUMNS)
    described_lines = order_origins if described == {"origin"} else order_lines if described else order_counts
    joined = orders.join(described_lines(spark, sf_dir), "k", "left")
    regions = F.col("regions") if described == {"origin"} else F.split("regions", " / ")
    votes = F.when(F.col("lines") > 0, F.floor("o_totalprice").cast("bigint"))
    all_columns = {
        "entity_id": _text(F.col("k")),
        "title": F.concat(F.lit("Order "), _text(F.col("k"))),
        "year": F.year("o_orderdate"),
        "categories": F.col("types"),
        "places": F.col("regions"),
        "origin": origin_class(regions, HOME, SPECIAL, EN),
        "score": F.round(F.col("quantity") / F.col("lines") / 5, 1),
        "votes": votes,
        "short_rate": participation(F.col("k") % 5000, votes),
        "long_rate": participation(F.col("k") % 300, votes),
    }
    return joined.select(*(all_columns[c].alias(c) for c in ENTITY_COLUMNS if c in columns))


def stored_entities(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The clean entities, or some of their columns, stored for queries that pass over them more than once."""
    wanted = columns or ENTITY_COLUMNS
    return staged(entities(spark, sf_dir, wanted).select(*wanted), "entities")


def entities_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty entity details as text, every fifth entity captured twice."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_totalprice", "o_orderdate"
    )
    joined = orders.join(order_lines(spark, sf_dir), "k", "left")
    copies = F.when(F.col("k") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = joined.withColumn("copy", F.explode(copies))
    k, date = F.col("k"), F.col("o_orderdate")

    def every(n: int, value: Column | str, otherwise: Column) -> Column:
        return F.when(k % n == 0, F.lit(value) if isinstance(value, str) else value).otherwise(otherwise)

    nothing = F.lit(None).cast("string")
    month = F.lpad(_text(k % 12 + 1), 2, "0")
    stamp = F.concat(F.lit("2001-"), month, F.when(F.col("copy") == 0, "-20").otherwise("-10"))
    capture = (
        F.when(k % 10 == 0, nothing)
        .when(k % 10 == 1, "not-a-time")
        .when(k % 10 == 2, F.concat(stamp, F.lit(" 12:00:00")))
        .when(k % 10 == 3, "1999-12-31T23:30:00-08:00")
        .when(k % 10 == 4, F.concat(stamp, F.lit("T08:00:00Z")))
        .otherwise(F.concat(stamp, F.lit("T08:00:00+08:00")))
    )
    release = (
        F.when(k % 9 == 0, F.date_format(date, "yyyy-MM-dd"))
        .when(k % 9 == 1, F.date_format(date, "yyyy-MM"))
        .when(k % 9 == 2, F.date_format(date, "yyyy"))
        .when(k % 9 == 3, "unknown")
        .when(k % 9 == 4, nothing)
        .when(k % 9 == 5, F.concat(F.date_format(date, "yyyy"), F.lit("-13")))
        .when(k % 9 == 6, F.concat(F.date_format(date, "yyyy"), F.lit("-02-30")))
        .when(k % 9 == 7, F.concat(F.date_format(date, "yyyy"), F.lit("-3-7")))
        .otherwise("0000")
    )
    doubled = F.concat(F.col("types"), F.lit(" / "), F.element_at(F.split("types", " / "), 1))
    score = _text(F.round(F.col("quantity") / F.col("lines") / 5, 1))
    votes = _text(F.floor("o_totalprice").cast("bigint"))
    return rows.select(
        every(997, nothing, every(13, F.concat(F.lit("  "), _text(k), F.lit(" ")), _text(k))).alias("entity_id"),
        F.concat(F.when(F.col("copy") == 0, " Order   ").otherwise("Older "), _text(k)).alias("title"),
        every(7, " NULL ", every(6, "", F.concat(F.lit("Original "), _text(k)))).alias("original_title"),
        every(11, nothing, F.concat(F.lit("Customer "), _text(F.col("o_custkey")))).alias("directors"),
        every(17, "暂无", F.concat(F.lit("Clerk "), _text(k % 50))).alias("actors"),
        every(
            101, nothing, every(103, "1800", every(107, "1998.5", every(109, "2027", F.date_format(date, "yyyy"))))
        ).alias("year"),
        release.alias("release_date"),
        every(3, F.regexp_replace("types", " / ", "/"), every(19, doubled, F.col("types"))).alias("categories"),
        F.col("regions").alias("places"),
        every(23, "no minutes", F.concat(_text(F.col("quantity").cast("bigint")), F.lit(" min"))).alias("runtime"),
        F.coalesce(every(29, "bad", score), F.lit("0")).alias("score"),
        every(31, "-1", every(37, "1.5", every(41, "4.0", votes))).alias("votes"),
        every(43, nothing, _text(k % 5000)).alias("short_count"),
        _text(k % 300).alias("long_count"),
        capture.alias("captured_at"),
        (k * 2 + (1 - F.col("copy"))).alias("seq"),
    )


def comments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty comments as text; the columns after the contract give the row order."""
    lines = table(spark, sf_dir, "lineitem")
    star = (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("bigint")
    order = _text(F.col("l_orderkey"))
    return lines.select(
        F.concat(order, F.lit("-"), _text(F.col("l_linenumber"))).alias("comment_id"),
        order.alias("entity_id"),
        F.concat(F.lit("Order "), order).alias("title"),
        F.when(F.col("l_partkey") % 50 == 0, "unrated")
        .when(F.col("l_partkey") % 51 == 0, "10 stars")
        .otherwise(F.concat(_text(star), F.lit(" stars")))
        .alias("star"),
        F.col("l_linestatus").alias("body"),
        F.when(F.col("l_suppkey") % 20 == 0, "-3")
        .when(F.col("l_suppkey") % 21 == 0, "x")
        .when(F.col("l_suppkey") % 22 == 0, "2.7")
        .otherwise(_text(F.floor("l_extendedprice").cast("bigint") % 50))
        .alias("useful"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("commented_at"),
        F.col("l_returnflag").alias("sample_label"),
        _text(F.col("l_linenumber")).alias("position"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00+08:00")).alias("captured_at"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )


COMMENT_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def collection_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures and successes per user; the day is the round."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "purchase"))
    kind = F.get_json_object("props", "$.k").cast("int") % 4
    reason = (
        F.when(kind == 0, "HTTP 400").when(kind == 1, "HTTP 404").when(kind == 2, "HTTP 429").otherwise("network failure")
    )
    return events.select(
        _text(F.col("user_id")).alias("entity_id"),
        F.concat(F.lit("User "), _text(F.col("user_id"))).alias("title"),
        (F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) + 1).alias("round"),
        F.struct("ts", "event_id").alias("seq"),
        (F.col("event_type") == "purchase").alias("ok"),
        F.when(F.col("event_type") == "error", reason).alias("reason"),
        F.col("ts").alias("at"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed attempts numbered within (entity, round)."""
    from ratinglens.operators.ordered import numbered

    failed = collection_events(spark, sf_dir).where(~F.col("ok")).withColumn("event_id", F.col("seq.event_id"))
    rows = numbered(failed, ["entity_id", "round"], "at", ["event_id"], "attempt")
    return rows.select(
        "entity_id",
        "title",
        "round",
        F.col("attempt").cast("int").alias("attempt"),
        F.when(F.col("event_id") % 5 == 0, "transport retry").otherwise("request").alias("level"),
        "reason",
        F.col("at").alias("failed_at"),
    )


def tag_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities listed under tags: users under event types, ranked by event."""
    events = table(spark, sf_dir, "events")
    return events.select(
        _text(F.col("user_id")).alias("entity_id"),
        F.col("event_type").alias("tag"),
        tag_position(F.col("event_type")).alias("tag_order"),
        F.col("event_id").alias("rank"),
        F.col("ts").alias("captured_at"),
    )


TAGS = ("view", "click", "signup", "purchase", "error")


def tag_position(tag: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in TAGS]), tag).cast("int")


# --- the same stand-ins as SQL -------------------------------------------------

NEEDS = {
    "entities": ("order_lines",),
    "rated": ("entities",),
    "period": ("entities",),
    "weighted": ("period",),
    "entities_raw": ("order_lines",),
    "attempts": ("collection_events",),
    "comments_clean": ("comments_raw",),
    "comment_metrics": ("comments_clean",),
    "entities_norm": ("entities_raw",),
    "entities_snap": ("entities_norm",),
    "entities_typed": ("entities_snap",),
    "entities_marked": ("entities_typed",),
    "round_rows": ("collection_events",),
    "failure_states": ("round_rows",),
}

CTE = {
    "order_lines": """
        SELECT l_orderkey AS k, count(*) AS lines, sum(l_quantity) AS quantity,
               string_agg(DISTINCT p_type, ' / ' ORDER BY p_type) AS types,
               string_agg(DISTINCT r_name, ' / ' ORDER BY r_name) AS regions
        FROM lineitem
        LEFT JOIN part ON p_partkey = l_partkey
        LEFT JOIN supplier ON s_suppkey = l_suppkey
        LEFT JOIN nation ON n_nationkey = s_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey
        GROUP BY 1""",
    "entities": """
        SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, 'Order ' || o_orderkey AS title,
               CAST(year(o_orderdate) AS INTEGER) AS year, types AS categories, regions AS places,
               CASE WHEN regions IS NULL THEN 'unknown'
                    WHEN regions = 'ASIA' THEN 'domestic'
                    WHEN regions IN ('AFRICA', 'AMERICA', 'AFRICA / AMERICA') THEN 'special'
                    WHEN regions IN ('EUROPE', 'MIDDLE EAST', 'EUROPE / MIDDLE EAST') THEN 'import'
                    ELSE 'co-production' END AS origin,
               round(quantity / lines / 5, 1) AS score,
               CASE WHEN lines > 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS votes,
               CASE WHEN lines > 0 AND floor(o_totalprice) > 0
                    THEN CAST(o_orderkey % 5000 AS DOUBLE) / floor(o_totalprice) END AS short_rate,
               CASE WHEN lines > 0 AND floor(o_totalprice) > 0
                    THEN CAST(o_orderkey % 300 AS DOUBLE) / floor(o_totalprice) END AS long_rate
        FROM orders LEFT JOIN order_lines ON k = o_orderkey""",
    "rated": "SELECT * FROM entities WHERE score IS NOT NULL AND votes IS NOT NULL",
    "period": f"SELECT * FROM entities WHERE year BETWEEN {YEARS[0]} AND {YEARS[1]}",
    "weighted": """
        SELECT entity_id, year, origin, score, votes, unnest(parts) AS category, 1.0::DOUBLE / len(parts) AS weight
        FROM (SELECT *, CASE WHEN categories IS NULL THEN ['unknown']
                             ELSE string_split(categories, ' / ') END AS parts FROM period)""",
    "entities_raw": """
        SELECT CASE WHEN k % 997 = 0 THEN NULL WHEN k % 13 = 0 THEN '  ' || k || ' ' ELSE CAST(k AS VARCHAR) END AS entity_id,
               CASE WHEN copy = 0 THEN ' Order   ' ELSE 'Older ' END || k AS title,
               CASE WHEN k % 7 = 0 THEN ' NULL ' WHEN k % 6 = 0 THEN '' ELSE 'Original ' || k END AS original_title,
               CASE WHEN k % 11 = 0 THEN NULL ELSE 'Customer ' || o_custkey END AS directors,
               CASE WHEN k % 17 = 0 THEN '暂无' ELSE 'Clerk ' || (k % 50) END AS actors,
               CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN '1800' WHEN k % 107 = 0 THEN '1998.5'
                    WHEN k % 109 = 0 THEN '2027' ELSE strftime(o_orderdate, '%Y') END AS year,
               CASE k % 9 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
                    WHEN 2 THEN strftime(o_orderdate, '%Y') WHEN 3 THEN 'unknown' WHEN 4 THEN NULL
                    WHEN 5 THEN strftime(o_orderdate, '%Y') || '-13' WHEN 6 THEN strftime(o_orderdate, '%Y') || '-02-30'
                    WHEN 7 THEN strftime(o_orderdate, '%Y') || '-3-7' ELSE '0000' END AS release_date,
               CASE WHEN k % 3 = 0 THEN replace(types, ' / ', '/')
                    WHEN k % 19 = 0 THEN types || ' / ' || split_part(types, ' / ', 1) ELSE types END AS categories,
               regions AS places,
               CASE WHEN k % 23 = 0 THEN 'no minutes' ELSE CAST(quantity AS BIGINT) || ' min' END AS runtime,
               coalesce(CASE WHEN k % 29 = 0 THEN 'bad' ELSE CAST(round(quantity / lines / 5, 1) AS VARCHAR) END, '0') AS score,
               CASE WHEN k % 31 = 0 THEN '-1' WHEN k % 37 = 0 THEN '1.5' WHEN k % 41 = 0 THEN '4.0'
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS votes,
               CASE WHEN k % 43 = 0 THEN NULL ELSE CAST(k % 5000 AS VARCHAR) END AS short_count,
               CAST(k % 300 AS VARCHAR) AS long_count,
               CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN 'not-a-time' WHEN 2 THEN stamp || ' 12:00:00'
                    WHEN 3 THEN '1999-12-31T23:30:00-08:00' WHEN 4 THEN stamp || 'T08:00:00Z'
                    ELSE stamp || 'T08:00:00+08:00' END AS captured_at,
               k * 2 + (1 - copy) AS seq
        FROM (SELECT o_orderkey AS k, *, '2001-' || lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0')
                     || CASE WHEN copy = 0 THEN '-20' ELSE '-10' END AS stamp
              FROM (SELECT orders.*, unnest(CASE WHEN o_orderkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM orders)
             ) d LEFT JOIN order_lines USING (k)""",
    "comments_raw": """
        SELECT l_orderkey || '-' || l_linenumber AS comment_id, CAST(l_orderkey AS VARCHAR) AS entity_id,
               'Order ' || l_orderkey AS title,
               CASE WHEN l_partkey % 50 = 0 THEN 'unrated' WHEN l_partkey % 51 = 0 THEN '10 stars'
                    ELSE CAST(1 + floor((l_quantity - 1) / 10) AS BIGINT) || ' stars' END AS star,
               l_linestatus AS body,
               CASE WHEN l_suppkey % 20 = 0 THEN '-3' WHEN l_suppkey % 21 = 0 THEN 'x' WHEN l_suppkey % 22 = 0 THEN '2.7'
                    ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) % 50 AS VARCHAR) END AS useful,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS commented_at, l_returnflag AS sample_label,
               CAST(l_linenumber AS VARCHAR) AS position,
               strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00+08:00' AS captured_at,
               l_shipdate, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem""",
    "comments_clean": """
        SELECT comment_id, entity_id, title, star, body, sample_label,
               CASE WHEN useful = '2.7' THEN 2 ELSE greatest(coalesce(try_cast(useful AS BIGINT), 0), 0) END AS useful,
               CAST(commented_at AS TIMESTAMP) AS commented_at, CAST(position AS BIGINT) AS position,
               CAST(substr(captured_at, 1, 10) AS TIMESTAMP) - INTERVAL 8 HOUR AS captured_at,
               CASE WHEN try_cast(split_part(star, ' ', 1) AS INTEGER) BETWEEN 1 AND 5
                    THEN try_cast(split_part(star, ' ', 1) AS INTEGER) END AS star_value
        FROM comments_raw
        QUALIFY row_number() OVER (PARTITION BY comment_id, sample_label
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "comment_metrics": """
        SELECT entity_id, title, sample_label, n AS rated, m AS mean_star,
               CASE WHEN u > 0 THEN su / u ELSE m END AS useful_weighted_star, sh / h AS log_weighted_star,
               p AS five_star_share,
               (p + 3.8416 / (2 * n)) / (1 + 3.8416 / n)
                 - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n) AS five_star_low,
               (p + 3.8416 / (2 * n)) / (1 + 3.8416 / n)
                 + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n) AS five_star_high,
               e + 0.0 AS star_entropy
        FROM (SELECT entity_id, title, sample_label, count(*)::DOUBLE AS n, avg(star_value) AS m,
                     sum(star_value * useful)::DOUBLE AS su, sum(useful)::DOUBLE AS u,
                     sum(star_value * (1 + ln(1 + useful))) AS sh, sum(1 + ln(1 + useful)) AS h,
                     count(*) FILTER (star_value = 5)::DOUBLE / count(*) AS p, entropy(star_value) AS e
              FROM comments_clean WHERE star_value IS NOT NULL GROUP BY ALL)""",
    "collection_events": """
        SELECT CAST(user_id AS VARCHAR) AS entity_id, 'User ' || user_id AS title,
               CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS round,
               ts, event_id, event_type = 'purchase' AS ok,
               CASE WHEN event_type = 'error' THEN
                 CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 WHEN 0 THEN 'HTTP 400' WHEN 1 THEN 'HTTP 404'
                      WHEN 2 THEN 'HTTP 429' ELSE 'network failure' END END AS reason
        FROM events WHERE event_type IN ('error', 'purchase')""",
    "attempts": """
        SELECT entity_id, title, round,
               CAST(row_number() OVER (PARTITION BY entity_id, round ORDER BY ts, event_id) AS INTEGER) AS attempt,
               CASE WHEN event_id % 5 = 0 THEN 'transport retry' ELSE 'request' END AS level, reason, ts AS failed_at
        FROM collection_events WHERE NOT ok""",
    "tag_hits": f"""
        SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS tag,
               CAST(list_position({list(TAGS)}, event_type) AS INTEGER) AS tag_order,
               event_id AS rank, ts AS captured_at FROM events""",
    # every failing (entity, round) with the facts the fold needs, by windows over the event sequence
    "round_rows": """
        SELECT entity_id, round, arg_min(reason, event_id) IN ('HTTP 400', 'HTTP 404') AS perm,
               arg_max(reason, event_id) AS last_reason, arg_max(title, event_id) AS title,
               arg_max(reason, event_id) IN ('HTTP 400', 'HTTP 404') AS last_perm,
               min(event_id) AS first_id, max(event_id) AS last_id, min(ts) AS first_ts, max(ts) AS last_ts,
               arg_min(wins, event_id) AS wins_before
        FROM (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY entity_id ORDER BY event_id) AS wins FROM collection_events)
        WHERE NOT ok GROUP BY entity_id, round""",
    "failure_states": """
        SELECT r.entity_id, arg_max(r.title, round) AS title, arg_max(last_reason, round) AS last_reason,
               min(round) AS first_round, max(round) AS last_round, CAST(count(*) AS INTEGER) AS failed_rounds,
               CAST(count(*) FILTER (perm) AS INTEGER) AS permanent_rounds,
               CAST(CASE WHEN max(win_id) > max(first_id) THEN 0 ELSE arg_max(streak, round) END AS INTEGER) AS permanent_streak,
               CASE WHEN max(win_id) > max(last_id) THEN 'recovered'
                    WHEN (max(win_id) IS NULL OR max(win_id) < max(first_id)) AND arg_max(streak, round) >= 2 THEN 'unavailable'
                    ELSE 'pending' END AS status,
               min(first_ts) AS first_failed_at,
               CASE WHEN max(win_id) > max(last_id) THEN max(win_ts) ELSE max(last_ts) END AS updated_at
        FROM (SELECT *, sum(CASE WHEN perm THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id, island ORDER BY round) AS streak
              FROM (SELECT *, sum(CASE WHEN perm AND prev_round = round - 1 AND prev_perm AND wins_before = prev_wins THEN 0 ELSE 1 END)
                           OVER (PARTITION BY entity_id ORDER BY round) AS island
                    FROM (SELECT *, lag(round) OVER w AS prev_round, lag(last_perm) OVER w AS prev_perm, lag(wins_before) OVER w AS prev_wins
                          FROM round_rows WINDOW w AS (PARTITION BY entity_id ORDER BY round)))) r
        LEFT JOIN (SELECT entity_id, max(event_id) AS win_id, max(ts) AS win_ts FROM collection_events WHERE ok GROUP BY 1) w
          ON w.entity_id = r.entity_id
        GROUP BY r.entity_id""",
    "entities_norm": """
        SELECT nullif(trim(entity_id), '') AS entity_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title,
               CASE WHEN lower(trim(original_title)) NOT IN ('', 'null') THEN original_title END AS original_title,
               directors, CASE WHEN actors <> '暂无' THEN actors END AS actors, year, release_date,
               array_to_string(list_distinct_in_order, ' / ') AS categories, places, runtime, score, votes,
               short_count, long_count, captured_at, seq,
               coalesce(entity_id, '<NA>') <> coalesce(trim(entity_id), '<NA>')
                 OR title <> trim(regexp_replace(title, '\\s+', ' ', 'g'))
                 OR lower(trim(original_title)) IN ('', 'null') OR actors = '暂无'
                 OR (categories IS NOT NULL AND categories <> array_to_string(list_distinct_in_order, ' / ')) AS changed
        FROM (SELECT *, list_sort(list_distinct(list_transform(string_split(categories, '/'), lambda x: trim(x)))) AS list_distinct_in_order
              FROM entities_raw)""",
    "entities_snap": """
        SELECT *, CASE WHEN regexp_matches(captured_at, '(Z|[+-]\\d\\d:\\d\\d)$')
                       THEN CAST(CAST(captured_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) END AS cap,
               CASE WHEN regexp_matches(captured_at, '(Z|[+-]\\d\\d:\\d\\d)$')
                    THEN CAST(substr(captured_at, 1, 4) AS INTEGER) END AS local_year
        FROM entities_norm WHERE entity_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY cap DESC NULLS LAST, seq DESC) = 1""",
    "entities_typed": """
        SELECT * EXCLUDE (votes, short_count, long_count, year, score),
               CASE WHEN votes IN ('-1', '1.5') THEN NULL ELSE CAST(CAST(votes AS DOUBLE) AS BIGINT) END AS votes,
               CAST(short_count AS BIGINT) AS short_count, CAST(long_count AS BIGINT) AS long_count,
               CAST(year AS DOUBLE) AS raw_year, try_cast(score AS DOUBLE) AS raw_score,
               coalesce(local_year, (SELECT coalesce(max(local_year), 2001) FROM entities_snap)) + 1 AS newest,
               try_cast(split_part(runtime, ' ', 1) AS INTEGER) AS minutes,
               try_cast(split_part(release_date, '-', 1) AS INTEGER) AS ry,
               try_cast(nullif(split_part(release_date, '-', 2), '') AS INTEGER) AS rm,
               try_cast(nullif(split_part(release_date, '-', 3), '') AS INTEGER) AS rd
        FROM entities_snap""",
    "entities_marked": f"""
        WITH valid AS (SELECT *, coalesce(raw_score > 0 AND raw_score <= 10 AND votes > 0, false) AS ok,
                              coalesce(raw_year % 1 = 0 AND raw_year >= 1888 AND raw_year <= newest, false) AS year_ok,
                              ry IS NOT NULL AND ry >= 1888 AND ry <= newest AS plausible
                       FROM entities_typed),
             prior AS (SELECT avg(raw_score) AS c, median(votes) AS m FROM valid WHERE ok)
        SELECT entity_id, title, original_title, directors, actors,
               CASE WHEN year_ok THEN CAST(raw_year AS INTEGER) END AS year, release_date,
               coalesce(categories, 'unknown') AS categories, coalesce(places, 'unknown') AS places, runtime,
               CASE WHEN ok THEN raw_score END AS score, votes, short_count, long_count, cap AS captured_at,
               ry AS release_year, CASE WHEN plausible THEN rm END AS release_month,
               CASE WHEN plausible THEN rd END AS release_day,
               CASE WHEN plausible AND rd IS NOT NULL
                    THEN strftime(try_cast(ry || '-' || rm || '-' || rd AS DATE), '%Y-%m-%d') END AS release_iso,
               CASE WHEN release_date IS NULL THEN 'missing' WHEN NOT plausible THEN 'invalid'
                    WHEN rd IS NOT NULL THEN CASE WHEN try_cast(ry || '-' || rm || '-' || rd AS DATE) IS NULL THEN 'invalid' ELSE 'day' END
                    WHEN rm IS NOT NULL THEN CASE WHEN rm BETWEEN 1 AND 12 THEN 'month' ELSE 'invalid' END
                    ELSE 'year' END AS release_precision,
               CASE WHEN minutes BETWEEN 1 AND 1440 THEN minutes END AS runtime_min,
               coalesce(split_part(categories, ' / ', 1), 'unknown') AS main_category,
               CAST(coalesce(len(string_split(categories, ' / ')), 1) AS INTEGER) AS category_count,
               CASE WHEN places IS NULL THEN 'unknown' WHEN places = 'ASIA' THEN 'domestic'
                    WHEN places IN ('AFRICA', 'AMERICA', 'AFRICA / AMERICA') THEN 'special'
                    WHEN places IN ('EUROPE', 'MIDDLE EAST', 'EUROPE / MIDDLE EAST') THEN 'import'
                    ELSE 'co-production' END AS origin,
               CASE WHEN votes > 0 THEN CAST(short_count AS DOUBLE) / votes END AS short_rate,
               CASE WHEN votes > 0 THEN CAST(long_count AS DOUBLE) / votes END AS long_rate,
               ok AS in_rating_sample,
               coalesce(year_ok AND raw_year BETWEEN {YEARS[0]} AND {YEARS[1]}, false) AS in_study_period,
               CASE WHEN ok THEN votes / (votes + m) * raw_score + m / (votes + m) * c END AS shrunk_score,
               raw_year IS NULL AS year_missing, raw_year IS NOT NULL AND NOT year_ok AS year_invalid,
               captured_at IS NULL AS capture_missing, captured_at IS NOT NULL AND cap IS NULL AS capture_invalid,
               categories IS NULL AS category_missing, places IS NULL AS place_missing,
               votes IS NULL OR short_count IS NULL OR long_count IS NULL AS count_invalid,
               NOT ok AND coalesce(short_count, 0) > 0 AS comments_without_rating
        FROM valid CROSS JOIN prior""",
}

QUALITY_FLAGS_SQL = """coalesce(nullif(concat_ws(';',
    CASE WHEN NOT in_rating_sample THEN 'no valid rating' END,
    CASE WHEN comments_without_rating THEN 'comments without rating' END,
    CASE WHEN count_invalid THEN 'count field invalid' END,
    CASE WHEN year_missing THEN 'year missing' END,
    CASE WHEN year_invalid THEN 'year invalid' END,
    CASE WHEN capture_missing THEN 'capture time missing' END,
    CASE WHEN capture_invalid THEN 'capture time invalid' END,
    CASE WHEN release_precision = 'missing' THEN 'release date missing' END,
    CASE WHEN release_precision = 'invalid' THEN 'release date invalid' END,
    CASE WHEN runtime_min IS NULL THEN 'runtime missing or invalid' END,
    CASE WHEN category_missing THEN 'category missing' END,
    CASE WHEN place_missing THEN 'place missing' END,
    CASE WHEN short_rate > 1 THEN 'short comments exceed votes' END,
    CASE WHEN long_rate > 1 THEN 'long comments exceed votes' END), ''), 'normal')"""
