"""JSON bodies to typed fields.

A body is parsed once, to a VARIANT; every test and field reads that value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratinglens.functions.dates import date_in_text
from ratinglens.functions.text import join_names
from ratinglens.labels import ZH, Labels

_PEOPLE = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
_TEXTS = T.ArrayType(T.StringType())

# Field names of the detail, comment and search bodies.
DETAIL_BODY = T.StructType(
    [
        T.StructField("title", T.VariantType()),
        T.StructField("original_title", T.VariantType()),
        T.StructField("year", T.VariantType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("pubdate", T.StringType()),
        T.StructField("genres", _TEXTS),
        T.StructField("countries", _TEXTS),
        T.StructField("durations", _TEXTS),
        T.StructField("directors", _PEOPLE),
        T.StructField("actors", _PEOPLE),
        T.StructField(
            "rating",
            T.StructType([T.StructField("value", T.VariantType()), T.StructField("count", T.VariantType())]),
        ),
        T.StructField("comment_count", T.VariantType()),
        T.StructField("review_count", T.VariantType()),
    ]
)
COMMENT_BODY = T.StructType(
    [
        T.StructField("total", T.LongType()),
        T.StructField(
            "interests",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("rating", T.StructType([T.StructField("value", T.StringType())])),
                        T.StructField("comment", T.StringType()),
                        T.StructField("vote_count", T.StringType()),
                        T.StructField("create_time", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)
SEARCH_BODY = T.StructType(
    [
        T.StructField(
            "subjects",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("title", T.StringType()),
                        T.StructField("url", T.StringType()),
                        T.StructField("rate", T.StringType()),
                    ]
                )
            ),
        )
    ]
)


def parsed_body(body: Column) -> Column:
    """The body as a VARIANT, NULL unless it is JSON.

    A generator: Spark neither repeats it nor moves a filter below it, so a body is parsed once however often it is read.
    """
    return F.explode(F.array(F.try_parse_json(body)))


def is_object(payload: Column) -> Column:
    """Never NULL: the value is a JSON object."""
    return F.try_variant_get(payload, "$", "struct<_:variant>").isNotNull()


def json_text(value: Column) -> Column:
    """Text of a scalar VARIANT; a number written with a fraction keeps one."""
    text = F.try_variant_get(value, "$", "string")
    whole = F.schema_of_variant(value).startswith("DECIMAL") & ~text.contains(".")
    return F.when(whole, F.concat(text, F.lit(".0"))).otherwise(text)


def payload_reason(status: Column, payload: Column, labels: Labels = ZH) -> Column:
    """NULL for a usable response, else the text that goes into the failure log.

    A rating may be an object, or a value that counts as none: null, empty, zero or false.
    """
    rating = F.to_json(F.try_variant_get(payload, "$.rating", "variant"))
    # one test, as Spark would write the rating out again for each
    usable = F.coalesce(rating.rlike(r'^(\{|(null|""|false|\[\]|-?0(\.0+)?(E.*)?)$)'), F.lit(True))
    return (
        F.when(status.isNull(), labels.network_failure)
        .when(status != 200, F.concat(F.lit("HTTP "), status.cast("string")))
        .when(~is_object(payload) | ~usable, labels.parse_failure)
    )


def failure_reason(status: Column, body: Column, labels: Labels = ZH) -> Column:
    """``payload_reason`` of a body that is still text."""
    return payload_reason(status, F.try_parse_json(body), labels)


def _text(value: Column) -> Column:
    return F.coalesce(json_text(value), F.lit(""))


def _joined(c: Column) -> Column:
    return F.coalesce(F.array_join(c, " / "), F.lit(""))


def release_text(first: Column, second: Column) -> Column:
    """Date out of the first usable field; a list field gives its first item."""
    chosen = F.coalesce(F.when(~first.isin("", "[]", "0", "false"), first), second)
    listed = F.try_element_at(F.from_json(chosen, _TEXTS), F.lit(1))
    return date_in_text(F.when(chosen.startswith("["), listed).otherwise(chosen))


def body_as(payload: Column, kind: T.StructType) -> Column:
    """The fields of an object; what is absent or of another type is NULL."""
    return F.try_variant_get(payload, "$", kind.simpleString())


def detail_fields(data: Column) -> dict[str, Column]:
    """Contract columns of a parsed detail body (key and capture time excluded)."""
    return {
        "title": _text(data["title"]),
        "original_title": _text(data["original_title"]),
        "directors": join_names(data["directors"]),
        "actors": join_names(data["actors"], limit=15),
        "year": _text(data["year"]),
        "release_date": release_text(data["release_date"], data["pubdate"]),
        "categories": _joined(data["genres"]),
        "places": _joined(data["countries"]),
        "runtime": _joined(data["durations"]),
        "score": _text(data["rating"]["value"]),
        "votes": _text(data["rating"]["count"]),
        "short_count": _text(data["comment_count"]),
        "long_count": _text(data["review_count"]),
    }


def star_text(value: Column, labels: Labels = ZH) -> Column:
    text = F.concat(value.try_cast("double").cast("int").cast("string"), F.lit(labels.star_suffix))
    return F.coalesce(text, F.lit(labels.unrated))
