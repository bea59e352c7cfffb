"""Responses as the collector lands them: files of JSON lines or Parquet, read once or as a stream.

Every line is one response under the columns of its kind. A line that is no such JSON stays as text in ``malformed`` and
becomes a failure row; ``landed_in`` names the file. The body is parsed once, to a VARIANT in ``payload``, and that is
what is stored: later reads of the stored table parse no text. Nothing leaves the tasks that read the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ratinglens.functions.payload import parsed_body
from ratinglens.sources import versions

#: Columns of a response by kind.
RESPONSES = {
    "details": "entity_id string, status int, body string, captured_at string",
    "comments": "entity_id string, title string, sample_label string, page_start int, asked int, status int, body string, captured_at string",
    "search": "tag string, tag_order int, page_start int, asked int, status int, body string, captured_at string",
}
_TEXT = "malformed"


def read_landed(
    spark: SparkSession, path: str, kind: str, form: str = "json", stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """The landed responses of a kind with ``malformed``, ``landed_in`` and ``payload``.

    With ``stream`` new files are read as they land, ``files_per_batch`` at a time.
    """
    if form not in ("json", "parquet"):
        raise ValueError("form is json or parquet")
    reader = spark.readStream if stream else spark.read
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if form == "json":
        found = reader.schema(f"{RESPONSES[kind]}, {_TEXT} string").options(mode="PERMISSIVE", columnNameOfCorruptRecord=_TEXT).json(path)
    else:
        found = reader.schema(RESPONSES[kind]).parquet(path).withColumn(_TEXT, F.lit(None).cast("string"))
    columns = [c for c in found.columns if c != "body"]
    return found.select(*columns, F.col("_metadata.file_path").alias("landed_in"), parsed_body(F.col("body")).alias("payload"))


def store(responses: DataFrame, path: str) -> versions.Version:
    """Add landed responses with their parsed payloads to a versioned table."""
    return versions.append(responses, path)


def store_stream(responses: DataFrame, path: str, checkpoint: str, name: str = "landed") -> StreamingQuery:
    """Add responses as they land, each batch once, until the source is drained."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        versions.append(batch, path, batch=(name, batch_id))

    return responses.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def lines_of(responses: DataFrame) -> DataFrame:
    """The responses as JSON lines, for ``write.text``."""
    return responses.select(F.to_json(F.struct("*")).alias("value"))
