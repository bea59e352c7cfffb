"""Contract tables in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratinglens.contracts import (
    HEADERS,
    bronze_schema,
    check_same_header,
    check_same_types,
    empty_table,
    export_headers,
    project,
    rename_headers,
    require_columns,
)
from ratinglens.functions.text import null_tokens
from ratinglens.sources import versions

# Texts that data-frame CSV readers take for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Tables whose texts may hold line breaks; their files cannot be split among tasks.
MULTI_LINE = frozenset({"comments"})


def read_csv(spark: SparkSession, path: str, table: str, multi_line: bool | None = None) -> DataFrame:
    """All-text scan of a CSV under the source headers; a missing path is an error.

    The header of one file gives the layout, and a layout without a contract column fails at once. The header of every
    file is then held against it while that file is read, so a file with other columns or another order is an
    error and never shifts values. Files that hold line breaks inside a value need ``multi_line``, by default only the
    tables in ``MULTI_LINE``.
    """
    options = {"header": True, "escape": '"', "encoding": "UTF-8"}
    options["multiLine"] = table in MULTI_LINE if multi_line is None else multi_line
    found = spark.read.options(**options | {"inferSchema": False}).csv(path)
    require_columns(found, HEADERS[table], path)
    checked = spark.read.schema(found.schema).options(**options | {"enforceSchema": False}).csv(path)
    return rename_headers(checked.select(*HEADERS[table]), table)


def missing_as_null(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Every text column with its missing-value tokens turned into NULL."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select([null_tokens(F.col(c), tokens).alias(c) if c in text else F.col(c) for c in df.columns])


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a versioned table, or a plain Parquet folder."""
    return versions.read(spark, path) if versions.is_versioned(spark, path) else spark.read.parquet(path)


def read_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    return project(read_stored(spark, path), list(HEADERS[table].values()))


def read_optional(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The stored table, or an empty one of the same contract when nothing is stored."""
    try:
        return read_parquet(spark, path, table)
    except AnalysisException as error:
        if versions.not_found(error):
            return empty_table(spark, bronze_schema(table))
        raise


def overwrite_table(df: DataFrame, path: str, columns: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Publish the rows as the table's next version; a failing job, or a reader meanwhile, finds the version before."""
    versions.overwrite(project(df, columns), path, partition_by)


def append_table(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append rows after the exact test of column names, order and types against what is stored.

    A versioned table gets a new version, a plain Parquet folder more files; where nothing is stored, a plain folder is made.
    """
    rows = project(df, columns)
    if versions.is_versioned(df.sparkSession, path):
        versions.append(rows, path)
        return
    try:
        stored = df.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if not versions.not_found(error):
            raise
    else:
        check_same_header(stored.columns, columns, path)
        check_same_types(stored, rows, path)
    rows.write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str, table: str) -> None:
    """CSV under the source headers, a folder of part files each with the header."""
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    export_headers(df, table).write.mode("overwrite").options(**options).csv(path)
