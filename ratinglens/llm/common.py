"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper case ASCII becomes lower case; ASCII that is neither letter nor digit becomes a space. Bytes from 0x80 on stay.
PLAIN_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


#: Rows of an Arrow batch at most; with long texts Spark's limit in bytes cuts earlier. Small batches keep Python workers small.
BATCH_ROWS = 1_000


def _small_batches(df: DataFrame) -> None:
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters, as UTF-8; none for a null."""
    return [] if text is None else utf8(text).translate(PLAIN_BYTES).split()


def spaced_words(text: str | None) -> list[bytes]:
    """Runs of characters other than ASCII white space, as UTF-8; none for a null."""
    return [] if text is None else utf8(text).split()


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def map_rows(df: DataFrame, schema: str, rows: Callable[..., Iterable[tuple]], batch: int = 4096) -> DataFrame:
    """Apply rows(iterator of input tuples) to each partition and give its tuples as rows of a DataFrame.

    Values pass as Arrow batches; at most `batch` output rows are held at a time.
    """
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held: list[tuple] = []
        for row in rows(source):
            held.append(row)
            if len(held) >= batch:
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    types = [arrow_type(part.strip().split(" ")[1]) for part in schema.split(",")]

    def pack(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names)

    _small_batches(df)
    return df.mapInArrow(run, schema)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def arrow_type(name: str) -> pa.DataType:
    return _ARROW[name]


def shuffled(df: DataFrame) -> DataFrame:
    """The table, marked so that a join with it deals both sides by key instead of sending one of them to the driver.

    Spark broadcasts a side that it takes for small, but its sizes leave out the rows that an explode adds and what
    packed columns grow to in memory. For tables that grow with the corpus.
    """
    return df.hint("merge")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def text_key(text: str = "text") -> Column:
    """64-bit identity of a text; a null counts as the empty text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def crc_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of a doc_id as text, modulo a number; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def add_columns(
    df: DataFrame, text: str, schema: str, values: Callable[[list], list[tuple]], keep_text: bool = True
) -> DataFrame:
    """Append columns computed from one column, batch by batch, without a shuffle.

    values(texts) gives one tuple per text. Other columns pass through untouched; those named like a new column are
    replaced. Without keep_text the column read is left out, which saves its way back.
    """
    parts = [part.strip().split(" ") for part in schema.split(",")]
    new_names = [name for name, _ in parts]
    kept = [c for c in df.columns if c not in new_names and (keep_text or c != text)]
    passed = [c for c in kept if c != text]
    source = df.select(*(F.col(f"`{c}`") for c in passed), F.col(f"`{text}`"))
    fields = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    out_schema = ", ".join([*(f"`{c}` {fields[c]}" for c in kept), *(f"`{name}` {kind}" for name, kind in parts)])
    types = [arrow_type(kind) for _, kind in parts]
    order = [passed.index(c) if c != text else len(passed) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            new = zip(*values(b.column(b.num_columns - 1).to_pylist()), strict=True)
            arrays = [pa.array(list(c), type=t) for c, t in zip(new, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in order), *arrays], names=[*kept, *new_names])

    _small_batches(df)
    return source.mapInArrow(run, out_schema)
