"""Token ids of documents in binary shard files with a minimal perfect hash index.

A shard is two files: `.bin` holds a header and the raw ids of its documents in ascending doc_id order; `.idx` holds
where each document starts and, for each key, the place that a minimal perfect hash gives it: a fingerprint, the first
document with that key and how many follow. A key is found in constant time: hash, compare the fingerprint, read.

Files are named by task attempt; the manifest lists those of the attempts that succeeded, so a lost executor or a repeated
task leaves at most files that nothing refers to. Everything lies in the shared folder.

Null texts are empty and hold the end id alone. Documents with a null id come first and are read by place, as they
have no key; rows that share an id lie next to each other and are all found by it. An empty table gives no shard.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratinglens.llm.common import map_rows
from ratinglens.llm.tokens import encoder
from ratinglens.session import durable_path, staged, track

MAGIC = b"TOKSHARD"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A permutation of the 64-bit numbers for each seed."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Gives n distinct keys the places 0 .. n - 1.

    Each level is a bit array twice as long as the keys left; a key alone at its bit stays there, the others go on. A key's
    place is the number of set bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        counts = [0, *np.cumsum([int(b.sum()) for b in levels]).tolist()]
        self.ranks = [np.cumsum(b) - 1 + start for b, start in zip(levels, counts, strict=False)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(8, 2 * len(left))
            at = (mix(left, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1 if no level has its bit; a foreign key may get any place."""
        out = np.full(len(keys), -1, dtype=np.int64)
        waiting = np.arange(len(keys))
        for number, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True), 1):
            at = (mix(keys[waiting], number) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            out[waiting[here]] = rank[at[here]]
            waiting = waiting[~here]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0) >> np.uint64(32)).astype(np.uint32)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark resolves it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(target).toString()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    head = json.dumps({k: [a.dtype.str, len(a)] for k, a in arrays.items()}).encode()
    return MAGIC + len(head).to_bytes(8, "little") + head + b"".join(a.tobytes() for a in arrays.values())


def _unpack_arrays(data: bytes) -> dict[str, np.ndarray]:
    if data[:8] != MAGIC:
        raise ValueError("not an index of a token shard")
    at = 16 + int.from_bytes(data[8:16], "little")
    out = {}
    for name, (kind, size) in json.loads(data[16:at]).items():
        out[name] = np.frombuffer(data, dtype=kind, count=size, offset=at)
        at += out[name].nbytes
    return out


class ShardWriter:
    def __init__(self, path: str, dtype: str):
        self.system, self.path = _open(path)
        self.dtype, self.ends, self.keys, self.null = np.dtype(dtype), [], [], []
        self.out = self.system.open_output_stream(f"{self.path}.bin")
        self.out.write(MAGIC + self.dtype.str.encode().ljust(8))
        self.n_ids = 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(self.dtype).tobytes())
        self.n_ids += len(ids)
        self.ends.append(self.n_ids)
        self.keys.append(0 if key is None else key)
        self.null.append(key is None)

    def close(self) -> None:
        self.out.close()
        keys, null = np.array(self.keys, dtype=np.int64), np.array(self.null, dtype=bool)
        own, first, count = np.unique(keys[~null], return_index=True, return_counts=True)
        own = own.view(np.uint64)
        index = PerfectHash.build(own)
        places = index.places(own)
        stored, document, follow = np.empty(len(own), np.uint32), np.empty(len(own), np.int64), np.empty(len(own), np.int64)
        stored[places], document[places], follow[places] = fingerprint(own), first + int(null.sum()), count
        levels = {f"level{k}": np.packbits(b) for k, b in enumerate(index.levels)}
        sizes = np.array([len(b) for b in index.levels], dtype=np.int64)
        starts = np.array([0, *self.ends], dtype=np.int64)
        arrays = {"starts": starts, "keys": keys, "null": null, "stored": stored, "document": document, "follow": follow, "sizes": sizes}
        with self.system.open_output_stream(f"{self.path}.idx") as out:
            out.write(_pack_arrays(arrays | levels))


class Shard:
    """Reads the documents of a shard by key or by place."""

    def __init__(self, path: str):
        system, place = _open(path)
        with system.open_input_file(f"{place}.idx") as f:
            self.arrays = _unpack_arrays(f.read())
        self.file = system.open_input_file(f"{place}.bin")
        head = self.file.read_at(16, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a token shard")
        self.dtype = np.dtype(head[8:].decode().strip())
        sizes = self.arrays["sizes"].tolist()
        self.index = PerfectHash(
            [np.unpackbits(self.arrays[f"level{k}"], count=n).astype(bool) for k, n in enumerate(sizes)]
        )

    def __len__(self) -> int:
        return len(self.arrays["keys"])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of each key; the number is 0 for a key that is not there."""
        own = keys.astype(np.int64).view(np.uint64)
        place = self.index.places(own)
        there = place >= 0
        there[there] = self.arrays["stored"][place[there]] == fingerprint(own[there])
        first, count = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        first[there], count[there] = self.arrays["document"][place[there]], self.arrays["follow"][place[there]]
        return first, count

    def ids(self, document: int) -> tuple[int, np.ndarray]:
        """(where the document starts in the shard, its ids)."""
        start, end = self.arrays["starts"][document : document + 2].tolist()
        size = self.dtype.itemsize
        return start, np.frombuffer(self.file.read_at((end - start) * size, 16 + start * size), dtype=self.dtype)

    def close(self) -> None:
        self.file.close()


def write_shards(
    docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", folder: str | None = None
) -> DataFrame:
    """Write the shards and return their manifest: (shard, path, n_docs, n_ids, first_key, last_key).

    Documents are dealt into ranges of (doc_id, hash of the text), so that rows sharing an id can be in several shards.
    """
    spark = docs.sparkSession
    # qualified on the driver, so that all executors write to the file system that the session names
    folder = qualified(spark, folder or track(durable_path(spark, "tokens")))
    narrow = docs.select(F.col(doc_id).cast("long").alias("key"), F.col(text).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_first("key"), F.xxhash64("text")]
    dealt = narrow.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def rows(source: Iterable[tuple]) -> Iterable[tuple]:
        coder, writer, keys = encoder(tokenizer), None, []
        number = TaskContext.get().partitionId()
        name = f"{folder.rstrip('/')}/shard-{number:06d}-{uuid.uuid4().hex}"
        dtype = "<u2" if coder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        system, place = _open(folder)
        for key, encoded in coder.encode_rows(source):
            if writer is None:
                system.create_dir(place, recursive=True)
                writer = ShardWriter(name, dtype)
            writer.add(key, np.append(np.frombuffer(encoded, dtype="<u4"), np.uint32(end_id)))
            keys = [keys[0] if keys else key, key]
        if writer:
            writer.close()
            yield number, name, len(writer.keys), writer.n_ids, keys[0], keys[1]

    schema = "shard int, path string, n_docs long, n_ids long, first_key long, last_key long"
    return staged(map_rows(dealt, schema, rows), "manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the shard files by key.

    start counts the ids of all documents before it; the ids are read as unsigned 32-bit numbers.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    based = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"), "shard")
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(source: Iterable[tuple]) -> Iterator[tuple]:
        for path, base, _ in source:
            shard = Shard(path)
            keys, null = shard.arrays["keys"], shard.arrays["null"]
            own = np.unique(keys[~null])
            first, count = shard.find(own)
            if int(count.sum()) + int(null.sum()) != len(shard):
                raise ValueError(f"the index of {path} does not find all documents")
            known = zip(own.tolist(), first.tolist(), count.tolist(), strict=True)
            for key, at, size in [*((None, k, 1) for k in np.flatnonzero(null).tolist()), *known]:
                for document in range(at, at + size):
                    start, ids = shard.ids(document)
                    yield key, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())
            shard.close()

    return map_rows(based.repartition(n, "shard"), "doc_id long, start long, n_tokens long, ids_crc32 long", rows)


def fetch(spark: SparkSession, manifest: DataFrame, key: int) -> list[np.ndarray]:
    """The ids of the documents with one key: shards are chosen by their range, then asked for it."""
    held = manifest.where((F.col("last_key") >= key) & (F.coalesce("first_key", "last_key") <= key) | F.col("first_key").isNull())
    out = []
    for row in held.orderBy("shard").toLocalIterator():
        shard = Shard(row["path"])
        (first,), (count,) = shard.find(np.array([key]))
        out += [shard.ids(d)[1].astype(np.uint32) for d in range(first, first + count)]
        shard.close()
    return out
