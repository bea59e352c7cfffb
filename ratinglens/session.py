"""Session settings and the durable folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC keeps zone-less source text and zoned text comparable. Skew handling is
# forced because a single key may hold a large part of a table.
# Methods too long for the JIT compiler would run interpreted: wide projections
# then use Spark's split code instead of one generated method.
# Shuffles pack narrow rows closely, and a task may hold several times their
# size in hash maps and sorts: small partitions keep it bounded at any input.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a given session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ratinglens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # call sites of every column expression cost seconds on wide plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def durable_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster, or set by ``setCheckpointDir``; a local one only in local mode.

    On a cluster a machine-local folder would give readers an empty table, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), "ratinglens-checkpoints")


def durable_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{durable_root(spark).rstrip('/')}/ratinglens/{name}-{uuid.uuid4().hex}"


_staged_paths: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Later passes scan Parquet with column pruning instead of repeating the
    upstream shuffles, and a lost executor costs no recomputation. ``drop_staged``
    removes the copies once nothing reads them any more.
    """
    path = durable_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    _staged_paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def track(path: str) -> str:
    """Remember a folder below the shared one that ``drop_staged`` has to delete too."""
    _staged_paths.append(path)
    return path


def drop_staged(spark: SparkSession) -> int:
    """Delete every staged copy this driver has made; frames that read them are no longer usable."""
    context = spark.sparkContext
    for path in (paths := list(_staged_paths)):
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
        _staged_paths.remove(path)
    return len(paths)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Staged copies live as long as the block; write or collect results inside it."""
    try:
        yield
    finally:
        drop_staged(spark)
