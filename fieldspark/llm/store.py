"""The shared folder for tables and files that a job writes on its way."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Unset, it becomes a temp folder in local mode (tests) and an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "fieldspark-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes finished tables below the shared folder that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Writes df below the shared folder and reads it back: cuts the lineage, survives lost executors.

    What was shuffled for it has no more use once it is written, so Spark is told to drop those files.
    """
    conf = df.sparkSession.conf
    was = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.set(CLEANUP, was)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _fs(path: str):
    if "://" not in path:
        path = "file://" + os.path.abspath(path) if not path.startswith("file:") else "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def write_file(path: str, data: bytes) -> None:
    """Writes whole or not at all. A repeated or speculative task must bring equal bytes or another name."""
    fs, p = _fs(path)
    fs.create_dir(os.path.dirname(p), recursive=True)
    part = f"{p}.{uuid.uuid4().hex[:8]}.part"
    with fs.open_output_stream(part, compression=None) as f:
        f.write(data)
    fs.move(part, p)


def read_file(path: str) -> bytes:
    fs, p = _fs(path)
    with fs.open_input_stream(p, compression=None) as f:
        return f.read()


def map_array(path: str, dtype) -> np.ndarray:
    """The file's array, memory-mapped. A file of a remote store is copied to an unlinked local file first."""
    fs, p = _fs(path)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(p, dtype, "r") if os.path.getsize(p) else np.zeros(0, dtype)
    with tempfile.NamedTemporaryFile(delete=False) as out:
        try:
            with fs.open_input_stream(p, compression=None) as f:
                while piece := f.read(16 << 20):
                    out.write(piece)
            out.flush()
            return np.memmap(out.name, dtype, "r") if out.tell() else np.zeros(0, dtype)
        finally:
            with contextlib.suppress(OSError):
                os.unlink(out.name)


def hashed_sample(df: DataFrame, most: int, *columns: str) -> DataFrame:
    """At most ``most`` rows of df, those with the smallest hashes of the columns.

    Rows are first thinned by their hashes to about twice as many, so that each task sends few to where they meet.
    """
    h, n = F.xxhash64(*columns), df.count()
    if n > 2 * most:
        share = min(1.0, (2 * most + 200) / n)
        df = df.where(h < min(2**63 - 1, int(share * 2**64) - 2**63))
    return df.orderBy(h, *columns).limit(most)
