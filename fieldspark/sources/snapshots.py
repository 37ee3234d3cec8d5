"""Tables that are published whole: data first, then one manifest that readers resolve.

Below a root, ``data/`` holds folders that are written once, and ``snapshots/`` numbered manifests, one small file each. A
manifest names, for each entry (a species, or a table of a grid), the folder that holds it and when it was published. It is
written under another name and renamed; the highest number counts. A job that dies before the rename has changed nothing
that a reader sees. Two writers at once: the second to rename finds its number taken and starts from the new manifest.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The folder of one entry within what a job has written.
PART = "of_species_slug"


@dataclass(frozen=True)
class Entry:
    path: str
    modified: int  # milliseconds since 1970
    schema: str  # JSON


#: The JVM compiles no method of more bytes.
METHOD_BYTES = 8000


@contextmanager
def compilable(spark: SparkSession):
    """While it holds, steps whose generated code would be too long for the JVM to compile are run operator by operator.

    For writes of wide frames: their chains of columns would be interpreted. It changes no result.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(min(int(before), METHOD_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def latest(spark: SparkSession, root: str) -> int:
    """The number of the last manifest; 0 without any."""
    return max((int(n.removesuffix(".json")) for n in _names(spark, f"{root}/snapshots") if n.removesuffix(".json").isdigit()), default=0)


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict[str, Entry]:
    """The entries of a manifest, of the last one unless a number is given: a row per species, so it fits the driver."""
    number = latest(spark, root) if number is None else number
    if not number:
        return {}
    fs, at = _fs(spark, f"{root}/snapshots/{number}.json")
    stream = fs.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {k: Entry(**v) for k, v in json.loads(text).items()}


def _put(spark: SparkSession, root: str, number: int, entries: dict[str, Entry]) -> bool:
    """Whether the manifest of this number is now this one."""
    fs, to = _fs(spark, f"{root}/snapshots/{number}.json")
    _, part = _fs(spark, f"{root}/snapshots/{number}-{uuid.uuid4().hex[:8]}.part")
    fs.mkdirs(part.getParent())
    out = fs.create(part, False)
    try:
        out.write(bytearray(json.dumps({k: vars(e) for k, e in sorted(entries.items())}).encode()))
    finally:
        out.close()
    if not fs.exists(to) and fs.rename(part, to):
        return True
    fs.delete(part, False)
    return False


def commit(spark: SparkSession, root: str, new: dict[str, Entry], replace: bool = False) -> int:
    """Publishes the entries, beside those of before unless ``replace``, as the next manifest; its number."""
    for _ in range(20):
        number = latest(spark, root)
        if _put(spark, root, number + 1, new if replace else {**manifest(spark, root, number), **new}):
            return number + 1
    raise RuntimeError(f"other writers keep publishing to {root}")


def write_species(df: DataFrame, root: str) -> dict[str, Entry]:
    """Writes df below the root, a folder per species, for commit(). Nobody sees it before."""
    spark, folder = df.sparkSession, f"{root}/data/{uuid.uuid4().hex}"
    with compilable(spark):
        df.withColumn(PART, F.col("species_slug")).write.partitionBy(PART).parquet(folder)
    now, schema = int(time.time() * 1000), df.schema.json()
    return {n.removeprefix(f"{PART}="): Entry(f"{folder}/{n}", now, schema) for n in _names(spark, folder) if n.startswith(f"{PART}=")}


def write_table(df: DataFrame, root: str, name: str) -> dict[str, Entry]:
    """Writes df below the root as one entry for commit()."""
    folder = f"{root}/data/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return {name: Entry(folder, int(time.time() * 1000), df.schema.json())}


def read(spark: SparkSession, entries: list[Entry]) -> DataFrame | None:
    """The rows of all entries; None without any. Entries of one schema are one scan."""
    out = None
    for schema in dict.fromkeys(e.schema for e in entries):
        some = spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*(e.path for e in entries if e.schema == schema))
        out = some if out is None else out.unionByName(some, allowMissingColumns=True)
    return out


def expire(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Deletes the manifests before the last ``keep``, and data that none of the rest names; how many folders went.

    Not while a writer is at work: what it has written is named by no manifest yet.
    """
    last = latest(spark, root)
    held = {e.path for n in range(max(1, last - keep + 1), last + 1) for e in manifest(spark, root, n).values()}
    gone = 0
    for n in range(1, last - keep + 1):
        fs, at = _fs(spark, f"{root}/snapshots/{n}.json")
        fs.delete(at, False)
    for name in _names(spark, f"{root}/data"):
        folder = f"{root}/data/{name}"
        parts = [f"{folder}/{p}" for p in _names(spark, folder) if p.startswith(f"{PART}=")] or [folder]
        kept = [p for p in parts if p in held]
        for p in [folder] if not kept else [p for p in parts if p not in held]:
            fs, at = _fs(spark, p)
            fs.delete(at, True)
            gone += 1
    return gone
