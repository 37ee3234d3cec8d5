"""The same operators over files as they arrive, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grid import Extent, cell_counts
from ..operators.policy import Policy, with_drop_reason
from ..operators.qc import qc_flags
from ..sources import snapshots
from ..sources.files import exists

#: Where keyed state lives: on the executors' disks, with its log in the checkpoint, so that it may outgrow memory.
PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed(spark: SparkSession, folder: str, schema, per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of a folder; each is read once per checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def ingest(stream: DataFrame, out: str, checkpoint: str, by_clock: bool = False) -> None:
    """Appends what is new and stops; called again it goes on where it stopped.

    by_clock: for state that expires by the clock, as dedup_exact() has it. It would ask for batches without data for ever;
    so it is looked at when there is data.
    """
    conf = stream.sparkSession.conf
    own = {PROVIDER: ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": str(not by_clock).lower()}
    was = {k: conf.get(k) for k in own}
    try:
        for k, v in own.items():
            conf.set(k, v)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for k, v in was.items():
            conf.set(k, v)
    query.awaitTermination()


def dedup(stream: DataFrame, keys: list[str], landed_at: str, late: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark of the landing time. Copies that come later than that pass."""
    return stream.withWatermark(landed_at, late).dropDuplicatesWithinWatermark(keys)


def _first_rows(keys: list[str], order: list[str], piece: int = 100_000):
    """Two functions on Arrow batches that keep the first row of each key by ``order``, nulls first.

    The first thins each batch before the shuffle: a key with many rows sends one a batch. The second takes the pieces of a
    bucket of keys; it never holds more than twice the bucket's keys and ``piece`` rows. Both carry what they call, so that
    workers need not have this module.
    """

    def firsts(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"))
        places = rows.select(keys).append_column("_at", pa.array(range(rows.num_rows), pa.int64()))
        return rows.take(places.group_by(keys, use_threads=False).aggregate([("_at", "min")])["_at_min"]).combine_chunks().to_batches()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield from firsts([rows])

    def of_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new, old = [], 0, 0
        for rows in batches:
            held.append(rows.drop_columns("_bucket"))
            new += rows.num_rows
            if new > max(old, piece):
                held = firsts(held)
                new, old = 0, sum(r.num_rows for r in held)
        if held:
            yield from firsts(held)

    return of_batches, of_bucket


def dedup_exact(stream: DataFrame, keys: list[str], landed_at: str, order: list[str] = (), keep: str = "365 days", buckets: int = 512) -> DataFrame:
    """The first row of each key, whenever its copies come: a late row goes only if its key was seen.

    Of rows that come in one batch the first by landed_at, then by ``order``, passes; nulls come first. They are found by
    ``buckets`` of keys, many keys at a time; then Spark's own state, which lies in RocksDB, lets those pass whose key it has
    not seen. A key is forgotten ``keep`` after it passed, by the clock, which bounds the state: its event time is the time
    of its batch, so no row is late. A watermark holds a key for its delay behind an event time that is itself the delay
    ago, so the delay is half of ``keep``. See ingest(by_clock=True).
    """
    number, unit = keep.split()
    ms = int(number) * {"day": 86_400_000, "hour": 3_600_000, "minute": 60_000}[unit.removesuffix("s")]
    of_batches, of_bucket = _first_rows(keys, [landed_at, *order])
    thinned = stream.mapInArrow(of_batches, stream.schema)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    firsts = thinned.withColumn("_bucket", bucket).groupBy("_bucket").applyInArrow(of_bucket, stream.schema)
    timed = firsts.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", f"{ms // 2} milliseconds")
    return timed.dropDuplicatesWithinWatermark(keys).drop("_seen")


def judged(stream: DataFrame, policy: Policy, as_of: Column) -> DataFrame:
    """QC flags and the policy's drop reason on a stream: both are stateless columns."""
    return with_drop_reason(qc_flags(stream, as_of), policy, as_of)


def _delta(root: str, batch_id: int) -> str:
    return f"{root}/deltas/{batch_id:012d}"


def add_counts(batch: DataFrame, batch_id: int, root: str, extent: Extent, fold: int = 50) -> None:
    """Writes the cell counts of one batch under its id, which replaces what an earlier try of it left. Only the batch is read.

    Each ``fold`` batches all deltas so far become one base, published at once; readers add the later deltas to it.
    """
    spark = batch.sparkSession
    cell_counts(batch, extent).write.mode("overwrite").parquet(_delta(root, batch_id))
    if (batch_id + 1) % fold == 0:
        base = f"{root}/bases"
        if folded(spark, root) < batch_id:
            entry = snapshots.write_table(counts_now(spark, root, batch_id), base, f"{batch_id:012d}")
            snapshots.commit(spark, base, entry, replace=True)


def folded(spark: SparkSession, root: str) -> int:
    """The last batch that the base holds; -1 without a base."""
    return max((int(k) for k in snapshots.manifest(spark, f"{root}/bases")), default=-1)


def counts_now(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """(species_slug, row, col, n) of all batches: the base and the deltas after it. upto: the last batch that counts."""
    entries = snapshots.manifest(spark, f"{root}/bases")
    base, last = snapshots.read(spark, list(entries.values())), max((int(k) for k in entries), default=-1)
    names = sorted(int(n) for n in snapshots._names(spark, f"{root}/deltas") if n.isdigit())
    paths = [_delta(root, n) for n in names if n > last and (upto is None or n <= upto) and exists(spark, f"{_delta(root, n)}/_SUCCESS")]
    schema = "species_slug string, row int, col int, n int"
    frames = [f for f in (base, spark.read.schema(schema).parquet(*paths) if paths else None) if f is not None]
    if not frames:
        return spark.createDataFrame([], schema)
    both = frames[0] if len(frames) == 1 else frames[0].union(frames[1])
    return both.groupBy("species_slug", "row", "col").agg(F.sum("n").cast("int").alias("n"))


def grid_counts(stream: DataFrame, root: str, checkpoint: str, extent: Extent, fold: int = 50) -> None:
    """Keeps cell counts of a stream of points below root, by deltas: see add_counts() and counts_now()."""
    step = lambda batch, batch_id: add_counts(batch, batch_id, root, extent, fold)
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
