"""Hard negatives by exact inner products of integer vectors, many at once in wide integers.

Components become floor(256 * x). In a task a block of candidates is packed: for each component, those of all candidates,
made non-negative by a bias, lie in fields of one wide integer. An anchor multiplies each of these integers once by its own
component and adds them up; the fields of the sum are all its inner products with the block, the biases' share taken off.
Fields are as wide as the block and the anchors need, so sums never run over.

Anchors meet candidates twice, in blocks of rows by blocks of anchors: first those of their label, for the positives, then
all, for the negatives whose scores lie in the bands that the positives set.
"""

from __future__ import annotations

from math import floor, isfinite

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import shared_dir, stored
from .worker import release, tidy

#: Scores that don't fit 64 bits stand at the ends of their range.
LOW, HIGH = -(2**63), 2**63 - 1
#: Below this magnitude all integers are doubles and fit 64 bits.
_EXACT = 2.0**52


def quantised(vectors: list[np.ndarray], scale: int = 256) -> np.ndarray:
    """floor(scale * x) of rows of equal length: int64, or Python's integers if a component is that large."""
    x = np.stack(vectors) if vectors else np.zeros((0, 0))
    if not x.size or np.abs(x).max() < _EXACT / scale:
        return np.floor(x * scale).astype(np.int64)
    return np.array([[floor(v * scale) if isfinite(v * scale) else int(v) * scale for v in row] for row in x.tolist()], object)


class Packed:
    """A block of candidates (rows of integers) whose components lie in fields of wide integers, one integer per component."""

    def __init__(self, rows: np.ndarray, largest: int):
        """largest: the greatest magnitude of any component of the anchors that will ask."""
        self.n, dim = rows.shape
        self.bias = max(0, -int(rows.min())) if rows.size else 0
        top = self.bias + (int(rows.max()) if rows.size else 0)
        self.reach = dim * top * largest  # no sum of a field is larger in magnitude
        size = -(-(2 * self.reach).bit_length() // 8)
        self.size = 4 if size <= 4 else 8 * (-(-size // 8)) or 4
        self.wide = [self._fields(rows[:, j] + self.bias) for j in range(dim)]
        self.level = self._fields(np.full(self.n, self.reach, np.int64 if self.reach < 1 << 62 else object))

    def _fields(self, values: np.ndarray) -> int:
        if self.size <= 8 and values.dtype != object:
            return int.from_bytes(values.astype(f"<u{self.size}").tobytes(), "little")
        return int.from_bytes(b"".join(int(v).to_bytes(self.size, "little") for v in values), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product of the anchor with each candidate, as int64."""
        total = self.level
        for a, w in zip(anchor, self.wide):
            if a:
                total += a * w
        raw, off = total.to_bytes(self.size * self.n, "little"), self.reach + self.bias * sum(anchor)
        if self.size <= 8 and self.reach < 1 << 61 and abs(off) < 1 << 62:
            return np.frombuffer(raw, f"<u{self.size}").astype(np.int64) - off
        each = (int.from_bytes(raw[i : i + self.size], "little") - off for i in range(0, len(raw), self.size))
        return np.array([min(max(v, LOW), HIGH) for v in each], np.int64)


def _vectors(column) -> list[np.ndarray]:
    return [np.frombuffer(v, np.float64) for v in column.to_pylist()]


def _first(score: np.ndarray, ids: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id, then order."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((order[at], ids[at], np.invert(score[at])))[:k]]


def _blocks(rows: pa.Table, anchors: pa.Table):
    """(packed rows, anchors as lists of integers) of one task."""
    x, q = quantised(_vectors(rows.column("v"))), quantised(_vectors(anchors.column("v")))
    return Packed(x, int(np.abs(q).max()) if q.size else 0), q.tolist()


_POSITIVE = pa.schema([("anchor", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if rows.num_rows and anchors.num_rows:
            packed, q = _blocks(rows, anchors)
            ids, row = rows.column("vec_id").to_numpy(), rows.column("row").to_numpy()
            for no, own, a in zip(anchors.column("anchor").to_pylist(), anchors.column("anchor_id").to_pylist(), q):
                score, other = packed.scores(a), np.flatnonzero(ids != own)
                best = other[_first(score[other], ids[other], row[other], k)]
                for to, what in zip(out, (np.full(len(best), no), row[best], ids[best], score[best])):
                    to.append(what)
        return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], schema=_POSITIVE)

    return run


_NEGATIVE = pa.schema([("anchor_id", pa.int64()), ("anchor", pa.int64()), ("place", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _negatives(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[] for _ in _NEGATIVE]
        if rows.num_rows and anchors.num_rows:
            packed, q = _blocks(rows, anchors)
            ids, row, label = (rows.column(c).to_numpy() for c in ("vec_id", "row", "label"))
            names = ("anchor_id", "anchor", "label", "positives")
            for own, no, its, positives, a in zip(*(anchors.column(c).to_pylist() for c in names), q):
                score, other = packed.scores(a), np.flatnonzero((label != its) & (ids != own))
                s = score[other]
                for p in positives:
                    least, most = -(-low * p["score"] // 100), high * p["score"] // 100
                    if least > most:
                        continue
                    within = other[(s >= least) & (s <= most)]
                    best = within[_first(score[within], ids[within], row[within], k)]
                    same = (np.full(len(best), v, np.int64) for v in (own, no, p["place"], p["vec_id"], p["score"]))
                    for to, what in zip(out, (*same, row[best], ids[best], score[best])):
                        to.append(what)
        return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], schema=_NEGATIVE)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, v, row): rows without a null id, label or vector, all components there and finite; v holds the doubles' bytes."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), v.alias("v")).where("vec_id is not null and label is not null and v is not null")
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return rows.mapInArrow(_as_bytes, "vec_id long, label long, dim int, v binary").withColumn("row", F.monotonically_increasing_id())


@tidy
def _as_bytes(batches):
    for b in batches:
        lists = b.column("v")
        size = lists.value_lengths().to_numpy() if b.num_rows else np.zeros(0, np.int32)
        flat, end = lists.flatten().to_numpy(), np.cumsum(size)
        raw = [flat[e - n : e].tobytes() for e, n in zip(end.tolist(), size.tolist())]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(size, pa.int32()), pa.array(raw, pa.binary())], ["vec_id", "label", "dim", "v"])


def _paired(rows: DataFrame, anchors: DataFrame, keys: list[str], block: int, anchor_block: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """rows and anchors of equal keys, in blocks: every block of rows meets every block of anchors under its own key."""
    count = lambda df, size, name: df.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    sizes = stored(count(rows, block, "_of").join(count(anchors, anchor_block, "_to"), keys), shared_dir(rows.sparkSession, "blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    a = rows.join(sizes, keys).withColumn("_block", own("row", "_of")).withColumn("_by", every("_to")).drop("_of", "_to")
    b = anchors.join(sizes, keys).withColumn("_by", own("anchor", "_to")).withColumn("_block", every("_of")).drop("_of", "_to")
    return a, b, [*keys, "_block", "_by"]


def _tidy_pair(run):
    """The function of a cogroup, after which freed memory goes back."""
    def whole(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        try:
            return run(rows, anchors)
        finally:
            release()

    return whole


def hard_negatives(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, block: int = 4_096, anchor_block: int = 2_048) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, label, embedding).

    A score is the inner product of two rows' integers floor(256 * x). An anchor's positives are the first of the other
    rows of its label, by score downwards, ties by the smaller vec_id. For each, its negatives are the first rows of other
    labels whose score is from ``low`` to ``high`` hundredths of the positive's. A positive with a score below zero has
    none, one with zero those with zero.

    Rows that usable() leaves out take no part. Other rows are those of another vec_id; repeated rows are candidates of
    their own, then come by their order in the input. An anchor row that is repeated asks once; different anchor rows
    under one vec_id each ask. Vectors of different lengths don't meet. Scores beyond 64 bits stand at the ends of
    their range. Blocks of rows and of anchors bound what meets in one task, whatever a label has. An empty table gives an
    empty table; other columns are ignored.
    """
    folder = shared_dir(vectors.sparkSession, "negatives")
    rows = stored(usable(vectors), f"{folder}/rows")
    asked = rows.where(is_anchor).groupBy("vec_id", "label", "dim", "v").agg(F.min("row").alias("anchor")).withColumnRenamed("vec_id", "anchor_id")
    asked = stored(asked, f"{folder}/anchors")
    a, b, keys = _paired(rows, asked, ["label", "dim"], block, anchor_block)
    near = a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(_tidy_pair(_positives(n_positives)), "anchor long, row long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row"))
    best = near.withColumn("place", place).where(F.col("place") <= n_positives)
    best = best.groupBy("anchor").agg(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "vec_id", "score")).alias("positives"))
    told = stored(asked.join(best, "anchor"), f"{folder}/positives")
    a, b, keys = _paired(rows, told, ["dim"], block, anchor_block)
    schema = "anchor_id long, anchor long, place long, positive_id long, positive_score long, row long, vec_id long, score long"
    far = a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(_tidy_pair(_negatives(n_negatives, low, high)), schema)
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "row"))
    return far.withColumn("rank", rank).where(F.col("rank") <= n_negatives).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def shifted_label(every: int = 7, labels: int = 10) -> Column:
    """The label, one further (modulo ``labels``) where vec_id is divisible by ``every``."""
    return F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
