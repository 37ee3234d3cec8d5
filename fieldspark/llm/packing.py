"""Bounded-space online packing of tokenized documents into fixed-length sequences.

Each partition keeps a fixed number of open windows. A piece goes where it fits best. When it fits nowhere and no more
windows may open, the fullest is emitted: as it is if its gap is within the slack, else the piece's head fills it and
the rest goes on. At a partition's end the open windows are poured together, which leaves at most one part-filled
window; those of many partitions are merged in rounds of ``fan`` until one is left, which is cut into powers of two.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import buffers, slices
from .store import shared_dir, stored
from .word_bpe import word_bpe
from .worker import tidy

_FIELDS = [("doc_id", "long"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"), ("group", "long"), ("ids", "binary")]
SCHEMA = ", ".join(f"`{n}` {t}" for n, t in _FIELDS)
_ARROW = pa.schema([(n, pa.int64() if t == "long" else pa.binary()) for n, t in _FIELDS])


class Packer:
    """One partition's windows. A piece: (doc_id, start, ids, doc_tokens). Rows come out as in SCHEMA."""

    def __init__(self, length: int, windows: int, slack: int, first: int):
        self.length, self.windows, self.slack, self.next = length, windows, slack, first
        self.gaps: list[tuple[int, int]] = []  # sorted (gap, window)
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []
        self.made = 0

    def emit(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, at, None, None))
            at += len(ids)
        self.next += 1

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        n = self.length
        while len(ids) >= n:
            self.emit([(doc, start, ids[:n], total)])
            start, ids = start + n, ids[n:]
        while len(ids):
            i = bisect_left(self.gaps, (len(ids), -1))
            if i < len(self.gaps):
                gap, w = self.gaps.pop(i)
                self.open[w].append((doc, start, ids, total))
                if gap == len(ids):
                    self.emit(self.open.pop(w))
                else:
                    insort(self.gaps, (gap - len(ids), w))
                return
            if len(self.gaps) < self.windows:
                self.made += 1
                self.open[self.made] = [(doc, start, ids, total)]
                insort(self.gaps, (n - len(ids), self.made))
                return
            gap, w = self.gaps.pop(0)
            pieces = self.open.pop(w)
            if gap > self.slack:
                pieces.append((doc, start, ids[:gap], total))
                start, ids = start + gap, ids[gap:]
            self.emit(pieces)

    def pour(self, last: bool) -> None:
        """Merges the open windows; what is left of them is kept in rows with ids, or is cut if this is the last task."""
        held, room = [], self.length
        for _, w in self.gaps:
            for doc, start, ids, total in self.open[w]:
                while len(ids):
                    part = ids[:room]
                    held.append((doc, start, part, total))
                    start, ids, room = start + len(part), ids[len(part) :], room - len(part)
                    if not room:
                        self.emit(held)
                        held, room = [], self.length
        self.gaps, self.open = [], {}
        if last:
            used = self.length - room
            for size in (1 << b for b in range(used.bit_length() - 1, -1, -1) if used >> b & 1):
                part, need = [], size
                while need:
                    doc, start, ids, total = held.pop(0)
                    part.append((doc, start, ids[:need], total))
                    if len(ids) > need:
                        held.insert(0, (doc, start + need, ids[need:], total))
                    need -= len(part[-1][2])
                self.emit(part)
        else:
            self.rows += [(doc, start, len(ids), None, total, None, None, None, ids.astype("<u4").tobytes()) for doc, start, ids, total in held]

    def take(self, group: int) -> pa.RecordBatch:
        rows, self.rows = [(*r[:7], group if r[8] is not None else None, r[8]) for r in self.rows], []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW) if rows else pa.RecordBatch.from_pylist([], schema=_ARROW)


def _first(level: int, group: int) -> int:
    return (level << 58) | (group << 32)


def _pack_texts(path: str, end_id: int, length: int, windows: int, slack: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_bpe(path)
        group = TaskContext.get().partitionId()
        packer = Packer(length, windows, slack, _first(0, group))
        for whole in batches:
            for b in slices(whole, size=2 << 20):
                data, off = buffers(b.column("text"))
                ids, n = tok.ids(data, off)
                edge = np.concatenate(([0], np.cumsum(n)))
                for i, d in enumerate(b.column("doc_id").to_pylist()):
                    own = np.append(ids[edge[i] : edge[i + 1]], np.uint32(end_id))
                    packer.add(d, 0, own, len(own))
                yield packer.take(group)
        packer.pour(False)
        yield packer.take(group)

    return run


def _pack_rest(level: int, length: int, windows: int, slack: int, last: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId()
        packer = Packer(length, windows, slack, _first(level, group))
        rows = [r for b in batches for r in b.to_pylist()]
        for r in sorted(rows, key=lambda r: (r["group"], r["doc_id"] is None, r["doc_id"], r["start"], r["ids"])):
            packer.add(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
        packer.pour(last)
        yield packer.take(group)

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048, windows: int = 64, slack: int = 8, fan: int = 64) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece of docs (doc_id, text).

    A document is its ids by the tokenizer file, without special tokens added, and then end_id; white space must part
    the tokenizer's pieces. ``length`` must be a power of two. Pieces of a sequence fill it without gaps from offset 0;
    a sequence lacks at most ``slack`` ids, and the last ones are powers of two long. A null or empty text is end_id
    alone. Null or repeated doc_ids and repeated rows are packed each on its own; other columns are ignored; an empty
    table gives an empty table. Sequence ids are unique, not consecutive. Only part-filled windows, one per task, are
    shuffled.
    """
    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_pack_texts(tokenizer_path, end_id, length, windows, slack), SCHEMA)
    folder, level = shared_dir(docs.sparkSession, "packing"), 0
    out = stored(out, f"{folder}/0")
    done = [out.where("ids is null")]
    groups = (out.where("ids is not null").agg(F.max("group")).first()[0] or 0) + 1
    while True:
        level, groups = level + 1, -(-groups // fan)
        rest = out.where("ids is not null").withColumn("to", (F.col("group") / fan).cast("int")).repartitionById(groups, F.col("to")).drop("to")
        out = stored(rest.mapInArrow(_pack_rest(level, length, windows, slack, groups == 1), SCHEMA), f"{folder}/{level}")
        done.append(out.where("ids is null"))
        if groups == 1:
            break
    result = done[0]
    for d in done[1:]:
        result = result.union(d)
    return result.drop("group", "ids")
