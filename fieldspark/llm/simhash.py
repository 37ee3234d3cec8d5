"""SimHash fingerprints, the likeness of neighbouring documents, and the search within a Hamming radius.

Terms are runs of k words (k = 3; a shorter text is one term), weighted by 1 + ln(term frequency). Each term's hash
votes on every bit, for or against by its sign. Fingerprints have 128 bits. The search cuts them into radius + 2 blocks,
of which two fingerprints within the radius agree in at least two, so tables permuted to lead with each pair of blocks
find every pair, and the full distance is then checked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import U, buffers, by_text, mix, shingles, slices, words
from .store import partitions, shared_dir, stored

BITS = 128
_FIELDS = "kind int, part int, doc_id long, text string, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, next_fingerprint binary"
_ARROW = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("next_fingerprint", pa.binary())])


def simhash(terms: np.ndarray) -> bytes:
    """128 bits from term hashes (with repeats); no terms give zero bits."""
    if not len(terms):
        return bytes(BITS // 8)
    s = np.sort(terms)
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    weight = (1 + np.log(np.diff(np.append(first, len(s))))).astype(np.float32)
    u, votes = s[first], np.zeros(BITS, np.float64)
    for lo in range(0, len(u), 4096):
        part = u[lo : lo + 4096]
        both = np.stack([part, mix(part + U(0x51ED27))], 1)
        bits = np.unpackbits(both.view(np.uint8), axis=1).astype(np.float32)
        w = weight[lo : lo + 4096]
        votes += 2 * (w @ bits) - w.sum()
    return np.packbits(votes > 0).tobytes()


def fingerprints(column, k: int = 3) -> list[bytes]:
    """The fingerprint of each text of an Arrow column."""
    data, off = buffers(column)
    h, doc, _, _ = words(data, off)
    n = len(off) - 1
    g, d = shingles(h, doc, n, k)
    return [simhash(x) for x in by_text(g, d, n)]


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _rows(kind: int, part: int, ids, texts, prints, after=None, after_prints=None) -> pa.RecordBatch:
    """Rows of kind 1 and 2 keep their text; those of kind 0 have what follows from the texts and fingerprints after."""
    n, edits = len(ids), None if after is None else [_edited(x, y) for x, y in zip(texts, after)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * n, pa.int32()),
            pa.array([part] * n, pa.int32()),
            pa.array(ids, pa.int64()),
            pa.nulls(n, pa.string()) if edits else pa.array(texts, pa.string()),
            pa.array(list(map(len, texts)), pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edits], pa.string()) if edits else pa.nulls(n, pa.string()),
            pa.array(prints, pa.binary()),
            pa.array(fingerprints(pa.array(edits, pa.string())), pa.binary()) if edits else pa.nulls(n, pa.binary()),
            pa.array(after_prints, pa.binary()) if edits else pa.nulls(n, pa.binary()),
        ],
        schema=_ARROW,
    )


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order -> a row per document that has a next one here; the first (1) and last (2) with text."""
    part, held = TaskContext.get().partitionId(), None
    for whole in batches:
        for b in slices(whole):
            ids, texts, prints = b.column("doc_id").to_pylist(), [t or "" for t in b.column("text").to_pylist()], fingerprints(b.column("text"))
            if held is None:
                yield _rows(1, part, ids[:1], texts[:1], prints[:1])
            else:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
            if len(ids) > 1:
                yield _rows(0, part, ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
            held = (ids[-1], texts[-1], prints[-1])
    if held is not None:
        yield _rows(2, part, [held[0]], [held[1]], [held[2]])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            yield _rows(0, 0, [r["doc_id"]], [r["text"]], [r["fingerprint"]], [r["next_text"]], [r["next_fp"]])


def _half(column, which: int):
    """A half of a binary fingerprint as a long."""
    return F.conv(F.substring(F.hex(column), 1 + 16 * which, 16), 16, -10).cast("long")


def _apart(a: str, b: str):
    return sum(F.bit_count(_half(F.col(a), i).bitwiseXOR(_half(F.col(b), i))) for i in (0, 1))


def neighbouring(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of docs.

    Order: doc_id descending, nulls last, repeated ids by the text's hash and the text; the last row's next is the
    first, a single row's is itself. The edited text has its last floor(n/2) code points replaced by the first as many
    of the next text, or all of it. A null or empty text has 0 characters, an all-zero fingerprint, and is like any
    other such text by 1. Repeated rows stay; other columns are ignored; an empty table gives an empty table.
    Texts are range-partitioned once; only each range's first and last texts meet afterwards.
    """
    spark = docs.sparkSession
    order = (F.col("doc_id").desc_nulls_last(), F.col("h"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order, F.col("text")).drop("h")
    made = stored(rows.mapInArrow(_along, _FIELDS), f"{shared_dir(spark, 'simhash')}/rows")
    place = Window.orderBy("part")  # over one row per range
    heads = made.where("kind = 1").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fp"))
    numbered = heads.select("part").withColumn("k", F.row_number().over(place)).withColumn("of", F.count("*").over(Window.partitionBy()))
    after = numbered.select("part", F.when(F.col("k") == F.col("of"), 1).otherwise(F.col("k") + 1).alias("k"))
    step = after.join(numbered.select("k", F.col("part").alias("next_part")), "k").select("part", "next_part")
    tails = made.where("kind = 2").select("part", "doc_id", "text", "fingerprint").join(step, "part").join(heads.withColumnRenamed("part", "next_part"), "next_part")
    ends = tails.select("doc_id", "text", "fingerprint", "next_text", "next_fp").repartition(partitions(spark)).mapInArrow(_across, _FIELDS)
    return made.where("kind = 0").union(ends).select(
        "doc_id", "n_chars", "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"), F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        (1 - _apart("fingerprint", "edited_fingerprint") / BITS).alias("near_edited"),
        (1 - _apart("fingerprint", "next_fingerprint") / BITS).alias("near_next"),
    )


def _leads(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits of each of radius + 2 blocks, as two words a block, and the pairs of blocks that lead a table."""
    edge = [round(i * BITS / (radius + 2)) for i in range(radius + 3)]
    bits = [((1 << (b - a)) - 1) << a for a, b in zip(edge[:-1], edge[1:])]
    return np.array([[m >> 64, m & (2**64 - 1)] for m in bits], np.uint64), np.array(list(combinations(range(radius + 2), 2)))


def _lead_keys(h: np.ndarray, masks: np.ndarray, pair: np.ndarray, table: int) -> np.ndarray:
    m = masks[pair[0]] | masks[pair[1]]
    return mix(mix((h[:, 0] & m[0]) + U(table * 0x9E3779B97F4A7C15 % 2**64)) + (h[:, 1] & m[1]))


def _deal(radius: int, parts: int):
    """(fp, n) -> for each part the fingerprints and counts that some table's key deals to it, by table."""
    masks, pairs = _leads(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                b = whole.slice(lo, 4096)
                h = np.frombuffer(b"".join(b.column("fp").to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
                n = b.column("n").to_numpy()
                part = np.stack([(_lead_keys(h, masks, p, t) % U(parts)).astype(np.int32) for t, p in enumerate(pairs)]).reshape(-1)
                order = np.argsort(part, kind="stable")
                edge = np.searchsorted(part[order], np.arange(parts + 1))
                table, row = (order // len(h)).astype(np.uint16), order % len(h)
                out = [(p, table[x:y].tobytes(), h[row[x:y]].tobytes(), n[row[x:y]].tobytes()) for p, (x, y) in enumerate(zip(edge[:-1], edge[1:])) if x < y]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["part", "tables", "prints", "counts"])

    return run


def _near(radius: int, dense: int = 64):
    """What _deal sends to one part -> (fp, more): rows near a fingerprint, each pair in the first table that has it.

    Groups of up to ``dense`` fingerprints are compared by shifts over all groups, larger ones in blocks of rows.
    """
    masks, pairs = _leads(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in b.to_pylist()]
        if not got:
            return
        table = np.concatenate([np.frombuffer(r["tables"], np.uint16) for r in got])
        h = np.concatenate([np.frombuffer(r["prints"], np.uint64).reshape(-1, 2) for r in got])
        n = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in got])
        del got
        key = np.empty(len(h), np.uint64)
        for t in np.unique(table):
            of = np.flatnonzero(table == t)
            key[of] = _lead_keys(h[of], masks, pairs[t], int(t))
        order = np.lexsort((key, table))
        table, h, n, key = table[order], h[order], n[order], key[order]
        start = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (table[1:] != table[:-1]))))
        size = np.diff(np.append(start, len(h)))
        group, more = np.repeat(np.arange(len(start)), size), np.zeros(len(h), np.int64)

        def count(x: np.ndarray, y: np.ndarray) -> None:
            d = h[x] ^ h[y]
            hit = np.bitwise_count(d).sum(1) <= radius
            x, y, d = x[hit], y[hit], d[hit]
            lead = pairs[table[x]]
            agreed, first = np.zeros(len(x), np.int64), np.ones(len(x), bool)
            for b, m in enumerate(masks):
                same = ((d[:, 0] & m[0]) | (d[:, 1] & m[1])) == 0
                agreed += same & (b <= lead[:, 1])
                first &= same | ((lead != b).all(1))
            first &= agreed == 2
            x, y = x[first], y[first]
            np.add.at(more, x, n[y])
            np.add.at(more, y, n[x])

        few = np.flatnonzero((size <= dense)[group])
        for step in range(1, min(dense, int(size.max()))):
            few = few[(few + step < len(h))]
            few = few[group[few] == group[few + step]]
            for lo in range(0, len(few), 1 << 18):
                count(few[lo : lo + (1 << 18)], few[lo : lo + (1 << 18)] + step)
        for g in np.flatnonzero(size > dense):
            rows = np.arange(start[g], start[g] + size[g])
            for i in rows[:-1]:
                for lo in range(i + 1, rows[-1] + 1, 1 << 18):
                    y = np.arange(lo, min(lo + (1 << 18), rows[-1] + 1))
                    count(np.full(len(y), i), y)
        has = np.flatnonzero(more)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in h[has].astype(">u8")], pa.binary()), pa.array(more[has])], ["fp", "more"])

    return run


def with_near_counts(rows: DataFrame, radius: int = 10) -> DataFrame:
    """Adds n_near: how many other rows have a fingerprint within the radius (equal ones included).

    All of them are counted, in tables that lead with two of radius + 2 blocks; no pair leaves a task. radius 10 is the
    distance at which a text of 100 words stands, on average, from its copy with one word changed (3 of 98 terms): short
    texts with more edits are further off and not counted; op1 is the exact join for those. Within a table, fingerprints
    of equal lead are compared pair by pair. A row without fingerprint is left out; repeated rows count each other; other
    columns pass; an empty table stays empty.
    """
    parts = partitions(rows.sparkSession)
    size = rows.where("fingerprint is not null").groupBy("fingerprint").agg(F.count("*").alias("n"))
    dealt = size.select(F.unhex("fingerprint").alias("fp"), "n").mapInArrow(_deal(radius, parts), "part int, tables binary, prints binary, counts binary")
    found = dealt.repartitionById(parts, F.col("part")).mapInArrow(_near(radius), "fp binary, more long")
    near = found.groupBy(F.lower(F.hex("fp")).alias("fingerprint")).agg(F.sum("more").alias("more"))
    count = size.join(near, "fingerprint", "left").select("fingerprint", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_near"))
    count = stored(count, f"{shared_dir(rows.sparkSession, 'simhash')}/counts")  # a plain side: the join can split a frequent fingerprint
    return rows.join(count, "fingerprint")
