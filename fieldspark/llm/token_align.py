"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled whole, so that equal ones meet and are counted; each distinct text is tokenised and aligned once.
Its token pairs count as often as it has copies. Its measures go back to all documents with that text.

Tokenisation works on segments: a text is cut before a space that follows a character that is no white space. No match of
the first tokenizer's pattern and no piece of the second crosses such a place, and both have a token that ends there, so
ids, groups and links of a text are those of its segments, one after another. Segments that came before are remembered.

The pairs of a batch of texts leave a task as one block for each bucket of first ids. A bucket's blocks meet the counts
of its pairs in parts of bounded bytes, so neither a frequent token nor a frequent text makes a large task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import buffers, slices, span_hashes
from .memo import Memo
from .store import remove, shared_dir, stored
from .worker import tidy

_TEXTS = "text_no long, key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCKS = "bucket int, first_no long, codes array<long>, holders array<long>, runs binary, texts binary, times binary"
#: Links of a group beyond which its ids are counted before they are paired.
_LARGE = 1024


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level tokenizer file: ids of texts, bytes of ids. Special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            vocab, of = json.load(f)["model"]["vocab"], byte_of()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(map(of.__getitem__, token))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A SentencePiece model that puts a space before a text: ids of texts that begin with that space, bytes of ids."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = [self.model.piece_to_id("▁")]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """A lone space that follows other text is a piece of its own, which the model doesn't give for an empty text."""
        return [self.space if t == " " else ids for t, ids in zip(texts, self.model.encode([t[1:] for t in texts], num_threads=1))]


def _grown(a: np.ndarray, size: int) -> np.ndarray:
    while size > len(a):
        a = np.resize(a, 2 * len(a))
    return a


class Aligner(Memo):
    """Remembers of each segment its counts, its pairs with the number of their links, and its groups as text.

    A pair's code is first id * (size of the second vocabulary) + second id. What is remembered stays below ``pool``
    pairs and 2**(bits - 1) segments, or one batch's.
    """

    def __init__(self, a, b, bits: int = 20, pool: int = 1 << 22):
        self.a, self.b, self.width, self.most = a, b, len(b.bytes), pool
        if len(a.bytes) * self.width >= 1 << 32:
            raise ValueError("the vocabularies have more than 2**32 pairs of ids")
        size = lambda t: np.array([len(x) for x in t.bytes], np.int64)
        text = lambda t, end: [f"{i}{end}" for i in range(len(t.bytes))]
        self.size_a, self.size_b = size(a), size(b)
        self.more_a, self.last_a, self.more_b, self.last_b = text(a, ","), text(a, "|"), text(b, ","), text(b, ";")
        super().__init__(self._align, bits, lengths_only=True)

    def clear(self) -> None:
        super().clear()
        self.counts = np.zeros((1 << 12, 4), np.int64)  # tokens of both, groups, links; a segment that doesn't come back has -1 links
        self.codes, self.times, self.kept = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0
        self.begin, self.groups = np.zeros(1 << 12, np.int64), []

    def find(self, *args) -> np.ndarray:
        if self.kept > self.most:
            self.clear()
        return super().find(*args)

    def _align(self, segments: list[str]) -> np.ndarray:
        ids_a, ids_b = self.a.encode(segments), self.b.encode(segments)
        joined = lambda t, ids: b"".join([t.bytes[i] for x in ids for i in x])
        bad, raw = [], "".join(segments).encode()
        if joined(self.a, ids_a) != raw or joined(self.b, ids_b) != raw:
            bad = [i for i, s in enumerate(segments) if not joined(self.a, ids_a[i : i + 1]) == s.encode() == joined(self.b, ids_b[i : i + 1])]
            for i in bad:
                ids_a[i], ids_b[i] = [], []
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (ids_a, ids_b))
        a, b = (np.fromiter((i for x in ids for i in x), np.int64, n.sum()) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        in_a, in_b = np.bincount(of_a, minlength=len(ends)), np.bincount(of_b, minlength=len(ends))
        of_group = np.repeat(np.arange(len(segments)), n_a)[np.cumsum(in_a) - 1] if len(ends) else np.zeros(0, np.int64)
        links = in_a * in_b
        codes, times, owner = self._pairs(a, b, of_a, in_a, in_b, of_group, links)
        n = np.bincount(owner, minlength=len(segments))
        self._keep(codes, times, n)
        k = self.size
        self.counts = _grown(self.counts.reshape(-1), 4 * (k + len(n))).reshape(-1, 4)
        links = np.bincount(of_group, links, len(segments)) if links.sum() < 1 << 52 else self._exact(of_group, links, len(segments))
        links[bad] = -1
        self.counts[k : k + len(n)] = np.stack([n_a, n_b, np.bincount(of_group, minlength=len(segments)), links], 1)
        last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
        words = [(self.last_a if z else self.more_a)[i] for i, z in zip(a.tolist(), last_a.tolist())] if len(a) else []
        words += [(self.last_b if z else self.more_b)[i] for i, z in zip(b.tolist(), last_b.tolist())] if len(b) else []
        order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
        words, cut = list(map(words.__getitem__, order.tolist())), np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
        self.groups += ["".join(words[x:y]) for x, y in zip(cut, cut[1:])]
        return n

    @staticmethod
    def _exact(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        np.add.at(out, of, values)
        return out

    def _pairs(self, a, b, of_a, in_a, in_b, of_group, links) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code, links, segment) of the pairs of all groups. Those of a large group are counted by id first."""
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        large = np.flatnonzero(links > _LARGE)
        wide = np.where(links > _LARGE, 0, in_b)[of_a] if len(of_a) else of_a
        at_b = np.repeat(first_b[of_a] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
        codes, owner = [np.repeat(a, wide) * self.width + b[at_b]], [np.repeat(of_group[of_a], wide)]
        times = [np.ones(len(at_b), np.int64)]
        for g in large.tolist():
            (x, nx), (y, ny) = (np.unique(t[f[g] : f[g] + n[g]], return_counts=True) for t, f, n in ((a, first_a, in_a), (b, first_b, in_b)))
            codes.append((x[:, None] * self.width + y[None, :]).reshape(-1))
            times.append((nx[:, None] * ny[None, :]).reshape(-1))
            owner.append(np.full(len(codes[-1]), of_group[g]))
        codes, times, owner = (np.concatenate(v) for v in (codes, times, owner))
        if len(large):
            order = np.argsort(owner, kind="stable")
            codes, times, owner = codes[order], times[order], owner[order]
        return codes, times, owner

    def _keep(self, codes: np.ndarray, times: np.ndarray, n: np.ndarray) -> None:
        k, total = self.size, self.kept + len(codes)
        self.codes, self.times, self.begin = _grown(self.codes, total), _grown(self.times, total), _grown(self.begin, k + len(n))
        self.codes[self.kept : total], self.times[self.kept : total] = codes, times
        self.begin[k : k + len(n)] = self.kept + np.cumsum(n) - n
        self.kept = total

    def pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes, links) of the segments' pairs, one segment after another, and how many each has."""
        n = self.n[at].astype(np.int64)
        where = np.repeat(self.begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.codes[where], self.times[where], n


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, end) of the segments of texts that are not empty."""
    here = np.flatnonzero(data == 0x20)
    here = here[here >= 3]
    before, second, third = data[here - 1], data[here - 2], data[here - 3]
    # White space outside ASCII: U+0085, U+00A0, and blocks of three bytes that hold some.
    odd = (second == 0xC2) | (third == 0xE1) & (second == 0x9A) | (third == 0xE2) & ((second == 0x80) | (second == 0x81)) | (third == 0xE3) & (second == 0x80)
    cut = np.zeros(len(data), bool)
    cut[here[(before > 0x20) & ((before < 0x80) | ~odd)]] = True
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    s = np.flatnonzero(cut)
    return np.searchsorted(offsets, s, side="right") - 1, s, np.append(s[1:], len(data))


def _blocks(aligner: Aligner, doc: np.ndarray, at: np.ndarray, good: np.ndarray, copies: np.ndarray, first: int, buckets: int) -> Iterator[dict]:
    """A block for each bucket of first ids that the texts have: its pairs, the copies of their texts, and the texts of each with their links."""
    seen, times = np.unique(doc[good].astype(np.int64) << 32 | at[good], return_counts=True)
    codes, links, n = aligner.pairs(seen & 0xFFFFFFFF)
    text, links = np.repeat(seen >> 32, n), links * np.repeat(times, n)
    bucket = (codes // np.uint32(aligner.width)) % np.uint32(buckets)
    order = np.lexsort((text, codes, bucket))
    codes, text, links, bucket = codes[order], text[order], links[order], bucket[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
    place = np.flatnonzero(new)
    links = np.add.reduceat(links, place) if len(place) else links
    codes, text, bucket = codes[place], text[place], bucket[place]
    edge = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    holders = np.add.reduceat(copies[text], edge) if len(edge) else edge
    runs = np.diff(np.append(edge, len(codes)))
    for k in np.unique(bucket).tolist():
        lo, hi = np.searchsorted(bucket, [k, k + 1])
        x, y = np.searchsorted(edge, [lo, hi])
        kind = np.uint8 if links[lo:hi].max() < 256 else np.int64
        yield {"bucket": k, "first_no": first, "codes": codes[edge[x:y]].astype(np.int64), "holders": holders[x:y], "runs": runs[x:y].astype(np.uint16).tobytes(), "texts": text[lo:hi].astype(np.uint16).tobytes(), "times": links[lo:hi].astype(kind).tobytes()}


@lru_cache(1)
def _loaded(path_a: str, path_b: str) -> Aligner:
    return Aligner(ByteLevel(path_a), Pieces(path_b))


_OUT = pa.schema([
    ("text_no", pa.int64()), ("key", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("bucket", pa.int32()), ("first_no", pa.int64()), ("codes", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64())), ("runs", pa.binary()), ("texts", pa.binary()), ("times", pa.binary()),
])


def _filled(columns: dict, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _OUT], schema=_OUT)


def _aligned(path_a: str, path_b: str, buckets: int, batch_bytes: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _loaded(path_a, path_b)
        for whole in batches:
            for many in slices(whole, size=batch_bytes):
                for lo in range(0, many.num_rows, 60_000):
                    b = many.slice(lo, 60_000)
                    n, no, copies = b.num_rows, b.column("text_no").to_numpy(), b.column("copies").to_numpy()
                    data, off = buffers(pc.binary_join_element_wise(" ", b.column("text"), ""))
                    doc, s, e = cuts(data, off)
                    h, g = span_hashes(data, s, e, 0, len(data), second=True)
                    at = aligner.find(data, h, g, s, e)
                    counts = aligner.counts[at]
                    bad = np.zeros(n, bool)
                    bad[doc[counts[:, 3] < 0]] = True
                    sums = np.add.reduceat(counts, np.searchsorted(doc, np.arange(n)), axis=0)
                    sums[bad] = 0
                    edge, names = np.searchsorted(doc, np.arange(n + 1)).tolist(), at.tolist()
                    sha = ["" if bad[i] else hashlib.sha256("".join(map(aligner.groups.__getitem__, names[edge[i] : edge[i + 1]]))[:-1].encode()).hexdigest() for i in range(n)]
                    yield _filled({"text_no": no, "key": b.column("key"), "copies": copies, "n_a": sums[:, 0], "n_b": sums[:, 1], "n_groups": sums[:, 2], "n_links": sums[:, 3], "groups_sha256": sha}, n)
                    if not bad.all():
                        rows = list(_blocks(aligner, doc, at, ~bad[doc], copies, int(no[0]), buckets))
                        yield _filled({k: [r[k] for r in rows] for k in rows[0]}, len(rows))

    return run


def _weighed(width: int):
    """A bucket's blocks and the counts of its pairs -> (text_no, n_best, count_sum), a row for each text of a block."""

    def run(blocks: pa.Table, counts: pa.Table) -> pa.Table:
        no, best, total = [], [], []
        if blocks.num_rows:
            code, n = counts.column("code").to_numpy(), counts.column("n").to_numpy()
            order = np.argsort(code)
            code, n = code[order], n[order]
            own = code // width
            edge = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            top = np.repeat(np.maximum.reduceat(n, edge), np.diff(np.append(edge, len(n))))
            for b in blocks.to_batches():
                for i in range(b.num_rows):
                    at = np.searchsorted(code, b.column("codes")[i].values.to_numpy())
                    runs, text = (np.frombuffer(b.column(c)[i].as_py(), np.uint16).astype(np.int64) for c in ("runs", "texts"))
                    raw = b.column("times")[i].as_py()
                    links = np.frombuffer(raw, np.uint8 if len(raw) == len(text) else np.int64).astype(np.int64)
                    at = np.repeat(at, runs)
                    sums = np.zeros((2, text.max() + 1), np.int64)
                    np.add.at(sums[0], text, links * (n[at] == top[at]))
                    np.add.at(sums[1], text, links * n[at])
                    has = np.flatnonzero(sums[1])
                    no.append(has + b.column("first_no")[i].as_py())
                    best.append(sums[0][has])
                    total.append(sums[1][has])
        flat = lambda x: pa.array(np.concatenate(x) if x else [], pa.int64())
        return pa.table({"text_no": flat(no), "n_best": flat(best), "count_sum": flat(total)})

    return run


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(code, bucket, n): how many documents hold each pair linked, copies included. Tasks add up what they have before they send it."""
    flat = blocks.select("bucket", F.inline(F.arrays_zip("codes", "holders")))
    return flat.groupBy(F.col("codes").alias("code"), "bucket").agg(F.sum("holders").alias("n"))


def align(docs: DataFrame, path_a: str, path_b: str, buckets: int = 64, batch_bytes: int = 4 << 20, part_bytes: int = 16 << 20) -> tuple[DataFrame, DataFrame]:
    """(texts, counts) of docs (doc_id, text) for a byte-level tokenizer file and a SentencePiece model.

    texts has a row per distinct text that is neither null nor empty: key (its SHA-256), copies, n_a, n_b, n_groups,
    n_links, groups_sha256, n_best, count_sum. A text whose tokens of either kind don't give back a space and the text has
    zeros and '', and its pairs count nowhere. counts has (a, b, n): in how many documents the pair of ids is linked; a row
    of docs is a document, whether its id is null or repeated. Empty tables give empty tables. Other columns are ignored.

    buckets: of first ids; part_bytes: about how much of a bucket's blocks meets its counts in one task. Neither changes
    results. The paths must be readable on every executor.
    """
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "align")
    width = len(Pieces(path_b).bytes)
    texts = docs.select(F.col("text").cast("string")).where("length(text) > 0").groupBy("text").agg(F.count("*").alias("copies"))
    each = texts.select(F.monotonically_increasing_id().alias("text_no"), _key().alias("key"), "copies", "text")
    schema = f"{_TEXTS}, {_BLOCKS}"
    kept = stored(each.mapInArrow(_aligned(path_a, path_b, buckets, batch_bytes), schema), f"{folder}/aligned")
    blocks = kept.where("bucket is not null").select(*(c.split()[0] for c in _BLOCKS.split(", ")))
    counts = stored(pair_counts(blocks), f"{folder}/counts")
    size = F.length("texts") + F.length("times") + 8 * F.size("codes")
    parts = stored(blocks.groupBy("bucket").agg(F.ceil(F.sum(size) / part_bytes).cast("int").alias("parts")), f"{folder}/parts")
    some = blocks.join(F.broadcast(parts), "bucket").withColumn("part", F.pmod(F.xxhash64("first_no"), "parts").cast("int"))  # a row per bucket
    every = counts.join(F.broadcast(parts), "bucket").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = some.drop("holders", "parts").groupBy("bucket", "part").cogroup(every.drop("parts").groupBy("bucket", "part"))
    found = both.applyInArrow(_weighed(width), "text_no long, n_best long, count_sum long").groupBy("text_no").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = kept.where("text_no is not null").select(*(c.split()[0] for c in _TEXTS.split(", ")))
    whole = stored(own.join(found, "text_no", "left").drop("text_no").fillna(0, ["n_best", "count_sum"]), f"{folder}/texts")
    remove(spark, f"{folder}/aligned", f"{folder}/parts")
    return whole, counts.select((F.col("code") / width).cast("long").alias("a"), (F.col("code") % width).alias("b"), "n")


def _key():
    return F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))


def alignment(docs: DataFrame, path_a: str, path_b: str, **how) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of docs, see align().

    A null or empty text, or one whose tokens don't give it back, has zeros and ''. Null and repeated doc_ids and repeated
    rows are kept; other columns are ignored; an empty table stays empty. Texts are matched by SHA-256.
    """
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    texts = align(docs, path_a, path_b, **how)[0].select("key", *numbers, "groups_sha256")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).select("doc_id", _key().alias("key"))
    return rows.join(texts, "key", "left").select("doc_id", *numbers, "groups_sha256").fillna(0, numbers).fillna("", ["groups_sha256"])
