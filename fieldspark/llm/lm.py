"""Interpolated modified Kneser-Ney model of any order from two on: counted in Spark, kept as sorted hash arrays, scored by shards.

Words are 64-bit hashes throughout; there is no table of the vocabulary. An n-gram belongs to the shard of its context's
last word, where all longer contexts that end in that word lie too: counts, context totals and back-off weights of all
orders from two up are sums within one shard. The few words that hold more than a shard's share are hot: their n-grams
are spread by the word before (order two: by the word after), and what only the sum over shards can tell, which is the
bigrams after hot words and the unigrams, is summed in a second sharding by the predicted word and sent back.

Each shard writes one file below the shared folder and maps it in memory to score: its words as sorted hashes, its
contexts as a trie from the last word to the first, the words that follow each, and their counts. Lookups bisect the
mapping between stored offsets; a task holds nothing that grows with its shard. What the second sharding answers is a
file of counts alone, in the order of the shard's words. The second sharding has files of its own, for what a shard has
never seen. Texts are read for the frequent words, for each turn of shards and for each round of scores; n-grams are summed per task before they are shuffled; of equal texts held at a
time one is scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import U, buffers, mix, slices, words
from .store import map_array, partitions, remove, shared_dir, stored, write_file
from .worker import tidy

END, START = U(0x5E9D0E9D0E9D0E9D), U(0x57A2757A2757A275)  # stand for the end of a text and for what is before it
FLUSH = 4 << 20  # tokens held by a task before their n-grams are sent on
_ROW = "kind int, part int, a long, b long, c binary, d binary"
_ARROW = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.binary()), ("d", pa.binary())])
_DOC = np.dtype([("doc", "i8"), ("null", "u1"), ("held", "u1"), ("text", "i4"), ("n", "i8"), ("known", "i8"), ("base", "f8"), ("score", "f8")])
GRAMS, LOWER, STATS, ANSWER, DOCS, SUMS = range(6)
HELD = 1 << 20  # sums and questions held by a task before they are sent on
BLOCK = 64  # contexts whose offsets count from one base
LONG = 32  # contexts with more followers have their sums stored


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)] if rows else [pa.array([], t) for t in _ARROW.types], schema=_ARROW)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 7; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


# --- arrays as bytes --------------------------------------------------------------------------------------------------


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """int64 and uint64 arrays in byte planes, compressed together: of sorted hashes and small numbers whole planes vanish."""
    out = [np.array([len(arrays), *((-len(a) - 1) if a.dtype == np.uint64 else len(a) for a in arrays)], "<i8").tobytes()]
    out += [np.ascontiguousarray(a.astype(a.dtype if a.dtype == np.uint64 else "<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return zstd.ZstdCompressor(level=1).compress(b"".join(out))


def unpack_arrays(raw: bytes) -> list[np.ndarray]:
    raw = zstd.ZstdDecompressor().decompress(raw)
    count = int(np.frombuffer(raw, "<i8", 1)[0])
    at, out = 8 * (count + 1), []
    for n in np.frombuffer(raw, "<i8", count, 8).tolist():
        size, kind = (n, "<i8") if n >= 0 else (-n - 1, "<u8")
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * size, at).reshape(8, -1).T).view(kind).reshape(-1))
        at += 8 * size
    return out


def save_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: sorted hashes (uint64) and places (uint32) as they are, counts (int64) as a byte each where they are below 255."""
    parts = {}
    for name, a in arrays.items():
        if a.dtype == np.int64:
            big = np.flatnonzero(a >= 255)
            parts |= {name: np.minimum(a, 255).astype(np.uint8), name + "@": big.astype("<i8"), name + "=": a[big].astype("<i8")}
        else:
            parts[name] = a
    head = ";".join(f"{n},{a.dtype.str},{len(a)}" for n, a in parts.items()).encode()
    head += b" " * (-(len(head) + 8) % 8)
    body = [np.array([len(head)], "<i8").tobytes(), head]
    for a in parts.values():
        body += [a.tobytes(), b"\0" * (-a.nbytes % 8)]
    write_file(path, b"".join(body))


class Arrays:
    """What save_arrays wrote, mapped in memory."""

    def __init__(self, path: str):
        raw = map_array(path, np.uint8)
        size = int(raw[:8].view("<i8")[0])
        at, self.parts = 8 + size, {}
        for part in bytes(raw[8:at]).decode().strip().split(";"):
            name, kind, n = part.split(",")
            a = raw[at : at + int(n) * np.dtype(kind).itemsize].view(kind)
            self.parts[name] = a
            at += a.nbytes + -a.nbytes % 8

    def __getitem__(self, name: str) -> np.ndarray:
        a = self.parts[name]
        if name + "@" not in self.parts:
            return a
        a = a.astype(np.int64)
        a[self.parts[name + "@"]] = self.parts[name + "="]
        return a

    def at(self, name: str, places: np.ndarray) -> np.ndarray:
        """The counts at these places."""
        out = self.parts[name][places].astype(np.int64)
        full = np.flatnonzero(out == 255)
        if len(full):
            out[full] = self.parts[name + "="][np.searchsorted(self.parts[name + "@"], places[full])]
        return out

    def span(self, name: str, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) of the runs of these groups, as offsets() keeps them."""
        base, rel = self.parts[name + "^"], self.parts[name + "+"]
        return tuple(base[i // BLOCK].astype(np.int64) + rel[i] for i in (group, group + 1))

    def find(self, name: str, group: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the array, whether it is there) of each asked value within the sorted run of its group."""
        keys, (low, end) = self.parts[name], self.span(name, group)
        open_ = np.flatnonzero(low < end)
        a, b, what = low[open_], end[open_], asked[open_].astype(keys.dtype)
        while len(open_):
            mid = (a + b) >> 1
            less = keys[mid] < what
            a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            wide = a < b
            low[open_[~wide]] = a[~wide]
            open_, a, b, what = open_[wide], a[wide], b[wide], what[wide]
        here = low < end
        here[here] = keys[low[here]] == asked[here]
        return low, here


def offsets(name: str, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Where the runs of consecutive groups begin and the last one ends: a base for each block and what is beyond it, in few bytes."""
    at = np.concatenate(([0], np.cumsum(sizes)))
    base = at[::BLOCK]
    rel = at - np.repeat(base, BLOCK)[: len(at)]
    return {name + "^": base.astype("<u4" if at[-1] < 1 << 32 else "<u8"), name + "+": rel.astype(np.min_scalar_type(int(rel.max())))}


def place(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted keys, whether it is there) of each asked value."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


# --- n-grams ----------------------------------------------------------------------------------------------------------


def key_of(columns) -> np.ndarray:
    """A hash of a run of words, given as columns."""
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        h = mix(h * U(0x9E3779B97F4A7C15) + c)
    return h


def _tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hashes with an end token after each text, tokens per text)."""
    h, doc, _, _ = words(*buffers(b.column("text")))
    n = np.bincount(doc, minlength=b.num_rows)
    out = np.full(len(h) + b.num_rows, END, np.uint64)
    out[np.arange(len(h)) + doc] = h
    return out, n + 1


def _windows(t: np.ndarray, n: np.ndarray, order: int, start) -> list[np.ndarray]:
    """For each token the ``order`` tokens that end in it, as columns; before a text stand starts."""
    place_in, out = np.arange(len(t)) - np.repeat(np.cumsum(n) - n, n), []
    for back in range(order - 1, 0, -1):
        c = np.empty_like(t)
        c[back:] = t[:-back]
        c[place_in < back] = start
        out.append(c)
    return [*out, t]


def _numbered(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the sorted different words of t, the start behind them; the place of each of t)"""
    places, u = pd.factorize(t)
    order = np.argsort(u)
    rank = np.empty(len(u), np.int64)
    rank[order] = np.arange(len(u))
    return np.append(u[order], START), rank[places]


def _shard(u: np.ndarray, w: list[np.ndarray], hot: np.ndarray, shards: int) -> np.ndarray:
    """By the context's last word; if that is hot, with the word before it, or after it in bigrams. w: places in u."""
    to = (mix(u) % U(shards)).astype(np.int64)[w[-2]]
    spread = np.flatnonzero(place(hot, u)[1][w[-2]])
    other = w[-3] if len(w) > 2 else w[-1]
    to[spread] = mix(mix(u[w[-2][spread]] + mix(u[other[spread]]))) % U(shards)
    return to


def _parts(shards: int) -> int:
    """Parts of the second sharding: a quarter, as it holds words and few bigrams where the shards hold all n-grams."""
    return -(-shards // 4)


def _second(w: np.ndarray, shards: int) -> np.ndarray:
    return (mix(w + U(0x2D)) % U(_parts(shards))).astype(np.int64)


def _deal(to: np.ndarray, shards: int):
    """(shard, rows) of each shard that has some; rows keep their order."""
    order = np.argsort(to.astype(np.uint16) if shards < 65536 else to, kind="stable")
    edge = np.searchsorted(to[order], np.arange(shards + 1))
    return [(p, order[i:j]) for p, (i, j) in enumerate(zip(edge[:-1], edge[1:])) if i < j]


def _coded(u: np.ndarray, w: list[np.ndarray], to: np.ndarray, shards: int):
    """(shard, rows, [its dictionary of words, columns of places in it]) of each shard that has n-grams of w, which are places in u."""
    for p, rows in _deal(to, shards):
        own, mark = [x[rows] for x in w], np.zeros(len(u), bool)
        for x in own:
            mark[x] = True
        new = np.cumsum(mark) - 1
        yield p, rows, [u[mark], *(new[x] for x in own)]


def _order(columns: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(an order that sorts rows of places below the sizes, where in it rows begin that differ from the one before)"""
    if math.prod(sizes) < 1 << 64:
        key = _key(columns, sizes)
        by = np.argsort(key)
        return by, _runs(key[by])
    by = np.lexsort(columns[::-1])
    return by, _changes([c[by] for c in columns])


def _key(columns: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    key = np.zeros(len(columns[0]), np.uint64)
    for c, size in zip(columns, sizes):
        key = key * U(size) + c.astype(np.uint64)
    return key


def _distinct(columns: list[np.ndarray], sizes: list[int], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """(sorted different rows of places below the sizes, the sum of the counts of each, or how many there were)"""
    if counts is None and math.prod(sizes) < 1 << 64:  # nothing else has to follow the keys, from which the columns can be had again
        key = np.sort(_key(columns, sizes))
        first, out = _runs(key), []
        left = key[first]
        for size in sizes[::-1]:
            left, full = left // U(size), left
            out.append((full - left * U(size)).astype(np.int64))
        return out[::-1], np.diff(first, append=len(key))
    by, first = _order(columns, sizes)
    n = np.diff(first, append=len(by)) if counts is None else np.add.reduceat(counts[by], first) if len(first) else counts[:0]
    by = by[first]
    return [c[by] for c in columns], n


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where rows begin that differ from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if len(sorted_keys) else np.zeros(0, np.int64)


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted different keys, a row of each, its sum)"""
    order = np.argsort(keys, kind="stable")
    first = _runs(keys[order])
    return keys[order][first], order[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, 5), minlength=6)[1:5].tolist()


# --- fit --------------------------------------------------------------------------------------------------------------


def _frequent(most: int):
    """The most frequent words of each flush with their counts; all tokens under a null word."""

    @tidy
    def run(batches):
        held, size = [], 0

        def flush():
            u, n = np.unique(np.concatenate(held), return_counts=True)
            top = np.argsort(-n, kind="stable")[:most]
            return pa.RecordBatch.from_arrays([pa.array([None, *u[top].view(np.int64).tolist()], pa.int64()), pa.array([int(n.sum()), *n[top].tolist()], pa.int64())], ["h", "c"])

        for whole in batches:
            for b in slices(whole):
                held.append(_tokens(b)[0])
                size += len(held[-1])
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _count(order: int, hot: np.ndarray, shards: int, rounds: int, turn: int):
    """Texts -> the n-grams of each flush with their counts, for the shards whose turn it is."""

    @tidy
    def run(batches):
        held, size = [], 0

        def flush():
            u, t = _numbered(np.concatenate([x for x, _ in held]))
            w = _windows(t, np.concatenate([x for _, x in held]), order, len(u) - 1)
            if rounds > 1:
                own = _shard(u, w, hot, shards) % rounds == turn
                w = [x[own] for x in w]
            *far, v, last = w
            (v, last, *far), n = _distinct([v, last, *far], [len(u)] * order)
            w = [*far, v, last]
            return _batch([(GRAMS, p // rounds, 0, 0, pack_arrays(n[rows], *coded), None) for p, rows, coded in _coded(u, w, _shard(u, w, hot, shards), shards)])

        for whole in batches:
            for b in slices(whole):
                held.append(_tokens(b))
                size += len(held[-1][0])
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


class Words:
    """The words of a shard by place; a start has the place behind them, other words none."""

    def __init__(self, known: np.ndarray):
        self.known, self.size = known, len(known) + 1

    def place(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, here = place(self.known, w)
        start = w == START
        return np.where(start, len(self.known), at), here | start


def _sums(count: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Of each run: the sum, and how many are 1, 2 and more."""
    return [np.add.reduceat(x.astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for x in (count, count == 1, count == 2, count > 2)]


def _long(k: int, sizes: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    """The contexts with more than LONG followers and their sums."""
    number = np.flatnonzero(sizes > LONG)
    own = np.repeat(sizes > LONG, sizes)
    sums = _sums(count[own], np.cumsum(sizes[number]) - sizes[number])
    return {f"long{k}": number.astype("<u4" if len(sizes) < 1 << 32 else "<u8"), **{f"long{k}.{i}": x for i, x in enumerate(sums)}}


def _build(folder: str, order: int, hot: np.ndarray, shards: int, rounds: int, turn: int):
    """The n-grams of one shard -> its file; what the second sharding sums goes on in rows, as do counts of counts."""

    @tidy
    def run(batches):
        part, blocks = TaskContext.get().partitionId() * rounds + turn, []
        if part >= shards:
            return
        for b in batches:
            for r in b.to_pylist():
                n, u, *places = unpack_arrays(r["c"])
                blocks.append((u, n, places))
        every = np.unique(np.concatenate([START[None], *(u for u, _, _ in blocks)]))
        n = np.concatenate([np.zeros(0, np.int64), *(n for _, n, _ in blocks)])
        *far, v, last = [np.zeros(0, np.int64)] * order
        if blocks:
            new = [np.searchsorted(every, u) for u, _, _ in blocks]
            *far, v, last = [np.concatenate([g[x[i]] for g, (_, _, x) in zip(new, blocks)]) for i in range(order)]
        del blocks

        # places in the file: words first, the start behind them; last words of contexts, hot ones behind them
        here = np.zeros(len(every), bool)
        for x in (*far, last):
            here[x] = True
        here[np.searchsorted(every, START)] = False
        known, number = every[here], np.cumsum(here) - 1
        number[np.searchsorted(every, START)], size = len(known), len(known) + 1
        if size >= 1 << 32:
            raise ValueError("a shard has too many words: raise spark.sql.shuffle.partitions")
        at, is_hot = place(hot, every)
        here = np.zeros(len(every), bool)
        here[v] = True
        here &= ~is_hot
        second = every[here]
        of = np.where(is_hot, len(second) + at, np.cumsum(here) - 1)
        several = len(second) + len(hot)

        columns, counts = _distinct([of[v], *(number[x] for x in far[::-1]), number[last]], [several, *[size] * (order - 1)], n)
        total = np.bincount(columns[0], counts, several).astype(np.int64)  # each word but the last of a text is a context's last word once
        end, has_end = place(known, END[None])
        stats = [("tokens", 0, int(counts.sum())), ("texts", 0, int(counts[columns[-1] == end[0]].sum()) if has_end[0] else 0)]
        stats += [("uses", int(i), int(total[len(second) + i])) for i in np.flatnonzero(total[len(second) :])]
        files = {"words": known, "context2": second, "uses": total[: len(second)]}
        for k in range(order, 1, -1):
            if k < order:  # counts of the lower orders: how many different words stand before
                columns, counts = _distinct([*columns[: k - 1], columns[-1]], [several, *[size] * (k - 1)])
            own = np.ones(len(counts), bool)
            if k > 2:
                first = _changes(columns[:-1])
                shorter = columns[0][first]
                if k > 3:
                    run = _changes([c[first] for c in columns[:-2]])
                    shorter = np.repeat(np.arange(len(run)), np.diff(run, append=len(first)))
                files |= {f"first{k}": columns[-2][first].astype("<u4"), **offsets(f"first{k}", np.bincount(shorter, minlength=several if k == 3 else 0))}
                followers = np.diff(first, append=len(counts))
            else:
                own = columns[0] < len(second)
                followers = np.bincount(columns[0][own], minlength=len(second))
            stats += [("order", 4 * k + i, c) for i, c in enumerate(_of_counts(counts[own]))]
            files |= {f"word{k}": columns[-1][own].astype("<u4"), f"count{k}": counts[own], **offsets(f"word{k}", followers), **_long(k, followers, counts[own])}
        many = np.bincount(columns[1][own], minlength=len(known))
        pair_v, pair, pair_n = columns[0][~own] - len(second), columns[1][~own], counts[~own]
        save_arrays(f"{folder}/shard-{part}", files | {"pair": pair.astype("<u4"), **offsets("pair", np.bincount(pair_v, minlength=len(hot)))})
        pairs, row = dict(_deal(_second(known[pair], shards), _parts(shards))), np.zeros(len(known), np.int64)
        for p, rows in _deal(_second(known, shards), _parts(shards)):
            x, row[rows] = pairs.get(p, np.zeros(0, np.int64)), np.arange(len(rows))
            yield _batch([(LOWER, p, part, 0, pack_arrays(known[rows], many[rows], pair_v[x], row[pair[x]], pair_n[x]), None)])
        yield _batch([(STATS, part, i, c, name.encode(), None) for name, i, c in stats])

    return run


def _pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return key_of([v.astype(np.uint64), w])


def _sum_lower(folder: str, shards: int):
    """What the shards say of the words of one part of the second sharding -> its file, answers to the shards, counts of counts."""

    @tidy
    def run(batches):
        part, got = TaskContext.get().partitionId(), []
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == LOWER:
                    got.append((r["a"], unpack_arrays(r["c"])))
                else:
                    yield _batch([tuple(r.values())])
        if not got:
            got = [(0, [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4])]
        got.sort(key=lambda x: x[0])
        pair_v, pair_w, pair_n = (np.concatenate(x) for x in zip(*((v, w[i], n) for _, (w, _, v, i, n) in got)))
        key, row, total = _sum(_pair_key(pair_v, pair_w), pair_n)
        word, _, before = _sum(np.concatenate([*(x[0] for _, x in got), pair_w[row]]), np.concatenate([*(x[1] for _, x in got), np.ones(len(row), np.int64)]))
        save_arrays(f"{folder}/second-{part}", {"words": word, "before": before, "pairs": key, "count": total})
        stats = [("words", 0, len(word)), ("before", 0, int(before.sum())), *(("order", 4 + i, c) for i, c in enumerate(_of_counts(before))), *(("order", 8 + i, c) for i, c in enumerate(_of_counts(total)))]
        v = pair_v[row]
        for name, what in (("total", total), ("once", total == 1), ("twice", total == 2), ("more", total > 2)):
            s = np.bincount(v, what).astype(np.int64) if len(v) else np.zeros(0, np.int64)
            stats += [(name, int(i), int(s[i])) for i in np.flatnonzero(s)]
        yield _batch([(STATS, part, i, int(c), name.encode(), None) for name, i, c in stats])
        for to, (w, _, v, i, _) in got:
            k = _pair_key(v, w[i])
            yield _batch([(ANSWER, to, part, 0, pack_arrays(before[np.searchsorted(word, w)], total[np.searchsorted(key, k)]), None)])

    return run


def _save_lower(folder: str, shards: int):
    """Answers to one shard, each in the order it was asked in -> its second file: how many words stand before each of its
    words, and the counts of its bigrams after hot words."""

    @tidy
    def run(batches):
        part, got = TaskContext.get().partitionId(), {}
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == ANSWER:
                    got[r["a"]] = unpack_arrays(r["c"])
                else:
                    yield _batch([tuple(r.values())])
        if not got:
            save_arrays(f"{folder}/lower-{part}", {"before": np.zeros(0, np.int64), "paired": np.zeros(0, np.int64)})
            return
        asked = Arrays(f"{folder}/shard-{part}")
        words, pair = asked["words"], asked["pair"]
        before, paired = np.zeros(len(words), np.int64), np.zeros(len(pair), np.int64)
        pairs = dict(_deal(_second(words[pair], shards), _parts(shards)))
        for p, rows in _deal(_second(words, shards), _parts(shards)):
            before[rows], x = got[p]
            if p in pairs:
                paired[pairs[p]] = x
        save_arrays(f"{folder}/lower-{part}", {"before": before, "paired": paired})

    return run


def discounts(n) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more, from the counts of counts 1 to 4.

    Where a count of counts is missing, as in tiny corpora, the published fallback 0.5, 1, 1.5 is taken for all.
    """
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, 0.5, 1.0, 1.5]) if min(d) < 0 or d[0] > 1 or d[1] > 2 or d[2] > 3 else np.array([0, *d])


class Model:
    """Constants, the totals of hot words, and where the files are. Small: goes to the tasks as a broadcast."""

    folder: str
    order: int
    shards: int
    hot: np.ndarray  # sorted hashes, the start among them
    tokens: int  # N
    size: int  # V
    texts: int  # occurrences of the end token
    discount: dict[int, np.ndarray]  # by order
    hot_uses: np.ndarray
    hot_total: np.ndarray  # of bigrams after a hot word
    hot_gamma: np.ndarray
    before: int  # different bigrams
    free: float  # probability of a word that stands after nothing

    def cut(self, k: int, c: np.ndarray) -> np.ndarray:
        """Counts less their discounts."""
        return np.maximum(c - self.discount[k][np.minimum(c, 3)], 0)

    def unigram(self, before: np.ndarray) -> np.ndarray:
        return self.cut(1, before) / max(1, self.before) + self.free

    def after_hot(self, v: np.ndarray, count: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """Bigram probabilities after hot words (by number)."""
        return self.cut(2, count) / np.maximum(1, self.hot_total[v]) + self.hot_gamma[v] * unigram


def fit(docs: DataFrame, order: int = 3, hot_share: float | None = None, rounds: int = 2) -> Model:
    """The model of all texts of docs (doc_id, text); null texts count as empty: one end token. Repeated rows count again.

    order: 2 or more. hot_share: words of a larger share of the tokens are spread over shards (none: one part in
    spark.sql.shuffle.partitions); it moves data and changes no probability. The totals of hot words come to the driver:
    at most 1/hot_share. rounds: the shards are built in so many turns, for each of which the texts are read, so that no more
    than a turn's n-grams are on the disks at a time; it changes no result. An empty table gives a model of no words, which scores every token by the free probability.
    """
    if order < 2:
        raise ValueError("the order must be 2 or more")
    spark, m = docs.sparkSession, Model()
    m.folder, m.order, m.shards = shared_dir(spark, "lm"), order, partitions(spark)
    text = docs.select(F.col("text").cast("string"))
    share = 1 / m.shards if hot_share is None else hot_share
    seen = text.mapInArrow(_frequent(max(256, 2 * m.shards)), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    seen = stored(seen, f"{m.folder}/frequent")
    every = seen.where("h is null").select("c").first()
    top = seen.where(F.col("h").isNotNull() & (F.col("c") > share * (every["c"] if every else 0))).select("h").collect()
    m.hot = np.unique(np.array([*(np.uint64(r["h"] % 2**64) for r in top), START], np.uint64))

    rounds, built = min(rounds, m.shards), []
    for turn in range(rounds):
        grams = text.mapInArrow(_count(order, m.hot, m.shards, rounds, turn), _ROW).repartitionById(-(-m.shards // rounds), F.col("part"))
        built.append(stored(grams.mapInArrow(_build(m.folder, order, m.hot, m.shards, rounds, turn), _ROW), f"{m.folder}/built/{turn}"))  # the shuffled n-grams go now
    lower = reduce(DataFrame.unionByName, built).repartitionById(_parts(m.shards), F.pmod("part", F.lit(_parts(m.shards)))).mapInArrow(_sum_lower(m.folder, m.shards), _ROW).repartitionById(m.shards, F.col("part"))
    stats = stored(lower.mapInArrow(_save_lower(m.folder, m.shards), _ROW), f"{m.folder}/stats")
    remove(spark, f"{m.folder}/built")
    sums: dict[str, dict[int, int]] = {}
    for r in stats.groupBy(F.col("c").cast("string").alias("name"), "a").agg(F.sum("b").alias("b")).collect():
        sums.setdefault(r["name"], {})[r["a"]] = r["b"]
    one = lambda name: sums.get(name, {}).get(0, 0)
    of_hot = lambda name: np.array([sums.get(name, {}).get(i, 0) for i in range(len(m.hot))], np.int64)
    m.tokens, m.texts, m.size, m.before = (one(x) for x in ("tokens", "texts", "words", "before"))
    counts = {k: [sums.get("order", {}).get(4 * k + i, 0) for i in range(4)] for k in range(1, order + 1)}
    m.discount = {k: discounts(n) for k, n in counts.items()}
    m.hot_uses, m.hot_total = of_hot("uses"), of_hot("total")
    spare = sum(d * of_hot(x) for d, x in zip(m.discount[2][1:], ("once", "twice", "more")))
    m.hot_gamma = np.where(m.hot_total > 0, spare / np.maximum(1, m.hot_total), 1.0)
    by = [counts[1][0], counts[1][1], m.size - counts[1][0] - counts[1][1]]
    m.free = (sum(d * n for d, n in zip(m.discount[1][1:], by)) / m.before if m.before else 1.0) / (m.size + 1)
    return m


# --- score ------------------------------------------------------------------------------------------------------------


def _ask(shared):
    """Texts -> a block of documents with what is known here, and blocks of n-grams for their shards."""

    @tidy
    def run(batches):
        m: Model = shared.value
        part, norm = TaskContext.get().partitionId(), np.log10(float(m.tokens + m.size + 1))
        number, docs, asked, size, known, texts = 0, [], [], 0, {}, 0

        def flush():
            rows = [(DOCS, part % _parts(m.shards), part, number, np.concatenate(docs).tobytes(), None)]
            if asked:
                of, t, n = (np.concatenate(x) for x in zip(*asked))
                u, t = _numbered(t)
                w = _windows(t, n, m.order, len(u) - 1)
                for p, r, coded in _coded(u, w, _shard(u, w, m.hot, m.shards), m.shards):
                    d, n = np.unique(of[r], return_counts=True)  # texts stay in order within a shard
                    rows.append((GRAMS, p, part, number, pack_arrays(d, n, *coded), None))
            return _batch(rows)

        for whole in batches:
            for b in slices(whole):
                t, n = _tokens(b)
                data, off = buffers(b.column("text"))
                raw, new, text = data.tobytes(), np.zeros(b.num_rows, bool), np.zeros(b.num_rows, np.int32)
                for i, (x, y) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                    key = xxhash.xxh3_128_digest(raw[x:y])
                    if key not in known:
                        known[key], new[i] = texts, True
                        texts += 1
                    text[i] = known[key]
                of = np.repeat(np.arange(b.num_rows), n)
                v, hot = place(m.hot, t)  # contexts' last words: all but the ends
                hot &= t != END
                row = np.zeros(b.num_rows, _DOC)
                row["doc"], row["null"] = b.column("doc_id").fill_null(0).to_numpy(), b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                row["held"], row["text"], row["n"] = b.column("held").to_numpy(zero_copy_only=False), text, n
                uses = m.hot_uses[v[hot]]
                row["known"] = np.bincount(of[hot], uses > 0, b.num_rows).astype(np.int64) + (m.texts > 0)
                row["base"] = np.bincount(of[hot], np.log10(uses + 1.0), b.num_rows) + np.log10(m.texts + 1.0) - n * norm
                docs.append(row)
                fresh = np.repeat(new, n)
                asked.append((text[of[fresh]].astype(np.int64), t[fresh], n[new]))
                size += int(fresh.sum()) + b.num_rows
                if size > FLUSH:
                    yield flush()
                    number, docs, asked, size, known, texts = number + 1, [], [], 0, {}, 0
        if docs:
            yield flush()

    return run


class Shard:
    """One shard's files, mapped: probabilities of n-grams whose context ends in one of its words."""

    def __init__(self, m: Model, part: int):
        self.m, self.file, self.lower = m, Arrays(f"{m.folder}/shard-{part}"), Arrays(f"{m.folder}/lower-{part}")
        self.words, self.second = Words(self.file["words"]), self.file["context2"]

    def spread(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the counts after these contexts, weight of their back-off)"""
        begin, end = self.file.span(f"word{k}", at)
        size = end - begin
        sums = np.zeros((4, len(at)), np.int64)
        far = np.flatnonzero(size > LONG)
        long = self.file[f"long{k}"]
        row = np.searchsorted(long, at[far].astype(long.dtype))
        for i in range(4):
            sums[i, far] = self.file.at(f"long{k}.{i}", row)
        near = np.flatnonzero((size > 0) & (size <= LONG))
        first = np.cumsum(size[near]) - size[near]
        places = np.repeat(begin[near] - first, size[near]) + np.arange(int(size[near].sum()))
        sums[:, near] = _sums(self.file.at(f"count{k}", places), first)
        total = sums[0]
        spare = sum(d * x for d, x in zip(self.m.discount[k][1:], sums[1:]))
        return total, spare / np.maximum(1, total)

    def score(self, u: np.ndarray, w: list[np.ndarray]):
        """(log10 probability of each n-gram, or of its back-off alone; whether the rest is for the second sharding; uses of the context's last word).

        w: places in the words u, which are looked up once. N-grams are looked up once each, sorted by their contexts from
        the last word to the first, so that contexts of every length are runs, looked up once each too.
        """
        m = self.m
        columns = [w[-2], *w[-3::-1], w[-1]]
        by, first = _order(columns, [len(u)] * m.order)
        back = np.empty(len(by), np.int64)
        back[by] = np.repeat(np.arange(len(first)), np.diff(first, append=len(by)))
        *context, last = [c[by[first]] for c in columns]

        n, (word_of, known), (hot_of, hot_known), (second_of, second_known) = len(last), self.words.place(u), place(m.hot, u), place(self.second, u)
        word, here, hot, is_hot = word_of[last], known[last], hot_of[context[0]], hot_known[context[0]]
        p, met = np.ones(n), is_hot & here
        p[here] = m.unigram(self.lower.at("before", word[here]))
        pair, met[met] = self.file.find("pair", hot[met], word[met])
        far = np.where(is_hot, ~met, ~here)
        p[met] = m.after_hot(hot[met], self.lower.at("paired", pair[met[is_hot & here]]), p[met])
        p[far] = 1.0
        uses, of = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k in range(2, m.order + 1):
            edge = _changes(context[: k - 1])
            if k == 2:
                v = context[0][edge]
                at, has = np.where(hot_known, len(self.second) + hot_of, second_of)[v], (second_known | hot_known)[v]
                own = has & ~is_hot[edge]
            else:
                at, x = at[of[edge]], context[k - 2][edge]
                has = has[of[edge]] & known[x]
                at[has], has[has] = self.file.find(f"first{k}", at[has], word_of[x[has]])
                own = has
            of = np.repeat(np.arange(len(edge)), np.diff(edge, append=n))
            if k == 2:
                used = np.zeros(len(edge), np.int64)
                used[own] = self.file.at("uses", at[own])
                uses = used[of]
            hit = own[of] & here & ~far
            gram, found = self.file.find(f"word{k}", at[of[hit]], word[hit])
            hit[hit] = found
            c, t, g = np.zeros(n, np.int64), np.ones(len(edge)), np.ones(len(edge))
            c[hit] = self.file.at(f"count{k}", gram[found])
            t[own], g[own] = self.spread(k, at[own])
            t, g = np.maximum(1, t)[of], g[of]
            p = np.where(far, g * p, m.cut(k, c) / t + g * p)
        return np.log10(p)[back], far[back], uses[back]


class Sums:
    """Sums of some texts, each known by its task, flush and number there, on their way to where their task's documents are."""

    def __init__(self):
        self.held: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        """columns: task, flush, number; log10 probability, log10 of the uses and how many words are known."""
        self.held.append([*columns[:3], *(np.asarray(x, np.float64) for x in columns[3:])])
        self.size += len(columns[0])

    def read(self, raw: bytes) -> None:
        columns = unpack_arrays(raw)
        self.add(*columns[:3], *(x.view(np.float64) for x in columns[3:]))

    def take(self) -> list[np.ndarray]:
        """The columns held, added up by text in an order that does not depend on who came first."""
        if not self.held:
            return [*[np.zeros(0, np.int64)] * 3, *[np.zeros(0)] * 3]
        columns = [np.concatenate(x) for x in zip(*self.held)]
        self.held, self.size = [], 0
        by = np.lexsort(columns[::-1])
        columns = [c[by] for c in columns]
        first = _changes(columns[:3])
        return [*(c[first] for c in columns[:3]), *(np.add.reduceat(c, first) for c in columns[3:])]

    def parts(self, shards: int) -> dict[int, bytes]:
        columns, parts = self.take(), _parts(shards)
        return {p: pack_arrays(*(c[x] for c in columns[:3]), *(c[x].view(np.int64) for c in columns[3:])) for p, x in _deal(columns[0] % parts, parts)}


def _answer(shared):
    """N-grams of one shard -> sums by text; those whose last bigram the shard has never seen go on to the second sharding.

    What goes to the same place waits for the blocks after it and leaves as one row: c has sums, d has questions.
    """

    @tidy
    def run(batches):
        m: Model = shared.value
        part, shard, sums, asks, asked = TaskContext.get().partitionId(), None, Sums(), [], 0

        def flush():
            nonlocal asks, asked
            to = sums.parts(m.shards)
            columns = [np.concatenate(x) for x in zip(*asks)]
            ask = {p: pack_arrays(*(c[x] for c in columns)) for p, x in _deal(_second(columns[-1], m.shards), _parts(m.shards))} if asks else {}
            asks, asked = [], 0
            return _batch([(SUMS, p, part, 0, to.get(p), ask.get(p)) for p in sorted(to.keys() | ask.keys())])

        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == DOCS:
                    yield _batch([tuple(r.values())])
                    continue
                shard = shard or Shard(m, part)
                d, n, u, *places = unpack_arrays(r["c"])
                log, far, uses = shard.score(u, places)
                first, a, b_ = np.cumsum(n) - n, r["a"], r["b"]
                sums.add(np.full(len(d), a), np.full(len(d), b_), d, *(np.add.reduceat(x, first) for x in (log, np.log10(uses + 1.0), (uses > 0).astype(np.int64))))
                of, hot = np.repeat(d, n)[far], place(m.hot, u[places[-2][far]])
                asks.append([np.full(len(of), a), np.full(len(of), b_), of, np.where(hot[1], hot[0], -1), u[places[-1][far]]])
                asked += len(of)
                if sums.size + asked > HELD:
                    yield flush()
        if sums.size or asked:
            yield flush()

    return run


def _answer_second(shared):
    """Words of one part of the second sharding -> sums by text. Sums of the shards are added up on the way."""

    @tidy
    def run(batches):
        m: Model = shared.value
        part, file, own, sums = TaskContext.get().partitionId(), None, Sums(), Sums()
        send = lambda s: _batch([(SUMS, p, part, 0, c, None) for p, c in s.parts(m.shards).items()])
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == DOCS:
                    yield _batch([tuple(r.values())])
                    continue
                if r["c"] is not None:
                    own.read(r["c"])
                if r["d"] is not None:
                    if file is None:
                        f = Arrays(f"{m.folder}/second-{part}")
                        file = [f[x] for x in ("words", "before", "pairs", "count")]
                    known, before, pairs, count = file
                    *text, v, w = unpack_arrays(r["d"])
                    at, here = place(known, w)
                    p = np.full(len(w), m.free)
                    p[here] = m.unigram(before[at[here]])
                    at, met = place(pairs, _pair_key(v, w))
                    c = np.zeros(len(w), np.int64)
                    c[met] = count[at[met]]
                    hot = v >= 0
                    p[hot] = m.after_hot(v[hot], c[hot], p[hot])
                    sums.add(*text, np.log10(p), *[np.zeros(len(p))] * 2)
                for s in (own, sums):
                    if s.size > HELD:
                        yield send(s)
        for s in (own, sums):
            if s.size:
                yield send(s)

    return run


@tidy
def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs, sums = {}, Sums()
    for b in batches:
        for r in b.to_pylist():
            if r["kind"] == DOCS:
                docs[r["a"], r["b"]] = r["c"]
            else:
                sums.read(r["c"])
    task, flush, text, *sums = sums.take()
    edge = _changes([task, flush])
    place_of = {(a, b): slice(i, j) for a, b, i, j in zip(task[edge].tolist(), flush[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(task)])}
    for key, raw in docs.items():
        rows = np.frombuffer(raw, _DOC)
        total = np.zeros((3, rows["text"].max() + 1))
        if key in place_of:
            x = place_of[key]
            total[:, text[x]] = [c[x] for c in sums]
        score, base, known = total[:, rows["text"]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["doc"], mask=rows["null"].astype(bool)), pa.array(rows["held"].astype(bool)), pa.array(rows["n"]), pa.array(rows["known"] + known.astype(np.int64)), pa.array(rows["base"] + base), pa.array(score)],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )


def score(docs: DataFrame, model: Model, held_out: Column | None = None, rounds: int = 3) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs (doc_id, text).

    score: log10 probability of the whole text and its end by the model; base_score: the same by add-one unigrams.
    A null or empty text is its end token alone. Repeated rows and null ids are kept; other columns are ignored; an
    empty table stays empty. rounds: the texts are scored in so many shares, by their hashes, each written before the next
    begins, so that no more than a share's n-grams are on the disks at a time; it changes no result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    deal = lambda df, parts: df.repartitionById(parts, F.col("part"))
    second = _parts(model.shards)
    rows = docs.select(F.col("doc_id").cast("long"), (F.lit(False) if held_out is None else held_out).alias("held"), F.col("text").cast("string"))
    folder, parts = shared_dir(spark, "scores"), []
    for i in range(rounds):
        asked = deal(rows.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == i).mapInArrow(_ask(shared), _ROW), model.shards)
        back = deal(deal(asked.mapInArrow(_answer(shared), _ROW), second).mapInArrow(_answer_second(shared), _ROW), second)
        out = back.mapInArrow(_gather, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        parts.append(stored(out, f"{folder}/{i}"))
    return reduce(DataFrame.unionByName, parts).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
