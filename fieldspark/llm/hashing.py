"""Vectorised word splitting and hashing over Arrow batches of texts.

Words are ``[^\\x20\\x09-\\x0D]+`` on the UTF-8 bytes; lower-casing touches A-Z only.  Everything works on whole texts:
a batch is walked in windows cut at white space or at a text's end, so memory follows the window, not the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_SEED = np.uint64(0x9E3779B97F4A7C15)
_LONG = 64  # bytes from which a span is hashed on its own


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads 64-bit values."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    _, off, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, breaks: np.ndarray, lo: int, hi: int, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words in data[lo:hi]; ``breaks`` (sorted) are positions where a text begins."""
    solid = ~space[data[lo:hi]]
    cut = np.zeros(hi - lo + 1, bool)
    cut[breaks[np.searchsorted(breaks, lo) : np.searchsorted(breaks, hi)] - lo] = True
    cut[0] = cut[-1] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | cut[1:-1]
    return np.flatnonzero(start) + lo, np.flatnonzero(end) + lo + 1


def windows(data: np.ndarray, offsets: np.ndarray, size: int = 1 << 20):
    """(lo, hi) pieces of the data of at most about ``size`` bytes that cut no word."""
    lo, total = 0, len(data)
    while lo < total:
        hi = min(lo + size, total)
        if hi < total:
            at = offsets[np.searchsorted(offsets, hi, side="right") - 1]
            if at > lo:
                hi = int(at)
            else:
                back = np.flatnonzero(SPACE[data[max(lo, hi - 65536) : hi]])
                if len(back):
                    hi = max(lo, hi - 65536) + int(back[-1]) + 1
                else:
                    stop = int(offsets[np.searchsorted(offsets, hi, side="left")])
                    ahead = np.flatnonzero(SPACE[data[hi:stop]])
                    hi = hi + int(ahead[0]) + 1 if len(ahead) else stop
        yield lo, hi
        lo = hi


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, lo: int, hi: int, lower: bool = False, second: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """64-bit hashes of the spans [s, e) of data[lo:hi], and, if asked for, second hashes that are independent of them.

    The bytes enter eight at a time, with the length; spans of more than 64 bytes are hashed by xxh3. Up to eight bytes
    of one length the hash is one to one.
    """
    d = np.zeros(hi - lo + 8, np.uint8)
    d[: hi - lo] = LOWER[data[lo:hi]] if lower else data[lo:hi]
    lane = np.ndarray((hi - lo + 1,), "<u8", d, 0, (1,))  # the eight bytes from each place on
    s, n = s - lo, e - s
    v = lane[s] & _MASK[np.minimum(n, 8)]
    size = n.astype(np.uint64) * _SEED
    h, g = mix(v ^ size), (mix(v * U(0xD6E8FEB86659FD93) + ~size) if second else None)
    at, j = np.flatnonzero(n > 8), 8
    while len(at) and j < _LONG:
        v = lane[s[at] + j] & _MASK[np.minimum(n[at] - j, 8)]
        h[at] = mix(h[at] ^ v)
        if second:
            g[at] = mix(g[at] * U(0xA0761D6478BD642F) + v)
        j += 8
        at = at[n[at] > j]
    for i in at.tolist():
        x = xxhash.xxh3_128_intdigest(d[s[i] : s[i] + n[i]].data)
        h[i] = x >> 64
        if second:
            g[i] = x & (2**64 - 1)
    return h, g


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, start, end) of every word, in order."""
    out = []
    for lo, hi in windows(data, offsets):
        s, e = word_spans(data, offsets, lo, hi, space)
        out.append((span_hashes(data, s, e, lo, hi, lower)[0], np.searchsorted(offsets, s, side="right") - 1, s, e))
    if not out:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    return tuple(np.concatenate(x) for x in zip(*out))


_M = [U(int(x) | 1) for x in np.random.Generator(np.random.PCG64(77)).integers(0, 2**63, 16)]


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each run of k words; a text of 1..k-1 words gives its whole sequence as one."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    n = len(h)
    g = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        g += mix(h[j : n - k + 1 + j] + _M[j]) * _M[j] if len(g) else 0
    full = doc[: len(g)] == doc[k - 1 :] if len(g) else np.zeros(0, bool)
    g, d = mix(g[full]), doc[: len(full)][full]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = count[short] > j
            extra[has] += mix(h[first[short[has]] + j] + _M[j]) * _M[j]
        extra = mix(extra + count[short].astype(np.uint64) * _M[15])
        g, d = np.concatenate([g, extra]), np.concatenate([d, short])
        order = np.argsort(d, kind="stable")
        g, d = g[order], d[order]
    return g, d


def by_text(values: np.ndarray, doc: np.ndarray, n_docs: int):
    """The slice of values of each text, in text order (doc ascending)."""
    edge = np.searchsorted(doc, np.arange(n_docs + 1))
    for i in range(n_docs):
        yield values[edge[i] : edge[i + 1]]


def unique_sorted(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 4 << 20):
    """Cuts a batch into runs of rows of at most ``size`` bytes of text (one longer row stands alone)."""
    _, offsets = buffers(batch.column(column))
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
