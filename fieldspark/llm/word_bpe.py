"""ids of texts by a word-level BPE tokenizer file, each distinct piece encoded once.

Such a tokenizer drops white space, so its pieces never cross it. Words of ASCII and simple Latin letters are cut where
its pattern cuts them (runs of letters, single digits, runs of other signs) and each piece goes to the model alone.
Words with an apostrophe, a bar (special tokens) or other characters go through the whole tokenizer.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from .hashing import U, mix, span_hashes, windows, word_spans
from .memo import Memo

# Byte classes: 1 letter, 2 digit, 3 other sign.
_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_ODD = np.zeros(256, bool)
_ODD[[0x27, 0x7C, 0xC2, *range(0xCA, 256)]] = True


def _visible() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.sign = Tokenizer.from_file(path), _visible()
        self.memo = Memo(self._encode)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        out, one, odd = [], self.tok.model.tokenize, []
        for i, w in enumerate(texts):
            if w[0] == "\x00":  # a word that the whole tokenizer has to see
                odd.append(i)
                out.append(w[1:])
            elif w.isascii():
                out.append([t.id for t in one(w.lower())] if w[0].isalpha() or w.isprintable() else [t.id for t in one("".join(self.sign[b] for b in w.encode()))])
            else:
                out.append([t.id for t in one("".join(self.sign[b] for b in w.lower().encode()))])
        for i, x in zip(odd, self.tok.encode_batch([out[i] for i in odd], add_special_tokens=False)):
            out[i] = x.ids
        return out

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of the texts of a buffer."""
        streams, per = [], np.zeros(len(offsets) - 1, np.int64)
        for lo, hi in windows(data, offsets):
            d = data[lo:hi]
            s, e = word_spans(data, offsets, lo, hi)
            s, e = s - lo, e - lo
            if not len(s):
                continue
            strange = _ODD[d]
            c3 = np.flatnonzero(d[:-1] == 0xC3)
            strange[c3[np.isin(d[c3 + 1], (0x97, 0xB7))]] = True
            c4 = np.flatnonzero(d[:-1] == 0xC4)
            strange[c4[d[c4 + 1] == 0xB0]] = True  # lower case of this letter is no letter
            strange[d == 0] = True
            total = np.concatenate(([0], np.cumsum(strange)))
            odd = total[e] > total[s]
            kind = _KIND[d]
            cut = np.zeros(hi - lo, bool)
            cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
            depth = np.zeros(hi - lo + 1, np.int8)
            depth[s[~odd]] = 1
            depth[e[~odd]] -= 1
            cut &= np.cumsum(depth[:-1], dtype=np.int8).astype(bool)
            cut[s] = True
            a = np.flatnonzero(cut)
            w = np.searchsorted(s, a, side="right") - 1
            b = np.minimum(np.append(a[1:], hi - lo), e[w])
            h, g = span_hashes(d, a, b, 0, hi - lo, lower=True, second=True)
            far = odd[w]
            own, g[far] = span_hashes(d, a[far], b[far], 0, hi - lo, second=True)  # case tells special tokens from words
            h[far] = mix(own + U(1))
            at = self._find(d, h, g, a, b, far)
            got, n = self.memo.stream(at)
            streams.append(got)
            doc = np.searchsorted(offsets, a + lo, side="right") - 1
            per += np.bincount(doc, n, len(per)).astype(np.int64)
        return (np.concatenate(streams) if streams else np.zeros(0, np.uint32)), per

    def _find(self, d, h, g, a, b, far):
        if far.any():
            # odd words are told from others of equal bytes by a leading NUL, which no plain piece has
            raw = np.concatenate([d, *(x for i, j in zip(a[far], b[far]) for x in (np.zeros(1, np.uint8), d[i:j]))])
            size = (b - a)[far] + 1
            start = len(d) + np.cumsum(size) - size
            a, b = a.copy(), b.copy()
            a[far], b[far] = start, start + size
            d = raw
        return self.memo.find(d, h, g, a, b)


@lru_cache(1)
def word_bpe(path: str) -> WordBpe:
    """One per worker: tasks that follow on it find pieces remembered."""
    return WordBpe(path)
