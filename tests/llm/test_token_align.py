"""Alignment of two tokenizers against whole texts, plain Python and the libraries themselves."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from fieldspark.llm.token_align import Aligner, ByteLevel, Pieces, align, alignment

A, B = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    "", " ", "  ", "a", "a ", " a", "a  b", "a \n b", "a  b", "x  y", "x　 y z", "x\u0085 y", "tab\t x", "The cat's mat. It's 12,345 km — “far” … away",
    "é à œ 字 字 한국 \U0001f600 \U0001f600 z", "<|endoftext|> a <s> </s> <unk> <0x41>", "under▁score b", "▁", "nul\0byte c", "\x1c d", "a\x1d d", "ab" * 4000, "abcab" * 3000 + " x", "\n" * 3000, "a" + " " * 3000 + "b", "\n \n  \n", "don't won't 'S 'll",
]


@pytest.fixture(scope="module")
def coders():
    return ByteLevel(A), Pieces(B)


def tokens(a, b, text):
    """(ids of both, groups as lists of ids) of a whole text, or None."""
    if not text:
        return None
    x, y = a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
    want = (" " + text).encode()
    if b"".join(a.bytes[i] for i in x) != want or b"".join(b.bytes[i] for i in y) != want:
        return None
    groups, own, i, j, p, q = [], ([], []), 0, 0, 0, 0
    while i < len(x) or j < len(y):
        if p <= q and i < len(x) and not (p == q and own[0] and own[1]):
            own[0].append(x[i])
            p += len(a.bytes[x[i]])
            i += 1
        else:
            own[1].append(y[j])
            q += len(b.bytes[y[j]])
            j += 1
        if p == q:
            groups.append(own)
            own = ([], [])
    return x, y, groups


def brute(a, b, texts):
    found, held = [tokens(a, b, t) for t in texts], Counter()
    linked = []
    for f in found:
        linked.append(Counter())
        for g, h in f[2] if f else []:
            cg, ch = Counter(g), Counter(h)
            for u in cg:
                for v in ch:
                    linked[-1][u, v] += cg[u] * ch[v]
        held.update(linked[-1].keys())
    best = Counter()
    for (u, v), n in held.items():
        best[u] = max(best[u], n)
    out = []
    for f, k in zip(found, linked):
        if not f:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in f[2])
        out.append((len(f[0]), len(f[1]), len(f[2]), sum(k.values()), sum(n for (u, v), n in k.items() if held[u, v] == best[u]), sum(n * held[p] for p, n in k.items()), hashlib.sha256(said.encode()).hexdigest()))
    return out, held


def rows_of(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def test_matches_brute_force(spark, coders):
    rng = random.Random(5)
    alphabet = ["the", "cat", "naïve", "12", "x_y", " ", " ", " ", "\n", "…", "字", "\U0001f600", "Zürich's", "aaaa", "\t", "'ll", "é", "\x1f", "qzxv"]
    texts = ODD + ["".join(rng.choice(alphabet) + rng.choice([" ", " ", " ", "", "\n", "  "]) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += texts[20:60] + ["the cat sat"] * 40
    want, held = brute(*coders, texts)
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, n_a int").repartition(5)
    assert rows_of(alignment(docs, A, B, batch_bytes=5000, part_bytes=3000)) == sorted((i, *w) for i, w in enumerate(want))
    assert {((r["a"], r["b"]), r["n"]) for r in align(docs, A, B)[1].collect()} == set(held.items())


def test_nulls_repeats_and_no_rows(spark, coders):
    texts = [None, "", "one two", "one two", "one  two three"]
    (want, _) = brute(*coders, [t or "" for t in [*texts, "one two"]])
    docs = spark.createDataFrame([*((i % 3, t) for i, t in enumerate(texts)), (None, "one two")], "doc_id int, text string")
    got = [tuple(r) for r in alignment(docs, A, B).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    assert sorted(got, key=str) == sorted([*((i % 3, *want[i]) for i in range(5)), (None, *want[5])], key=str)
    assert alignment(docs.limit(0), A, B).count() == 0 and align(docs.where("doc_id = 7"), A, B)[1].count() == 0


def test_segments_are_forgotten_in_bounds(coders):
    """A small memory gives the same; segments far over its bound are handled too."""
    import numpy as np

    small = Aligner(*coders, bits=3, pool=4)
    for text in ("one two three four five six seven", "ab" * 500 + " x", "one two"):
        segs = [" " + w for w in text.split(" ")]
        data = np.frombuffer("".join(segs).encode(), np.uint8)
        size = np.array([len(s.encode()) for s in segs])
        e = np.cumsum(size)
        from fieldspark.llm.hashing import span_hashes

        h, g = span_hashes(data, e - size, e, 0, len(data), second=True)
        at = small.find(data, h, g, e - size, e)
        x, y, groups = tokens(*coders, text)
        assert small.counts[at].sum(0).tolist() == [len(x), len(y), len(groups), sum(len(g) * len(h) for g, h in groups)]


def test_large_groups_are_counted_not_listed(coders):
    """Two vocabularies that never meet within a long run: one group, pairs counted by id."""
    import numpy as np

    class Toy:
        def __init__(self, sizes, cut):
            self.bytes, self.cut = [b" " + b"a" * (n - 1) if i == 0 else b"a" * n for i, n in enumerate(sizes)], cut

        def encode(self, texts):
            return [self.cut(len(t)) for t in texts]

    n = 4002  # a space and 4001 letters
    one = Toy([2, 4, 4], lambda k: [0] + [1 + i % 2 for i in range((k - 2) // 4)])
    two = Toy([4, 4, 2], lambda k: [0] + [1] * ((k - 6) // 4) + [2])
    al = Aligner(one, two)
    links = al._align([" " + "a" * (n - 1)])
    codes, times = al.codes[: al.kept], al.times[: al.kept]
    assert links.tolist() == [len(codes)] and al.counts[0].tolist() == [1001, 1001, 1, 1001 * 1001]
    assert dict(zip(codes.tolist(), times.tolist())) == {u * 3 + v: cu * cv for u, cu in ((0, 1), (1, 500), (2, 500)) for v, cv in ((0, 1), (1, 999), (2, 1))}
    assert int(np.sum(times)) == 1001 * 1001
