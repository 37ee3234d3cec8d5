"""Token counts, packing, byte-level BPE and language-model scores against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from fieldspark.llm import bpe_tree, lm, packing, token_counts
from fieldspark.llm.hashing import span_hashes
from fieldspark.llm.memo import Memo

MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))  # with its complement, one sum for any values of the letters
ALPHABET = list("ab  \n\t .,'▁é漢字🙂sreLl1 9") + ["'ll", "'re", " the", "<s>", " ", "<|endoftext|>", "́", "İ", "Σ", "\x00", "×", "don't", "12"]


def texts(seed=1, n=400):
    r = random.Random(seed)
    made = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(60))) for _ in range(n)]
    return [*made, None, "", " ", "  ", "a ", " a", "x" * 50_000, "word " * 20_000, "▁", made[0], *(w for n in (1024, 2048) for m in (MORSE[:n], MORSE[:n].translate(str.maketrans("ab", "ba"))) for w in (m, m + " " + m[::-1])), "<|ENDOFTEXT|> <|endoftext|> <|EndOfText|>"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 3 else i, t, "clash", 7) for i, t in enumerate(texts())]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, ids string, part int")


def test_memo_tells_equal_hashes_apart():
    memo = Memo(lambda texts: [[len(x), ord(x[0])] for x in texts])
    data = np.frombuffer(b"abbcccab", np.uint8)
    s, e = np.array([0, 1, 3, 6, 7]), np.array([1, 3, 6, 7, 8])
    for _ in range(2):
        at = memo.find(data, np.zeros(5, np.uint64), np.array([1, 2, 3, 1, 9], np.uint64), s, e)
        ids, n = memo.stream(at)
        assert ids.tolist() == [1, 97, 2, 98, 3, 99, 1, 97, 1, 98] and n.tolist() == [2] * 5


def test_span_hashes():
    r = random.Random(3)
    words = sorted({bytes(r.choice(b"ab") for _ in range(r.randrange(1, 200))) for _ in range(3000)} | {MORSE.encode(), b"\x00", b"\x00\x00"})
    words += [w.upper() for w in words]
    data, size = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    e = np.cumsum(size)
    for lower in (False, True):
        h, g = span_hashes(data, e - size, e, 0, len(data), lower, True)
        want = len({w.lower() if lower else w for w in words})
        assert len(set(h.tolist())) == len(set(g.tolist())) == want and len(set(h.tolist()) & set(g.tolist())) == 0
        for i in range(0, len(words), 97):
            alone = span_hashes(np.frombuffer(words[i], np.uint8), np.array([0]), size[i : i + 1], 0, int(size[i]), lower, True)
            assert (alone[0][0], alone[1][0]) == (h[i], g[i])


def test_token_counts(docs):
    import sentencepiece

    rows, df = docs
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = sorted((str(d), len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for d, t, *_ in rows)
    got = token_counts.token_counts(df, P.path("piece_bpe_32k.model"), batch_bytes=2000).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert token_counts.token_counts(df.limit(0), P.path("piece_bpe_32k.model")).collect() == []


def test_pack(docs):
    from tokenizers import Tokenizer

    rows, df = docs
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = packing.pack(df.repartition(5), P.path("word_bpe_49k.json"), windows=4).collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    for d, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            piece = ids[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in piece))
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append(r)
    for pieces in seqs.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.005 * total
    assert packing.pack(df.limit(0), P.path("word_bpe_49k.json")).collect() == []


@pytest.mark.parametrize("leaf,reach", [(1, 1), (3, 2), (64, 4), (4096, 32)])
def test_bpe_tree(leaf, reach):
    c = bpe_tree.TreeBpe.from_file(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, leaf=leaf, reach=reach)
    for t in texts(2, 300):
        if t is not None and (leaf > 3 or len(t) < 5000):
            assert c.encode(t) == c.own(t)
            assert c.decode(c.own(t)) == t.encode()


@pytest.mark.parametrize("leaf", [64, 1024, 4096])
def test_bpe_runs_of_white_space(leaf):
    """Cut out early, runs give what the encoder gives; where it gives up, the bytes come back."""
    c = bpe_tree.TreeBpe.from_file(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, leaf=leaf, run=5)
    r = random.Random(leaf)
    blanks = [" ", " ", "\n", "\t", "\r\n", "\u3000", "\x85", "\x1c"]
    for _ in range(200):
        t = "".join(r.choice(["a", "Zü", "7", ".", "'s", "".join(r.choices(blanks, k=r.randrange(40)))]) for _ in range(r.randrange(60)))
        assert c.encode(t) == c.own(t), repr(t)
    c = bpe_tree.TreeBpe.from_file(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, leaf=leaf)
    for run in (" " * 2_000_000, "\n" * 2_000_000, " \n\t" * 700_000):
        for t in (f"one two{run}three", f"x y{run}"):
            ids = c.encode(t)
            assert c.decode(ids) == t.encode()
    few = "one two" + " \n" * 50_000 + "x"
    assert c.encode(few) == c.own(few)


def test_bpe_spark(docs):
    rows, df = docs
    path = P.path("byte_bpe_50k.tiktoken")
    c = bpe_tree.TreeBpe.from_file(path, P.PATTERN)
    enc = bpe_tree.bpe_encode(df, path, P.PATTERN)
    assert sorted((str(r[0]), bytes(r[1])) for r in bpe_tree.bpe_decode(enc, path, P.PATTERN).collect()) == sorted((str(d), (t or "").encode()) for d, t, *_ in rows)
    for r in bpe_tree.bpe_digests(df, path, P.PATTERN).where("doc_id is not null").collect():
        ids = c.own(rows[r["doc_id"]][1] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((rows[r["doc_id"]][1] or "").encode()).hexdigest()


def kneser_ney(rows, order):
    """The scores by plain dictionaries: counts, continuation counts, discounts, back-off, all written out."""
    tok = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    grams = lambda w: [tuple((["<s>"] * (order - 1) + w)[i : i + order]) for i in range(len(w))]
    held = {i: zlib.crc32(str(d).encode()) % 7 == 2 if d is not None else False for i, (d, *_) in enumerate(rows)}
    count = {order: collections.Counter()}
    uni = collections.Counter()
    for i, (_, t, *_) in enumerate(rows):
        if not held[i]:
            uni.update(tok(t))
            count[order].update(grams(tok(t)))
    for k in range(order - 1, 0, -1):
        count[k] = collections.Counter(g[1:] for g in count[k + 1])
    n, v, cut = sum(uni.values()), len(uni), {}
    for k, c in count.items():
        n1, n2, n3, n4 = (sum(x == j for x in c.values()) for j in (1, 2, 3, 4))
        cut[k] = {0: 0, 1: 0.5, 2: 1.0, 3: 1.5}
        if min(n1, n2, n3, n4) > 0:
            y = n1 / (n1 + 2 * n2)
            d = {0: 0, 1: 1 - 2 * y * n2 / n1, 2: 2 - 3 * y * n3 / n2, 3: 3 - 4 * y * n4 / n3}
            if min(d.values()) >= 0 and all(d[j] <= j for j in d):
                cut[k] = d
    after = {k: collections.defaultdict(list) for k in count}
    for k, c in count.items():
        for g, x in c.items():
            after[k][g[:-1]].append(x)

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (v + 1)
        followers = after[k].get(g[:-1])
        if not followers:
            return p(g[1:])
        total, spare = sum(followers), sum(cut[k][min(x, 3)] for x in followers)
        x = count[k].get(g, 0)
        return max(x - cut[k][min(x, 3)], 0) / total + spare / total * p(g[1:])

    out = []
    for i, (d, t, *_) in enumerate(rows):
        w = tok(t)
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w)
        out.append((str(d), held[i], len(w), sum(uni[x] > 0 for x in w), n, base, sum(math.log10(p(g)) for g in grams(w))))
    return sorted(out)


@pytest.mark.parametrize("order,hot_share", [(2, 0.0), (2, None), (3, 0.0), (3, 0.02), (3, 1.0), (4, 0.05)])
def test_kneser_ney(spark, order, hot_share):
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(300)] + ["The", "É"]
    rows = [(i, " ".join(vocab[min(len(vocab) - 1, int(r.paretovariate(0.7)))] for _ in range(r.randrange(80))), "x") for i in range(300)]
    rows += [(None, "w1 w2", "x"), (900, None, "x"), (910, MORSE, "x"), (911, MORSE.translate(str.maketrans("ab", "ba")), "x"), (901, "", "x"), (902, "never seen words", "x"), (903, "w1 w1 w1 " * 5000, "x"), rows[5]]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
    got = sorted((str(x[0]), *x[1:]) for x in lm.score(df, lm.fit(df.where(~lm.is_held_out()), order, hot_share), lm.is_held_out()).collect())
    for a, b in zip(got, kneser_ney(rows, order), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_kneser_ney_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(empty, lm.fit(empty)).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted(x["score"] for x in lm.score(some, lm.fit(empty)).collect()) == [0.0, 0.0]
    with pytest.raises(ValueError, match="order"):
        lm.fit(empty, 1)


def test_counts_beyond_32_bits(tmp_path):
    c = np.array([1, 254, 255, 256, 2**40, 0])
    lm.save_arrays(f"file://{tmp_path}/a", {"c": c, "h": np.array([5, 2**64 - 1], np.uint64), "none": c[:0]})
    a = lm.Arrays(f"file://{tmp_path}/a")
    assert a["c"].tolist() == c.tolist() and a["h"].tolist() == [5, 2**64 - 1] and a["none"].tolist() == []
    x, y = lm.unpack_arrays(lm.pack_arrays(c, a["h"]))
    assert x.tolist() == c.tolist() and y.tolist() == a["h"].tolist()
