import random
import re
from itertools import product

import numpy as np
import pytest

from fieldspark.llm.ngram_join import ngram_components, signatures


def brute(rows, k=5, percent=75):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, len(sets[i]), low.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def made(seed, n):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Über", "É", "A"]
    passage = " ".join(r.choice(vocab) for _ in range(30))
    rows = []
    for i in range(n):
        if rows and r.random() < 0.6:
            w = (r.choice(rows)[1] or "x").split()
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocab)
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(r.choice(vocab) for _ in range(r.choice([1, 3, 4, 5, 6, 20, 60, 120]))) + (" " + passage if r.random() < 0.5 else "")))
    return rows


@pytest.mark.parametrize("frequent,tile", [((32, 1024), 8 << 20), ((2, 4), 1000), ((1, 3), 8 << 20)])
def test_matches_brute_force(spark, frequent, tile):
    rows = made(3, 220)
    out = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), frequent=frequent, tile=tile).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows)


@pytest.mark.parametrize("hot", [(4096, 4096, 2), (4096, 16, 4), (3, 3, 2)])
def test_hot_tokens_change_nothing(spark, hot):
    rows = made(6, 150) + [(1000 + i, "the same words again in every copy of it") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted((tuple(r) for r in ngram_components(df, hot=hot).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_words_that_a_polynomial_confuses(spark, parts):
    """Thue-Morse words and their complements: one sum for any two values of the letters."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a), (2, b), (3, a), (4, f"{a} x y z w"), (5, f"{b} x y z w"), (6, f"x {b}"), (7, f"x {b}")]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        out = ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sorted((tuple(r) for r in out), key=str) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t "), (4, "one"), (5, "ONE"), (6, "one"), (None, "a b c d e f g"), (7, "a b c d e f g"), (7, "a b c d e f g"), (8, "x " * 30000), (9, "a b c")]
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, node string, n int")
    assert sorted((tuple(r) for r in ngram_components(df).collect()), key=str) == brute(rows)
    assert ngram_components(df.limit(0)).collect() == []


def test_copies_over_many_tasks(spark):
    rows = made(4, 60) + [(1000 + i, "the same words again in every copy of it") for i in range(120)] + [(2000, "The same words again in every copy of it now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert sorted((tuple(r) for r in ngram_components(df).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("tile", [60_000, 8 << 20])
def test_large_near_copy_group(spark, tile):
    r = random.Random(5)
    base = [f"t{i}" for i in range(300)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(6):
            w[r.randrange(300)] = f"u{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    out = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), tile=tile).collect()
    assert sorted((tuple(x) for x in out), key=str) == brute(rows)


def test_small_nodes_share_a_signature():
    tok = np.array([11, 22, 33, 44], np.uint64)
    for df in product([1, 2, 33, 1025], repeat=4):
        df = np.array(df, np.uint32)
        if (df[:3] > 1).all():  # the three tokens of one node are in the other one of four
            own = df > 1
            a, b = signatures(tok[:3], df[:3], 3, 75, (32, 1024)), signatures(tok[own], df[own], 4, 75, (32, 1024))
            assert len(np.intersect1d(a, b)), df


@pytest.mark.parametrize("frequent", [(1, 2), (1, 3), (2, 3)])
def test_seven_against_eight_words(spark, frequent):
    rows = []
    for i in range(6):
        w = [f"g{i}w{j}" for j in range(7)]
        rows.append((100 * i + 1, " ".join(w)))
        rows.append((100 * i, " ".join([*w, "rare"]) if i % 2 else " ".join(["rare", *w])))
        for j in range(2 + i % 3):  # texts that make some of the shingles frequent and link with nothing
            rows.append((100 * i + 10 + j, " ".join([f"p{j}", *w[1:], *(f"q{i}{j}{x}" for x in range(9))])))
        if frequent[0] > 1:
            rows.append((100 * i + 50, " ".join([*w[:5], *(f"r{i}{x}" for x in range(9))])))
    out = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), frequent=frequent).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows)
