"""Fingerprints, archives, nearest neighbours, languages and toxicity."""

import base64
import hashlib
import math
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldspark.llm import ann, langid, linear, queries, simhash, toxicity, warc
from fieldspark.llm.hashing import mix, shingles, words

SF = "/root/testdata/sf0.01"


def test_neighbouring(spark):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["été", "b", "ccc", "🙂"]) for _ in range(r.randrange(40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "z" * 30_000), (103, "one"), (104, "one")]
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], "doc_id long, text string, part string, kind int").repartition(7)
    got = {x["doc_id"]: x for x in simhash.neighbouring(df).collect()}
    order = sorted(rows, reverse=True)
    bits = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128
    print_of = lambda t: simhash.fingerprints(pa.array([t]))[0].hex()
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after, x = t or "", after or "", got[d]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert x["n_chars"] == len(t) and x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert x["fingerprint"] == print_of(t) and x["edited_fingerprint"] == print_of(edited)
        assert x["near_edited"] == pytest.approx(bits(print_of(t), print_of(edited))) and x["near_next"] == pytest.approx(bits(print_of(t), print_of(after)))
    assert len(got) == len(rows)
    same = spark.createDataFrame([(5, "a"), (5, "b"), (None, "c"), (5, "a")], "doc_id long, text string")
    assert simhash.neighbouring(same).count() == 4
    assert simhash.neighbouring(same.limit(0)).collect() == []


def test_fingerprints_by_votes():
    """Bit by bit: 1 + ln(times) votes of each run of three words, by the bits of its 64-bit hash and of a second one."""
    r = random.Random(9)
    for text in ["", "one", "one two", "A b a b a b", " ".join(r.choice("abcde") for _ in range(400)), "x" * 5000 + " y z"]:
        data = np.frombuffer(text.encode(), np.uint8)
        off = np.array([0, len(data)])
        terms, _ = shingles(*words(data, off)[:2], 1, 3)
        votes = [0.0] * 128
        for term, times in Counter(terms.tolist()).items():
            other = int(mix(np.array([(term + 0x51ED27) % 2**64], np.uint64))[0])
            raw = term.to_bytes(8, "little") + other.to_bytes(8, "little")
            for i in range(128):
                votes[i] += (1 if raw[i // 8] >> (7 - i % 8) & 1 else -1) * (1 + math.log(times))
        want = sum((votes[i] > 1e-4) << (127 - i) for i in range(128))
        sure = sum((abs(votes[i]) > 1e-4 or not terms.size) << (127 - i) for i in range(128))
        assert (int.from_bytes(simhash.fingerprints(pa.array([text]))[0], "big") ^ want) & sure == 0


def test_near_counts_of_edited_texts(spark):
    r = random.Random(8)
    texts = []
    for i in range(30):
        w = [f"w{r.randrange(5000)}" for _ in range(300)]
        texts.append(" ".join(w))
        w[r.randrange(300)] = "changed"
        texts.append(" ".join(w))
    base = [f"w{r.randrange(5000)}" for _ in range(400)]
    for i in range(90):  # a family larger than what is compared by shifts
        w = list(base)
        w[r.randrange(400)] = f"u{i}"
        texts.append(" ".join(w))
    texts += ["", "", texts[0]]
    prints = [x.hex() for x in simhash.fingerprints(pa.array(texts))]
    apart = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    df = spark.createDataFrame(list(enumerate(prints)), "i int, fingerprint string").repartition(5)
    for radius in (1, 3, 10):
        got = {x["i"]: x["n_near"] for x in simhash.with_near_counts(df, radius).collect()}
        assert got == {i: sum(apart(x, y) <= radius for y in prints) - 1 for i, x in enumerate(prints)}
    got = {x["i"]: x["n_near"] for x in simhash.with_near_counts(df).collect()}
    assert sum(got[i] > 0 for i in range(60)) >= 48
    assert simhash.with_near_counts(df.limit(0)).collect() == []


def test_archives(spark, tmp_path):
    rows = [(i, f"http://e/{i}\r\nX: y", f"<p>{'word ' * (i % 7)}</p>" * 20) for i in range(200)] + [(900, None, None), (901, "u", ""), (None, "u", "<p></p>" * 20), (902, "ü", "é" * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit(1)).repartition(3)
    files = warc.write_archives(df, f"file://{tmp_path}/w", roll=5000)
    assert files.count() > 1
    got = warc.read_archives(files).collect()
    assert len(got) == len(rows)
    low = {}
    for p, _, h in rows:
        if p is not None:
            low[h or ""] = min(low.get(h or "", p), p)
    by = {p: (h or "").encode() for p, _, h in rows}
    for x in got:
        raw, first = by[x["page_id"]], low[by[x["page_id"]].decode()]
        assert x["payload_bytes"] == len(raw) and x["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        if x["page_id"] == first:
            assert (x["record_type"], x["refers_to"], x["payload"]) == ("response", None, raw)
        else:
            assert (x["record_type"], x["refers_to"], x["payload"]) == ("revisit", first, None)
    assert warc.archived(df.limit(0)).collect() == []


def test_a_second_attempt_leaves_the_files_of_the_first(spark, tmp_path):
    """Attempts cut the same rows into files at other places; each index names whole files of its own."""
    df = spark.range(300).selectExpr("id AS page_id", "concat('u', id) AS url", "repeat(concat('p', id % 250, ' '), 50 + id) AS html")
    seen = []
    for rows in (df.orderBy("page_id"), df.orderBy(F.desc("page_id"))):
        index = warc.write_archives(rows, f"file://{tmp_path}/w", roll=2000)
        paths = [r["path"] for r in index.collect()]
        seen.append(paths)
        assert sorted(r["page_id"] for r in warc.read_archives(spark.createDataFrame([(p,) for p in paths], "path string")).collect()) == list(range(300))
    assert len(set(seen[0]) | set(seen[1])) == len(seen[0]) + len(seen[1])
    assert sorted(r["page_id"] for r in warc.read_archives(spark.createDataFrame([(p,) for p in seen[0]], "path string")).collect()) == list(range(300))


def brute(rows, k=10):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if i % 100 == 0:
            d = np.sqrt(((x - np.array(v)) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), d[j]) for j in order]
    return out


def test_nearest(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rows += [(10_000 + i, rows[7][1]) for i in range(60)]
    bad = [(20_000, None), (20_100, [0.0] * 64), (20_200, [float("nan")] * 64), (20_300, [None] * 64), (None, rows[0][1]), (20_400, [1.0])]
    df = spark.createDataFrame([(i, v, 5) for i, v in rows + bad], "vec_id long, embedding array<float>, part int")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 100 == 0, block=300).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = brute(rows)
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        found = [got[q][k] for k in sorted(got[q])]
        assert len(found) == 10 and found == sorted(found, key=lambda x: (x[1], x[0]))
        exact = dict(best)
        hits += sum(v in exact for v, _ in found)
    assert hits / (10 * len(want)) >= 0.9
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 2.0]), (2, [2.0, 2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, ann.search(few, F.col("vec_id") % 100 == 0).collect())) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert ann.search(few.limit(0), F.lit(True)).collect() == []


def exact(rows, query, k=10):
    out = []
    for q, a in rows:
        if query(q):
            best = sorted((float(np.sqrt(((np.array(v) - np.array(a)) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(a))[:k]
            out += [(q, n + 1, i, pytest.approx(d)) for n, (d, i) in enumerate(best)]
    return sorted(out, key=lambda x: x[:2])


@pytest.mark.parametrize("sizes", [[1e-200], [1e160], [1e300, 1e307], [1e-320, 1e-200, 1.0, 1e20, 1e160, 1e300]])
def test_magnitudes(spark, sizes):
    """Vectors whose squares run over or vanish are searched as others are; distances beyond the doubles are infinite."""
    r = np.random.default_rng(3)
    rows = [(i, (r.standard_normal(5) * sizes[i % len(sizes)]).tolist()) for i in range(240)] + [(900, [1e308] * 5), (901, [-1e308] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ann.search(df, F.col("vec_id") % 100 == 0, parts=1).collect()))
    want = []
    for q, a in rows:
        if q % 100 == 0:
            best = sorted((math.dist(a, v), i) for i, v in rows if i != q)[:10]
            want += [(q, n, d) for n, (d, _) in enumerate(best, 1)]
    assert [(q, n) for q, n, *_ in got] == [(q, n) for q, n, _ in sorted(want)]
    assert [x[3] for x in got] == pytest.approx([d for *_, d in sorted(want)], rel=1e-12, abs=0)
    assert len({x[:2] for x in map(tuple, ann.search(df, F.col("vec_id") % 100 == 0).collect())}) == len(want)


def test_parts_without_rows_or_queries(spark):
    r = np.random.default_rng(11)
    search = lambda rows, **more: sorted(map(tuple, ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0, **more).collect()))
    rows = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((199, 4)) + 6 * (np.arange(199) % 5)[:, None], start=1)]
    got = search(rows)  # one query, so most parts have none
    assert [x[:2] for x in got] == [(100, k) for k in range(1, 11)] and got[0] == exact(rows, lambda i: i == 100)[0]
    assert search([x for x in rows if x[0] != 100]) == []
    assert search(rows[:1]) == [] and search([(100, [1.0, 2.0])]) == []  # no other row
    for block in (3, 20_000):  # queries of two lengths, one of them without another row
        mixed = [*[x for x in rows if x[0] < 16], (100, [1.0, 2.0]), (0, [1.0] * 3), *((300 + i, [float(i), 1.0]) for i in range(12))]
        assert search(mixed, block=block) == exact(mixed, lambda i: i % 100 == 0)
    ties = [(i, [1.0, float(i > 12)]) for i in range(14)]
    assert search(ties) == exact(ties, lambda i: i == 0)


def test_repeated_query_rows_ask_once(spark):
    r = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((60, 4)))]
    rows += [rows[7], rows[7]]  # a repeated candidate
    several = [(200, [0.5, 0.0, 0.0, 0.0]), (200, [-0.5, 0.0, 0.0, 1.0])]
    query = lambda i: i % 100 == 0
    once = spark.createDataFrame([*rows, *several], "vec_id long, embedding array<double>")
    often = spark.createDataFrame([*rows, *several, *[rows[0]] * 30, *several * 3], "vec_id long, embedding array<double>")
    want = []
    for q in (0, 200):
        asked = [np.array(v) for i, v in [*rows, *several] if i == q]
        # the copies of a query row are candidates for the other query
        cands = [(i, np.array(v)) for i, v in [*rows, *several, *[rows[0]] * 30, *several * 3] if i != q]
        best = sorted((min(float(np.sqrt(((v - a) ** 2).sum())) for a in asked), i) for i, v in cands)[:10]
        want += [(q, k + 1, i, pytest.approx(d)) for k, (d, i) in enumerate(best)]
    for block in (1000, 9):
        assert sorted(map(tuple, ann.search(often, query(F.col("vec_id")), block=block).collect())) == want
    got = [tuple(x) for x in ann.search(once, query(F.col("vec_id"))).collect()]
    assert sorted(x[:2] for x in got) == [(q, k) for q in (0, 200) for k in range(1, 11)]


def test_blocks_of_rows_and_queries_change_nothing(spark):
    r = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(r.standard_normal((90, 4)))] + [(90 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(45)], "vec_id long, embedding array<double>")
    whole, cut = (sorted(map(tuple, ann.search(df, F.lit(True), block=n).collect())) for n in (1000, 20))
    assert len(whole) == 1350 and cut == whole


def test_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_languages(docs.where(~langid.held_out()))
    got = langid.predict_languages(docs, model).where(langid.held_out())
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98
    odd = spark.createDataFrame([(1, None, "a", 0.0), (2, "", "b", 0.0), (3, "123 !?", "c", 0.0), (None, "the of and", "d", 0.0), (4, "der die das " * 30_000, "e", 0.0)], "doc_id long, text string, `row` string, score double")
    rows = langid.predict_languages(odd, model).collect()
    assert [r["lang_pred"] for r in rows] == ["und", "und", "und", "en", "de"] and all(0 <= r["score"] <= 1 for r in rows) and rows[0]["row"] == "a"
    nothing = langid.fit_languages(docs.limit(0))
    assert [r["lang_pred"] for r in langid.predict_languages(odd, nothing).collect()] == ["und"] * 5


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = queries.toxicity_labels(spark, "/root/testdata/sf0.1")
    chain = toxicity.fit_toxicity(docs, labels.where("doc_id % 3 <> 0"), ["low_quality", "toxic"])
    out = toxicity.predict_toxicity(docs, chain).join(labels.withColumnRenamed("toxic", "label"), "doc_id").where("doc_id % 3 = 0")
    out = out.withColumn("hit", F.col("p_toxic") >= 0.5).withColumn("word", F.lower("text").rlike(r"\b(trash|pathetic|idiot|disgusting|worthless|stupid|clown|scum|loser|moron)\b"))
    n = {tuple(r)[:3]: r["count"] for r in out.groupBy("label", "word", "hit").count().collect()}
    assert n.get((0, False, True), 0) == 0  # clean documents are left alone
    assert n[1, True, True] >= 0.9 * (n[1, True, True] + n.get((1, True, False), 0))
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "you idiot, you moron"), (3, "fine words " * 50_000)], "doc_id long, text string").withColumn("row", F.lit(1))
    p = [r["p_toxic"] for r in toxicity.predict_toxicity(odd, chain).collect()]
    assert p[0] == p[1] < 0.5 < p[2] and p[3] < 0.5
    assert toxicity.predict_toxicity(odd.limit(0), chain).collect() == []
    none = toxicity.fit_toxicity(docs, labels.limit(0), ["toxic"])
    assert {r["p_toxic"] < 0.5 for r in toxicity.predict_toxicity(odd, none).collect()} == {True}


def test_linear_models_reach_their_optimum():
    r = np.random.default_rng(2)
    x = r.standard_normal((80, 3))
    y = (x @ [1.0, -2.0, 0.5] + r.standard_normal(80) > 0.7).astype(float)
    s, share = 2 * y - 1, y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    hinge = lambda w: (weight * np.maximum(0, 1 - s * (x @ w[:3] + w[3])) ** 2).mean() + 0.005 * (w[:3] ** 2).sum()
    log = lambda w: np.logaddexp(0, -s * (x @ w[:3] + w[3])).mean() + 0.005 * (w[:3] ** 2).sum()
    for f, w in ((hinge, linear.fit_svm(x, s, 1e-2, 4000)), (log, linear.fit_logistic(x, y, 1e-2, 4000))):
        for i in range(4):
            d = np.eye(4)[i] * 1e-4
            assert abs(f(w + d) - f(w - d)) / 2e-4 < 1e-3


def test_language_by_brute_force(spark):
    """Shares of hashed byte n-grams, pairwise SVMs and their votes, family first, in plain loops."""
    r = random.Random(1)
    vocab = {"de": "der die und nicht schön", "en": "the and of not nice", "nl": "de het en niet mooi", "fr": "le la et pas été", "xx": "qa qo qi qu qe"}
    rows = [(i, " ".join(r.choice(vocab[c].split() + ["a", "o"]) for _ in range(r.randrange(1, 30))), c) for i, c in enumerate(r.choices(list(vocab), k=150))]
    df = spark.createDataFrame([*rows, *rows[:9], (900, None, "de"), (901, "und", None)], "doc_id long, text string, lang string")

    def vector(text):
        b, x = b" " + text.lower().encode() + b" ", [0.0] * 2048
        for i in range(len(b) - 1):
            x[((b[i] * 256 + b[i + 1]) * 2654435761 % 2**32) >> 22] += 1 / len(b)
        for i in range(len(b) - 2):
            x[1024 + (((b[i] * 65536 + b[i + 1] * 256 + b[i + 2]) * 2246822519 % 2**32) >> 22)] += 1 / len(b)
        return np.sqrt(x).astype(np.float32)

    x, lang = np.stack([vector(t) for _, t, _ in rows]), np.array([c for *_, c in rows])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][2], i))
    x_fit, lang_fit = x[order], lang[order]
    family = {"de": "germanic", "en": "germanic", "nl": "germanic", "fr": "romance", "xx": "xx"}

    def choose(names, of, v):
        wins, p = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        for a, b in combinations(names, 2):
            own = np.isin(of, [a, b])
            w = fitted.setdefault((a, b), linear.fit_svm(x_fit[own], np.where(of[own] == a, 1.0, -1.0)))
            q = 1 / (1 + math.exp(-3 * float(v @ w[:-1] + w[-1])))
            wins[a if q >= 0.5 else b] += 1
            p[a] += q
            p[b] += 1 - q
        mean = {n: p[n] / max(1, len(names) - 1) if len(names) > 1 else 1.0 for n in names}
        best = max(names, key=lambda n: wins[n] + mean[n] / 2)
        return best, mean[best]

    fitted, families = {}, np.array([family[c] for c in lang_fit])
    got = {x["doc_id"]: x for x in langid.predict_languages(df, langid.fit_languages(df)).collect()}
    hits = 0
    for (i, _, c), v in zip(rows, x):
        f, p = choose(["germanic", "romance", "xx"], families, v)
        name, q = choose([n for n in sorted(family) if family[n] == f], lang_fit, v)
        assert got[i]["lang_pred"] == name and got[i]["score"] == pytest.approx(p * q, abs=2e-3)
        hits += name == c
    assert hits >= 0.9 * len(rows) and got[900]["lang_pred"] == "und"
    one = langid.fit_languages(df, max_langs=1)
    assert one.langs == [Counter(c for *_, c in rows).most_common(1)[0][0]]
    assert langid.predict_languages(df.limit(0), one).collect() == []
    named = langid.predict_languages(df.withColumn("score", F.lit("mine")), one, "l", "s").first()
    assert named["score"] == "mine" and named["l"] == one.langs[0]
    assert len(langid.fit_languages(df, max_rows=15).langs) == 5


def test_toxicity_chain_by_brute_force(spark):
    """Document frequencies, z-scores, out-of-fold probabilities and the chain in plain loops."""
    r = random.Random(6)
    docs, labels = [], []
    for i in range(160):
        rude, odd = r.random() < 0.4, r.random() < 0.5
        w = [r.choice("fine good day river stone walk".split()) for _ in range(r.randrange(3, 20))] + ["bad"] * (2 * rude) + ["zz"] * odd
        r.shuffle(w)
        docs.append((i, ", ".join(w)))
        labels.append((i, int(odd), int(rude)))
    labels += [(3, 0, 0), (None, 1, 1), (999, 1, 1)]
    df, lf = spark.createDataFrame([*docs, docs[5], (5, "zzz later")], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, odd int, rude int")
    slot = {}
    for _, t in docs:
        for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t):
            slot[w] = int(toxicity._hashed(pa.record_batch({"text": [w]}))[0][0])
    bags = [Counter(slot[w] for w in re.findall(r"\w+", t)) for _, t in docs]
    y = np.array([x[1:] for x in labels[:160]], float)
    fold = [(d * 2654435761 >> 7) % 5 for d, _ in docs]

    def terms(rows, label):
        n1, n0, found = sum(label[i] for i in rows), sum(1 - label[i] for i in rows), []
        for s in sorted(set(slot.values())):
            a, b = (sum(s in bags[i] for i in rows if label[i] == v) for v in (1, 0))
            p = (a + b) / (n0 + n1)
            z = (a / n1 - b / n0) / math.sqrt(max(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
            if p and abs(z) >= 5:
                found.append(s)
        return found

    def features(found, before):
        return np.array([[math.sqrt(100 * bag[s] / sum(bag.values())) for s in found] + list(b) for bag, b in zip(bags, before)])

    every, before_fit, before, want = range(160), [()] * 160, [()] * 160, []
    for k in range(2):
        oof = [0.0] * 160
        for f in range(5):
            rows, out = ([i for i in every if (fold[i] == f) == side] for side in (False, True))
            x = features(terms(rows, y[:, k]), before_fit)
            w = linear.fit_logistic(x[rows], y[rows, k], 1e-3)
            for i in out:
                oof[i] = 1 / (1 + math.exp(-float(x[i] @ w[:-1] + w[-1])))
        found = terms(every, y[:, k])
        w = linear.fit_logistic(features(found, before_fit), y[:, k], 1e-3)
        p = [1 / (1 + math.exp(-float(v @ w[:-1] + w[-1]))) for v in features(found, before)]
        want.append(p)
        before_fit, before = [(*b, q) for b, q in zip(before_fit, oof)], [(*b, q) for b, q in zip(before, p)]
    chain = toxicity.fit_toxicity(df, lf, ["odd", "rude"])
    got = toxicity.predict_toxicity(df.limit(160), chain).collect()
    for x in got:
        assert (x["p_odd"], x["p_rude"]) == (pytest.approx(want[0][x["doc_id"]], abs=1e-6), pytest.approx(want[1][x["doc_id"]], abs=1e-6))
    assert len(got) == 160
    few = toxicity.fit_toxicity(df, lf, ["odd", "rude"], max_rows=20)
    assert all(0 <= x["p_rude"] <= 1 for x in toxicity.predict_toxicity(df, few).collect())


def test_small_payloads_are_all_responses(spark, tmp_path):
    rows = [(3, "u", "aa"), (1, "u", "aa"), (2, "u", "bbbb"), (9, "u", "bbbb"), (9, "u", "bbbb"), (2, "u", "bbbb"), (4, "u", None), (5, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(df, f"file://{tmp_path}/w", min_bytes=3, sample_chars=2)).collect()
    assert sorted((x["page_id"], x["record_type"], x["refers_to"]) for x in got) == sorted([(3, "response", None), (1, "response", None), (2, "response", None), (2, "response", None), (9, "revisit", 2), (9, "revisit", 2), (4, "response", None), (5, "response", None)])
