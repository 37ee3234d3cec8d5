"""The pipeline's stages on small tables, against plain Python, with the columns that its helpers would like to have."""

import random
import re
from collections import defaultdict

import corpus_pipeline as P
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from .test_ngram_join import brute

EXTRA = "`_key` long, p_toxic string, score string, lang_pred string, component_id string, `row` string, n_chars int"
SCHEMA = f"doc_id long, text string, lang string, source string, {EXTRA}"


def rows(docs, lang="en"):
    return [(d, t, lang, "s", i, "mine", "my score", "my lang", "c", "r", 1) for i, (d, t) in enumerate(docs)]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A corpus with labels: rude texts are toxic, and every third document has no lang."""
    r, out = random.Random(3), str(tmp_path_factory.mktemp("sf"))
    vocab = {"en": "the and of river stone walking not nice was green".split(), "de": "der die und nicht schön war grün gegangen".split()}
    docs, labels = [], []
    for i in range(240):
        lang = r.choice(["en", "de"])
        w = [r.choice(vocab[lang]) + str(r.randrange(50)) * (r.random() < 0.5) for _ in range(r.randrange(8, 60))]
        rude = r.random() < 0.25
        if rude:
            w[1] = w[4] = w[6] = "moron"
        labels.append((i, 1, int(rude)))
        docs.append((i, " ".join(w), lang if i % 3 else None, "s", i, "mine", "a", "b", "c", "r", 1))
    docs += [(1000 + d, t, *more) for d, t, *more in docs[:20]]
    docs += [docs[30], docs[31], *rows([(None, "the river was green and nice"), (2000, None), (2001, ""), (2002, "123 !"), (2003, "of the river stone " * 3000)])]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def test_drop_toxic(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = P.drop_toxic(spark, docs, sf)
    assert out.columns == docs.columns
    want = [tuple(x) for x in docs.collect() if "moron" not in (x["text"] or "")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert P.drop_toxic(spark, docs.limit(0), sf).collect() == []


def test_keep_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = P.keep_languages(spark, docs, sf)
    assert out.columns == docs.columns
    want = [tuple(x) for x in docs.collect() if re.search(r"[^\W\d_]", x["text"] or "")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert P.keep_languages(spark, unlabelled, sf).count() == len(want)
    assert P.keep_languages(spark, docs.limit(0), sf).collect() == []


def test_drop_near_copies(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = P.drop_near_copies(spark, docs, sf)
    assert out.columns == docs.columns
    pairs = sorted({(x["doc_id"], x["text"]) for x in docs.collect()}, key=lambda x: (x[0] is None, x[0], str(x[1])))
    # classes of rows by number, so that null and repeated ids are rows of their own
    classes = {n: c for n, _, c in brute([(n, t) for n, (_, t) in enumerate(pairs)])}
    want = [pairs[n] for n in sorted(set(classes.values()))]
    assert sorted(((x["doc_id"], x["text"]) for x in out.collect()), key=str) == sorted(want, key=str)
    assert all(x["p_toxic"] == "mine" and x["_key"] is not None and x["_key"] < 1000 for x in out.collect())
    assert P.drop_near_copies(spark, docs.limit(0), sf).collect() == []


def test_run(spark, sf):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = docs
    for _, stage in P.STAGES[:3]:
        steps = spark.createDataFrame(stage(spark, steps, sf).collect(), docs.schema)
    tok, n = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), defaultdict(list)
    for x in steps.collect():
        n[x["doc_id"]].append(len(tok.encode(x["text"], add_special_tokens=False).ids) + 1)
    got = defaultdict(int)
    for x in P.run(spark, sf).collect():
        got[x["doc_id"]] += x["length"]
    assert dict(got) == {d: sum(x) for d, x in n.items()} and len(got) > 100


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2)], "P_x int, __key int")
    assert P.free_name(df, "p_") == "_p_" and P.free_name(df, "_key") == "_key" and P.free_name(df, "score") == "score"
