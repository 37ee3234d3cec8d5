"""License scans against plain Python, and their SQL."""

import random
import re
from string import ascii_lowercase, ascii_uppercase

import pytest

from fieldspark.llm.license_scan import NOTICES, PHRASES, Template, hits, license_scan, spans, template_runs

LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    w, at, labels = words(text), [], set()
    for x in PHRASES:
        y = x.text.split()
        for i in range(len(w) - len(y) + 1):
            if w[i : i + len(y)] == y:
                at.append(i)
                labels.add(x.label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def places(text, templates, slack):
    """(template, begin, share) of the verified places of notices, by plain loops."""
    w, out = words(text), set()
    for n, x in enumerate(templates):
        y, at = x.text.split(), {}
        for p in range(len(w) - 3):
            for t in range(len(y) - 3):
                if w[p : p + 4] == y[t : t + 4]:
                    at.setdefault(p - t, []).append((p, t))
        group, last = [], None
        for d in [*sorted(at), None]:
            if group and (d is None or d - last > slack):
                covered = len({t + i for _, t in group for i in range(4)})
                share = covered / max(len(y), max(p + 4 for p, _ in group) - min(p for p, _ in group))
                if share >= x.least:
                    out.add((n, min(p for p, _ in group), share))
                group = []
            if d is not None:
                group, last = group + at[d], d
    return out


@pytest.fixture(scope="module")
def texts():
    rng, out = random.Random(3), []
    bits = ["mit", "License", "MIT LICENSE", "cc", "BY", "CC-BY", "apache", "gnu general public", "gnu", "general", "license", "x", "é", "İ", "\n", "—", "2", "cc by cc by", "apache_license", "a.b"]
    for _ in range(200):
        out.append("".join(rng.choice(bits) + rng.choice([" ", "-", ", ", "; ", "\x7f", "", "\x00"]) for _ in range(rng.randint(0, 25))))
    for x in NOTICES:
        y = x.text.split()
        for _ in range(4):
            z = list(y)
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(z))
                z[i : i + rng.randint(0, 1)] = rng.choice([[], ["zz"], ["zz", "yy"]])
            out.append(" ".join(["some", "text", *z, "and", *rng.choice([[], y]), "more"]))
    return [*out, "mit license " * 5000, "the " * 20000 + "MIT License", " ".join(NOTICES[0].text.split()[:5])]


def test_matches_brute_force(spark, texts):
    docs = spark.createDataFrame([(i, t, 1, "l") for i, t in enumerate(texts)], "doc_id long, text string, row int, label string").repartition(3)
    got = {r["doc_id"]: r for r in license_scan(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, count, first, last, labels = base(t)
        found, r = places(t, NOTICES, 4), got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n, count, first, last, labels), t[:200]
        every = {x for x in labels.split(",") if x} | {NOTICES[k].label for k, _, _ in found}
        assert r["labels"] == ",".join(sorted(every)) and r["score"] == (1.0 if count else max((s for *_, s in found), default=0.0)), t[:200]


def test_places_of_notices(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in spans(hits(docs, NOTICES)).where("template is not null").collect():
        got.setdefault(r["doc_id"], set()).add((r["template"], r["begin"], r["share"]))
    assert got == {i: f for i, t in enumerate(texts) if (f := places(t, NOTICES, 4))}


def test_nulls_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "MIT license"), (None, "MIT license"), (2, "...")], "doc_id int, text string")
    got = sorted((tuple(r) for r in license_scan(docs).collect()), key=str)
    none = lambda i: (i, 0, 0, None, None, "", "", 0.0)
    assert got == sorted([none(1), none(1), none(2), *[(None, 2, 1, 0, 0, "mit", "mit", 1.0)] * 2], key=str)
    assert license_scan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        template_runs(spark, (Template("x", "one", True),))


def test_no_python_and_one_shuffle(spark):
    plan = license_scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_sql_says_the_same(spark):
    import duckdb

    from fieldspark.llm.queries import ORACLE, QUERIES

    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    got = QUERIES["op12_license_scan"](spark, folder)
    assert sorted(map(tuple, got.collect())) == sorted(db.sql(ORACLE["op12_license_scan"]).select(", ".join(got.columns)).fetchall())
