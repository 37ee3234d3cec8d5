"""Hard negatives against plain integers, and their SQL."""

import random
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.llm.hard_negatives import HIGH, LOW, Packed, hard_negatives, quantised, shifted_label

SCHEMA = "vec_id long, label int, embedding array<double>"


def ints(v):
    return [floor(256 * x) if isfinite(256 * x) else int(x) * 256 for x in v]


def brute(rows, every, kp=5, kn=10):
    """rows: (vec_id, label, vector) -> {(anchor, positive, rank, negative, score, score)}, of rows in input order."""
    good = [(i, lab, ints(v)) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    out, asked = [], set()
    for i, lab, v in good:
        if i % every or (i, lab, tuple(v)) in asked:
            continue
        asked.add((i, lab, tuple(v)))
        found = [(-min(max(sum(a * b for a, b in zip(v, w)), LOW), HIGH), j, n, other == lab) for n, (j, other, w) in enumerate(good) if j != i and len(w) == len(v)]
        for s, j, _, _ in sorted(f for f in found if f[3])[:kp]:
            near = sorted(f for f in found if not f[3] and -30 * s <= -100 * f[0] <= -90 * s)[:kn]
            out += [(i, j, r, k, -s, -t) for r, (t, k, _, _) in enumerate(near, 1)]
    return sorted(out)


def got(df, every, **how):
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % every == 0, **how).collect()))


@pytest.mark.parametrize("block, by", [(7, 2), (50, 3), (4096, 2048)])
def test_matches_brute_force(spark, block, by):
    rng = random.Random(block)
    centre = {c: [rng.gauss(0, 1) for _ in range(6)] for c in range(4)}
    rows = []
    for i in range(240):
        c = 0 if i % 3 else i % 4  # one label holds most rows
        rows.append((i, c, [x + rng.gauss(0, 0.7) for x in centre[i % 4]]))
    rows += [(300 + i, i % 3, [float(x) for x in rng.choices([-1, 0, 1, 0.5], k=6)]) for i in range(60)]  # ties
    rows += [(400 + i, 1, rows[7][2]) for i in range(40)]  # copies under other ids
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", row string, anchor int").coalesce(1)
    want = brute(rows, 10)
    assert len(want) > 500 and got(df, 10, block=block, anchor_block=by) == want


def test_rows_that_take_no_part_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    base = [(i, i % 2, [1.0 + i % 5, -0.5, 0.3 * i]) for i in range(20)]
    odd = [(100, None, [1.0, 1, 1]), (101, 1, None), (102, 0, [1.0, None, 1]), (103, 0, [nan, 1.0, 1]), (104, 1, [1.0, inf, 1]), (None, 1, [9.0, 9, 9]), (110, 0, [1.0, 2]), (111, 1, [1.0, 1]), (120, 0, []), (121, 0, []), (122, 1, []), (130, 0, [0.0, 0, 0])]
    rows = base + odd + base[:6] + [(10, 0, [3.0, 1, 1])]  # repeated rows; another vector under an anchor's id
    rows = [(i, lab, v and [x if x is None else float(x) for x in v]) for i, lab, v in rows]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert got(df, 10) == brute(rows, 10)
    assert got(df.limit(0), 10) == [] and got(df.where("vec_id % 10 <> 0"), 10) == []


def test_large_and_small_magnitudes(spark):
    rng = random.Random(2)
    rows = [(i, i % 3, [rng.uniform(-1, 1) * s for _ in range(3)]) for i, s in enumerate([1e-200, 1e-3, 1, 1e5, 2.0**44, 1e9, 1e20, 1e155, 1e307] * 5)]
    assert got(spark.createDataFrame(rows, SCHEMA).coalesce(1), 5) == brute(rows, 5)


def test_packed_products_are_exact():
    rng = random.Random(4)
    for size in (1, 100, 2**20, 2**40, 2**70):
        x = np.array([[rng.randint(-size, size) for _ in range(5)] for _ in range(33)], np.int64 if size < 2**60 else object)
        for bias in (0, size, -3 * size):
            a = [rng.randint(-size, size) for _ in range(5)]
            want = [min(max(sum(int(u) * v for u, v in zip(r + bias, a)), LOW), HIGH) for r in x]
            assert Packed(x + bias, max(map(abs, a))).scores(a).tolist() == want
    assert quantised([np.array([0.1, -0.1, 1e308])]).tolist() == [[25, -26, int(1e308) * 256]]
    assert Packed(np.zeros((0, 3), np.int64), 5).scores([1, 2, 3]).tolist() == [] and Packed(np.zeros((2, 0), np.int64), 0).scores([]).tolist() == [0, 0]


def test_sql_says_the_same(spark):
    import duckdb

    from fieldspark.llm.queries import ORACLE, QUERIES

    folder = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    out = QUERIES["op13_hard_negatives"](spark, folder)
    rows = sorted(map(tuple, out.collect()))
    assert rows and rows == sorted(db.sql(ORACLE["op13_hard_negatives"]).select(", ".join(out.columns)).fetchall())


def test_shifted_label(spark):
    df = spark.createDataFrame([(7, 9), (14, 3), (8, 9), (0, None)], "vec_id long, label int")
    assert [r[0] for r in df.select(shifted_label()).collect()] == [0, 4, 9, None]
