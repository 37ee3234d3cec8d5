"""Approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is cut into balanced parts (recursive bisection at the median of a smooth graph
signal), and a small neural network learns to tell a vector's part. All rows are indexed under their most probable
part; a query visits its most probable parts, as many as reach the wanted recall on held-out sample rows, and what it
finds there is ranked by exact distances.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import hashed_sample, shared_dir, stored


#: Magnitudes between which squares neither run over nor vanish; other vectors are scaled before they are squared.
PLAIN = (1e-100, 1e100)


def unit_of(*arrays: np.ndarray) -> float:
    """What the arrays are divided by so that their squares can be told: 1 unless their largest component is beyond PLAIN."""
    most = max((float(np.abs(a).max()) for a in arrays if a.size), default=0.0)
    return 1.0 if most == 0 or PLAIN[0] <= most <= PLAIN[1] else most


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x from q; infinite where the distance itself is no double."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        apart = x - q
        out = np.sqrt((apart**2).sum(1))
        odd = np.flatnonzero(~((out > PLAIN[0]) & (out < np.inf)))
        if len(odd):
            most = np.abs(apart[odd]).max(1, initial=0)
            fine = (most > 0) & (most < np.inf)
            out[odd] = np.where(fine, most * np.sqrt(((apart[odd] / np.where(fine, most, 1)[:, None]) ** 2).sum(1)), most)
    return out


def nearest_lists(x: np.ndarray, y: np.ndarray, k: int, own: bool) -> np.ndarray:
    """The k rows of y nearest to each row of x (own: row i is not its own neighbour)."""
    out = np.empty((len(x), k), np.int64)
    sq = (y * y).sum(1)
    for lo in range(0, len(x), 512):
        d = sq[None, :] - 2 * x[lo : lo + 512] @ y.T
        if own:
            d[np.arange(d.shape[0]), np.arange(lo, lo + d.shape[0])] = np.inf
        out[lo : lo + 512] = np.argpartition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else np.argsort(d, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Parts of equal size (to one row) of a neighbour graph: each half at the median of a signal smoothed over edges."""
    rng = np.random.default_rng(seed)
    part = np.zeros(len(graph), np.int64)

    def halve(rows: np.ndarray, first: int, count: int) -> None:
        if count == 1 or len(rows) < 2:
            part[rows] = first
            return
        where = np.full(len(graph), -1)
        where[rows] = np.arange(len(rows))
        to = where[graph[rows]]
        a, b = np.nonzero(to >= 0)
        b = to[a, b]
        degree = np.bincount(a, minlength=len(rows)) + np.bincount(b, minlength=len(rows)) + 1.0
        s = rng.standard_normal(len(rows))
        for _ in range(60):
            s = s - (s * degree).sum() / degree.sum()
            s = (s + np.bincount(a, s[b], len(rows)) + np.bincount(b, s[a], len(rows))) / degree
            s /= np.abs(s).max() + 1e-300
        left = count // 2
        order = np.argsort(s, kind="stable")
        cut = len(rows) * left // count
        halve(rows[order[:cut]], first, left)
        halve(rows[order[cut:]], first + left, count - left)

    halve(np.arange(len(graph)), 0, parts)
    return part


class Router:
    """A network of one hidden layer: probabilities of parts for vectors. Small: goes to the tasks with the code."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 24, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std() + 1e-12
        d, m = x.shape[1], target.shape[1]
        p = [rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden), rng.standard_normal((hidden, m)) * np.sqrt(1 / hidden), np.zeros(m)]
        first, second, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
        z = (x - self.mean) / self.scale
        for e in range(epochs):
            order = rng.permutation(len(z))
            for lo in range(0, len(z), 256):
                b = order[lo : lo + 256]
                h = np.maximum(z[b] @ p[0] + p[1], 0)
                o = h @ p[2] + p[3]
                o = np.exp(o - o.max(1, keepdims=True))
                g = (o / o.sum(1, keepdims=True) - target[b]) / len(b)
                gh = (g @ p[2].T) * (h > 0)
                t += 1
                for i, w in enumerate((z[b].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                    w = w + 1e-4 * p[i]
                    first[i] = 0.9 * first[i] + 0.1 * w
                    second[i] = 0.999 * second[i] + 0.001 * w * w
                    p[i] -= 3e-3 * (1 - e / epochs) * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
        self.p = [w.astype(np.float32) for w in p]

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, most probable first."""
        h = np.maximum(((x - self.mean) / self.scale).astype(np.float32) @ self.p[0] + self.p[1], 0)
        return np.argsort(-(h @ self.p[2] + self.p[3]), axis=1, kind="stable")


class Index:
    """router, parts, probes, dim; sample_recall: of ``probes`` parts on the held-out rows of the sample."""

    def __init__(self, x: np.ndarray, parts: int, k: int, recall: float):
        """parts: at most so many, and at most a sixteenth of the rows of x, so that each is learned from 16 rows or more."""
        held = max(1, len(x) // 8)
        self.unit = unit_of(x)
        x = x / self.unit
        q, x = x[:held], x[held:] if len(x) > held else x
        self.dim, near = x.shape[1], min(k, max(1, len(x) - 1))
        parts = max(1, min(parts, len(x) // 16))
        graph = nearest_lists(x, x, near, True) if len(x) > 1 else np.zeros((len(x), 0), np.int64)
        part = balanced_parts(graph, parts)
        eye = np.eye(parts)
        target = 0.5 * eye[part] + 0.5 * (eye[part[graph]].mean(1) if graph.shape[1] else eye[part])
        self.parts, self.router = parts, Router(x.astype(np.float64), target)
        of = self.router.order(x)[:, 0]
        want = of[nearest_lists(q, x, min(k, len(x)), False)]
        ranks = np.argsort(self.router.order(q), axis=1)
        found = np.take_along_axis(ranks, want, axis=1)
        reach = np.array([(found < p).mean() for p in range(1, parts + 1)])
        good = np.flatnonzero(reach >= recall)
        self.probes = int(good[0]) + 1 if len(good) else parts
        self.sample_recall = float(reach[self.probes - 1])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>): rows that take part: no null id, vector or component, all finite, not all zero."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).where("vec_id is not null and v is not null")
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    return rows.where(F.coalesce(good, F.lit(False)))


def fit_index(rows: DataFrame, sample: int = 12_000, parts: int = 0, k: int = 10, recall: float = 0.97) -> Index | None:
    """An index for rows of usable(), from the ``sample`` rows with the smallest hashes of vec_id. None without rows.

    It is learned for the most common length of vectors. parts 0: about one for 2,000 rows, 4 to 1,024. At most a
    sixteenth of the sample are made, so a table of more than 125 * ``sample`` rows wants a larger sample.
    """
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return None
    got = hashed_sample(rows.where(F.size("v") == sizes["dim"]), sample, "vec_id").select("v").collect()
    x = np.unique(np.array([r["v"] for r in got], np.float64), axis=0)
    x = x[np.random.default_rng(7).permutation(len(x))]
    parts = parts or min(1024, max(4, 1 << round(np.log2(max(1, sizes["count"] / 2000)))))
    return Index(x, parts, k, recall)


def _routed(index: Index, most: int):
    """Rows (vec_id, v) -> a row for each of their ``most`` likeliest parts. A vector of another length goes to the part -length."""

    def run(batches):
        for b in batches:
            ids, lists = b.column("vec_id").to_numpy(), b.column("v")
            size = lists.value_lengths().to_numpy()
            for d in np.unique(size):
                own = np.flatnonzero(size == d)
                x = lists.take(pa.array(own)).flatten().to_numpy().reshape(len(own), d)
                order = index.router.order(np.clip(x / index.unit, -1e12, 1e12))[:, :most] if d == index.dim else np.full((len(own), 1), -d)
                n, raw = order.shape[1], [r.tobytes() for r in x]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[own], n)), pa.array(order.reshape(-1).astype(np.int32)), pa.array([r for r in raw for _ in range(n)], pa.binary())], ["vec_id", "part", "v"])

    return run


def _rank(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_r, out_v, out_d = [], [], [], []
        if rows.num_rows and queries.num_rows:
            ids, row_id, qid = (t.column(c).to_numpy() for t, c in ((rows, "vec_id"), (rows, "row"), (queries, "query_id")))
            x, q = (np.frombuffer(b"".join(t.column("v").to_pylist()), np.float64).reshape(t.num_rows, -1) for t in (rows, queries))
            unit = unit_of(x, q)
            near_x, near_q = x / unit, q / unit
            sq = (near_x * near_x).sum(1)
            for lo in range(0, len(q), 128):
                part, small = q[lo : lo + 128], near_q[lo : lo + 128]
                own = (small * small).sum(1)
                d = sq[None, :] - 2 * small @ near_x.T + own[:, None]
                for i in range(len(part)):
                    row = d[i]
                    other = ids != qid[lo + i]
                    row[~other] = np.inf
                    least = np.partition(row, k - 1)[k - 1] if len(row) > k else np.inf
                    near = np.flatnonzero((row <= least + 1e-9 * (own[i] + sq.max()) + 1e-300) & other)
                    exact = distances(x[near], part[i])
                    best = np.lexsort((row_id[near], ids[near], exact))[:k]
                    out_q += [qid[lo + i]] * len(best)
                    out_r += row_id[near[best]].tolist()
                    out_v += ids[near[best]].tolist()
                    out_d += exact[best].tolist()
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "row": pa.array(out_r, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_d, pa.float64())})

    return run


def _sizes(rows: DataFrame, block: int, name: str) -> DataFrame:
    """(part, name): in how many blocks of about ``block`` rows each part is searched."""
    return rows.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias(name))


def search(vectors: DataFrame, is_query: Column, k: int = 10, block: int = 20_000, **fit) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id of query rows of vectors (vec_id, embedding) the k nearest other rows found.

    score is the Euclidean distance in double precision of the original vectors; ties go to the smaller vec_id. Rows
    that usable() leaves out are neither queries nor candidates. Vectors of different lengths have no distance: a query's
    candidates are those of its own length, all of them if that is not the most common one. A row is no
    candidate for a query of its own vec_id; repeated rows are candidates of their own. A query row that is repeated asks
    once. Different vectors under one vec_id are one query: each of them is searched, and a candidate's score is its
    distance to the nearest of them, so that a query_id has at most k result rows and each candidate row is one. A query whose parts hold fewer than
    k candidates is searched in all parts; with fewer candidates than k in all, all of them come. Vectors of any finite magnitude are told apart; where a distance itself is beyond the doubles
    its score is infinite. Parts of more than ``block`` rows, or of more than ``block`` queries, are searched in
    blocks of rows by blocks of queries, so that neither meet in one task without a bound. An empty table gives an
    empty table.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(vectors)
    index = fit_index(rows, k=k, **fit)
    if index is None:
        return empty
    folder = shared_dir(spark, "ann")
    routed = lambda df, most: df.mapInArrow(_routed(index, most), "vec_id long, part int, v binary")
    kept = stored(routed(rows, 1).withColumn("row", F.monotonically_increasing_id()), f"{folder}/rows")
    queries = rows.where(is_query).distinct()
    found = stored(_found(kept, stored(routed(queries, index.probes).withColumnRenamed("vec_id", "query_id"), f"{folder}/asked"), k, block, f"{folder}/sizes"), f"{folder}/found")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = stored(routed(queries.join(full, "vec_id", "left_anti"), index.parts).withColumnRenamed("vec_id", "query_id"), f"{folder}/short")
    if short.isEmpty():
        return found
    rest = _found(kept, short, k, block, f"{folder}/short_sizes")
    return found.join(short.select("query_id").distinct(), "query_id", "left_anti").union(rest)


def _found(kept: DataFrame, asked: DataFrame, k: int, block: int, path: str) -> DataFrame:
    """The k nearest of kept (vec_id, part, v, row) for each query_id of asked (query_id, part, v), of its parts."""
    sizes = stored(_sizes(kept, block, "of").join(_sizes(asked, block, "to"), "part"), path)  # parts with rows and queries
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = kept.join(sizes, "part").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), "of").cast("int")).withColumn("q_block", every("to")).drop("of", "to")
    asked = asked.join(sizes, "part").withColumn("q_block", F.pmod(F.xxhash64("query_id", "v"), "to").cast("int")).withColumn("block", every("of")).drop("of", "to")
    near = kept.groupBy("part", "block", "q_block").cogroup(asked.groupBy("part", "block", "q_block")).applyInArrow(_rank(k), "query_id long, row long, vec_id long, score double")
    near = near.groupBy("query_id", "row").agg(F.first("vec_id").alias("vec_id"), F.min("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
