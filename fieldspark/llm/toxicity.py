"""Toxicity by classifier chains: each category's linear model also sees the probabilities of the categories before it.

Those are out-of-fold predictions while training, so that a later model learns from probabilities as good as it will
meet. Features are the rates of telling words: of hashed words, those whose document frequencies differ most between
a category's rows and the others. Training rows are a bounded sample of the labelled ones; every row is predicted, by
its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import U, buffers, slices, words
from .linear import fit_logistic, sigmoid
from .store import hashed_sample
from .worker import tidy

BITS = 18
_SPLIT = np.ones(256, bool)
_SPLIT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _hashed(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, off = buffers(b.column("text"))
    h, doc, _, _ = words(data, off, space=_SPLIT)
    return (h & U((1 << BITS) - 1)).astype(np.int64), doc


def _rates(slot: np.ndarray, doc: np.ndarray, n: int, terms: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """Square roots of the percentages of a text's words that are each of the terms. times: how often each slot stands there."""
    where = np.full(1 << BITS, -1, np.int32)
    where[terms] = np.arange(len(terms))
    at = where[slot]
    hit = at >= 0
    x = np.bincount(doc[hit] * len(terms) + at[hit], None if times is None else times[hit], n * len(terms)).reshape(n, len(terms)) if len(terms) else np.zeros((n, 0))
    return np.sqrt(100 * x / np.maximum(1, np.bincount(doc, times, n))[:, None])


class ToxicityChain:
    """The fitted models: categories in chain order, the telling terms of each, and its weights."""

    def __init__(self, categories: list[str], folds: int = 5, terms: int = 256, least: float = 5.0, l2: float = 1e-3):
        self.categories, self.folds, self.terms, self.least, self.l2 = categories, folds, terms, least, l2
        self.picked: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []

    def _pick(self, has: list[np.ndarray], y: np.ndarray) -> np.ndarray:
        """Terms by the z-score of their document frequency in the category's rows against the others."""
        df = np.zeros((2, 1 << BITS))
        for slots, label in zip(has, y):
            df[int(label), slots] += 1
        n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())
        p = (df[0] + df[1]) / (n0 + n1)
        z = (df[1] / n1 - df[0] / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
        z[p == 0] = 0
        best = np.argsort(-np.abs(z), kind="stable")[: self.terms]
        return np.sort(best[np.abs(z[best]) >= self.least])

    def fit(self, slots: list[np.ndarray], times: list[np.ndarray], y: np.ndarray, fold: np.ndarray) -> ToxicityChain:
        """slots, times: each text's different hashed words and their counts; y: rows by categories, 0 or 1; fold: each row's fold."""
        flat, often = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (slots, times))
        doc = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
        before = np.zeros((len(slots), 0))
        for k in range(len(self.categories)):
            label = y[:, k].astype(float)
            oof = np.full(len(label), label.mean() if len(label) else 0.0)
            for f in np.unique(fold):
                rows, out = fold != f, fold == f
                if 0 < label[rows].sum() < rows.sum():
                    t = self._pick([h for h, r in zip(slots, rows) if r], label[rows])
                    x = np.hstack([_rates(flat, doc, len(slots), t, often), before])
                    w = fit_logistic(x[rows], label[rows], self.l2)
                    oof[out] = sigmoid(x[out] @ w[:-1] + w[-1])
            t = self._pick(slots, label) if 0 < label.sum() < len(label) else np.zeros(0, np.int64)
            x = np.hstack([_rates(flat, doc, len(slots), t, often), before])
            w = fit_logistic(x, label, self.l2) if 0 < label.sum() < len(label) else np.append(np.zeros(x.shape[1]), 40.0 if len(label) and label.all() else -40.0)
            self.picked.append(t)
            self.weights.append(w)
            before = np.hstack([before, oof[:, None]])
        return self

    def predict(self, slot: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Rows by categories: probabilities along the chain."""
        before = np.zeros((n, 0))
        for t, w in zip(self.picked, self.weights):
            x = np.hstack([_rates(slot, doc, n, t), before])
            before = np.hstack([before, sigmoid(x @ w[:-1] + w[-1])[:, None]])
        return before


def fit_toxicity(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows: int = 6000, folds: int = 5) -> ToxicityChain:
    """A chain over the categories, which are columns of ``labels`` (doc_id, 0/1 each; null counts as 0), in order.

    max_rows bounds the labelled rows that are used: half of those with any category set and half of the others, by the
    smallest hashes of doc_id; several labels of a document count as their maxima, and of several texts under one doc_id
    the smallest teaches. A text sends its different hashed words and their counts, at most 2**18 of each. Labels without
    a document, null ids and null texts teach nothing. Without rows of a category, or without others, its probability is
    0 or 1.
    """
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*(F.max(F.coalesce(F.col(c), F.lit(0)).cast("int")).alias(c) for c in categories))
    some = F.greatest(*(F.col(c) for c in categories), F.lit(0)) > 0
    chosen = hashed_sample(one.where(some), max_rows // 2, "doc_id").union(hashed_sample(one.where(~some), max_rows // 2, "doc_id"))
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", *categories).agg(F.min("text").alias("text"))  # at most max_rows are broadcast

    @tidy
    def bags(batches):
        for whole in batches:
            for b in slices(whole):
                slot, doc = _hashed(b)
                edge = np.searchsorted(doc, np.arange(b.num_rows + 1))
                sets = [np.unique(slot[i:j], return_counts=True) for i, j in zip(edge[:-1], edge[1:])]
                sent = [pa.array([x[k].astype(np.int32).tobytes() for x in sets], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *sent, *(b.column(c) for c in categories)], ["doc_id", "slots", "times", *categories])

    got = rows.select("doc_id", "text", *categories).mapInArrow(bags, f"doc_id long, slots binary, times binary, {', '.join(f'`{c}` int' for c in categories)}").collect()
    got.sort(key=lambda r: r["doc_id"])
    y = np.array([[r[c] for c in categories] for r in got], float).reshape(len(got), len(categories))
    fold = np.array([(r["doc_id"] * 2654435761 >> 7) % folds for r in got], int)
    slots, times = ([np.frombuffer(r[c], np.int32).astype(np.int64) for r in got] for c in ("slots", "times"))
    return ToxicityChain(categories, folds).fit(slots, times, y, fold)


def predict_toxicity(docs: DataFrame, chain: ToxicityChain, prefix: str = "p_") -> DataFrame:
    """docs with a column p_<category> (double) for each category; existing columns of these names are replaced.

    A null or empty text has no telling words, so it gets each model's probability for none. Other columns and
    repeated rows pass as they are; an empty table stays empty. Nothing is shuffled.
    """
    new = [prefix + c for c in chain.categories]
    base = docs.drop(*new)
    names = [c for c in base.columns if c != "text"]
    kept = base.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("text").cast("string"))

    @tidy
    def run(batches):
        for whole in batches:
            for b in slices(whole):
                p = chain.predict(*_hashed(b), b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("text"), *(pa.array(p[:, k]) for k in range(len(new)))], ["row", "text", *new])

    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.DoubleType()) for c in new)])
    out = kept.mapInArrow(run, schema)
    return out.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in base.columns), *(F.col(f"`{c}`") for c in new))
