"""Language identification in two levels: the family first, then one-versus-one linear SVMs within the family.

Features are relative frequencies of hashed byte 2- and 3-grams of the lower-cased whole text. The models are fitted on
a bounded sample of labelled rows (``max_rows``, spread evenly over the languages) and are small enough to ship with
the tasks; every row is predicted.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import buffers, slices
from .linear import fit_svm, sigmoid
from .worker import tidy

# ISO 639-1 codes by language family; any other code is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nb nl nn no sv",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk tr uz",
    "indic": "bn gu hi mr ne pa ur",
}
DIM = 2048


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang.lower().split("-")[0] in codes.split()), lang)


def profile(raw: bytes) -> np.ndarray:
    """Square roots of the shares of the hashed byte 2- and 3-grams of a lower-cased text."""
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    two = (b[:-1] * np.uint32(256) + b[1:]) * np.uint32(2654435761) >> np.uint32(22)
    three = ((b[:-2] * np.uint32(65536) + b[1:-1] * np.uint32(256) + b[2:]) * np.uint32(2246822519) >> np.uint32(22)) + np.uint32(DIM // 2) if len(b) > 2 else two[:0]
    return np.sqrt((np.bincount(two, minlength=DIM) + np.bincount(three, minlength=DIM)) / len(b)).astype(np.float32)


def _profiles(b: pa.RecordBatch) -> np.ndarray:
    data, off = buffers(pc.utf8_lower(b.column("text")))
    raw = data.tobytes()
    return np.stack([profile(raw[i:j]) for i, j in zip(off[:-1], off[1:])]) if len(off) > 1 else np.zeros((0, DIM), np.float32)


class LanguageModel:
    """langs: the learned languages; pairs: {(a, b): weights}, positive for a, for families and for their languages."""

    def __init__(self, langs: list[str], x: np.ndarray, lang: np.ndarray):
        self.langs = sorted(langs)
        self.members: dict[str, list[str]] = {}
        for code in self.langs:
            self.members.setdefault(family_of(code), []).append(code)
        family = np.array([family_of(c) for c in lang.tolist()], object)
        self.pairs = {}
        for names, of in [(sorted(self.members), family), *((m, lang) for m in self.members.values())]:
            for a, b in combinations(names, 2):
                rows = (of == a) | (of == b)
                self.pairs[a, b] = fit_svm(x[rows], np.where(of[rows] == a, 1.0, -1.0)).astype(np.float32)

    def _choose(self, names: list[str], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The name with most one-versus-one wins (then the larger mean probability), and that mean probability."""
        if len(names) == 1:
            return np.zeros(len(x), int), np.ones(len(x))
        wins, p = np.zeros((len(x), len(names))), np.zeros((len(x), len(names)))
        for (i, a), (j, b) in combinations(enumerate(names), 2):
            w = self.pairs[a, b]
            q = sigmoid(3 * (x @ w[:-1] + w[-1]))
            wins[:, i] += q >= 0.5
            wins[:, j] += q < 0.5
            p[:, i] += q
            p[:, j] += 1 - q
        p /= len(names) - 1
        best = np.argmax(wins + p / 2, axis=1)
        return best, p[np.arange(len(x)), best]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names = sorted(self.members)
        out, score = np.full(len(x), "und", object), np.zeros(len(x))
        if not names:
            return out, score
        family, p = self._choose(names, x)
        for i, name in enumerate(names):
            rows = np.flatnonzero(family == i)
            if len(rows):
                k, q = self._choose(self.members[name], x[rows])
                out[rows], score[rows] = np.array(self.members[name], object)[k], p[rows] * q
        return out, score


def _sampled(docs: DataFrame, max_rows: int, max_langs: int) -> DataFrame:
    """At most max_rows labelled rows (lang, features): per language those with the smallest hashes of id and text.

    Rows are thinned by their hashes to about twice as many before they meet; equal rows count once.
    """
    keyed = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string"), F.xxhash64("doc_id", "text").alias("h"), F.col("text").cast("string"))
    langs = keyed.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()
    most = max(1, max_rows // max(1, len(langs)))
    bound = [(r["lang"], min(2**63 - 1, int((2 * most + 200) / r["count"] * 2**64) - 2**63)) for r in langs]
    thin = keyed.join(F.broadcast(docs.sparkSession.createDataFrame(bound, "lang string, top long")), "lang").where("h <= top")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    texts = thin.groupBy("lang", "h").agg(F.min("text").alias("text")).withColumn("k", rank).where(F.col("k") <= most)

    @tidy
    def features(batches):
        for whole in batches:
            for b in slices(whole):
                x = _profiles(b)
                yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("h"), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "h", "x"])

    return texts.select("lang", "h", "text").mapInArrow(features, "lang string, h long, x binary")


def fit_languages(docs: DataFrame, max_rows: int = 2000, max_langs: int = 256) -> LanguageModel:
    """A model from the columns doc_id, text and lang of docs; rows without text or lang teach nothing.

    max_rows bounds the sample that comes to the driver (8 kB a row), max_langs the languages that are learned: the most
    frequent ones, ties by name. No labelled row: a model that knows no language. Repeated rows teach once.
    """
    rows = sorted(_sampled(docs, max_rows, max_langs).collect(), key=lambda r: (r["lang"], r["h"]))
    lang = np.array([r["lang"] for r in rows], object)
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]) if rows else np.zeros((0, DIM), np.float32)
    return LanguageModel(sorted(set(lang.tolist())), x, lang)


def predict_languages(docs: DataFrame, model: LanguageModel, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with lang_pred and score appended under the given names; existing columns of these names are replaced.

    lang_pred is a learned language, or ``und`` with score 0 if the text is null or has no letter or no language was
    learned. Equal margins go to the name that comes first. Only the text is read. Nothing is shuffled; all other columns
    and repeated rows pass as they are; an empty table stays empty.
    """
    base = docs.drop(lang_pred, score)
    names = [c for c in base.columns if c != "text"]
    kept = base.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("text").cast("string"))

    @tidy
    def run(batches):
        for whole in batches:
            for b in slices(whole):
                lang, p = model.predict(_profiles(b))
                letter = pc.fill_null(pc.match_substring_regex(b.column("text"), r"\p{L}"), False).to_numpy(zero_copy_only=False)
                lang[~letter], p[~letter] = "und", 0.0
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("text"), pa.array(lang.tolist(), pa.string()), pa.array(p, pa.float64())], ["row", "text", "lang_pred", "score"])

    out = kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    return out.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in base.columns), F.col("lang_pred").alias(lang_pred), F.col("score").alias(score))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
