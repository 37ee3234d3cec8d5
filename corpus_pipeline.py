"""From raw documents to packed training sequences: toxicity, language, near copies, packing.

Every stage keeps all columns of its input, whatever their names: helper columns get names that are free.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.langid import fit_languages, predict_languages
from fieldspark.llm.ngram_join import ngram_components
from fieldspark.llm.packing import pack
from fieldspark.llm.queries import toxicity_labels
from fieldspark.llm.store import shared_dir, stored
from fieldspark.llm.toxicity import fit_toxicity, predict_toxicity

#: A document is rejected from this probability of being toxic, and below this likeness to its language.
TOXIC, LEAST_SCORE = 0.5, 0.3


def free_name(docs: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of docs starts with it, case ignored."""
    while any(c.lower().startswith(name.lower()) for c in docs.columns):
        name = "_" + name
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below TOXIC; the chain learns from the labels of these documents.

    Null and empty texts have no telling words and stay, as all do where no label is. Equal texts share their fate, so
    repeated rows stay or go together. An empty table stays empty.
    """
    chain, p = fit_toxicity(docs, toxicity_labels(spark, sf_dir), ["low_quality", "toxic"]), free_name(docs, "p_")
    return predict_toxicity(docs, chain, p).where(F.col(f"{p}toxic") < TOXIC).select(*(F.col(f"`{c}`") for c in docs.columns))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the learned languages: not ``und``, with a score of LEAST_SCORE or more.

    Texts that are null or have no letter go. Where no document has a lang there is nothing to learn, and all documents
    with a letter stay. Repeated rows stay or go together. An empty table stays empty.
    """
    model, lang, score = fit_languages(docs), free_name(docs, "lang_pred"), free_name(docs, "score")
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = predict_languages(docs, model, lang, score)
    return found.where((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join: that with the smallest doc_id, nulls last.

    Rows are told apart by a 64-bit hash of doc_id and text, so repeated ids are no trouble: of rows that are equal in
    both one stays, whatever their other columns hold. A document is lost to a collision of that hash only: some three
    are to be expected among 10**10. Null and empty texts and texts without words are in no one's class and stay.
    An empty table stays empty.
    """
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    classes = ngram_components(keyed.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias(key), "component_id")
    ids = keyed.select(key, "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key))
    kept = classes.distinct().join(ids, key).groupBy("component_id").agg(first.getField(key).alias(key))
    return keyed.join(kept.select(key), key, "left_semi").dropDuplicates([key]).select(*(F.col(f"`{c}`") for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids, as pack() has them.

    A null or empty text is its end token; repeated rows and ids are packed each on its own; an empty table gives none.
    """
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("language_id", keep_languages), ("near_duplicates", drop_near_copies), ("packing", pack_sequences)]

#: The models of the first two stages can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over sf_dir's documents, each written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "pipeline")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
