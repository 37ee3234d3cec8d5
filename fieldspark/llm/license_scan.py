"""License scans by diagonal voting, with DataFrame functions only.

Every run of k words of a text is hashed; a Spark join brings the hashes to the places in the templates that have the same
run. A hit at word p of a text and word t of a template votes for the diagonal p - t, which is where the template would
begin. Diagonals that lie close are one place with words put in or left out; its span is verified by the share of
template words that its hits cover, in proportion to the longer of template and span.

A phrase is a template that must be there word by word: its diagonal needs all votes and is merged with no other.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What stands between words, in the pattern language of Spark.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """exact: a phrase of two words or more. Others: a notice of four words or more, found from ``least`` of it on."""

    label: str
    text: str
    exact: bool = False
    least: float = 0.75


# Phrases and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

# Sentences by which licences are told, from their public texts, in lower case without punctuation.
# Those that differ from another licence's by a word must be there nearly whole.
NOTICES = (
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", least=0.95),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", least=0.95),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", least=0.95),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", least=0.95),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", least=0.95),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", least=0.95),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
)

#: Words of a run, of phrases and of notices. A hit of a phrase is two words, so shorter phrases can't be told.
RUNS = {True: 2, False: 4}


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none for null."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lower, GAP), "")


def run_hashes(words: Column, k: int) -> Column:
    """Hashes of all runs of k words (2 or 4), by their first word."""
    pairs = lambda x, by: F.slice(F.zip_with(x, F.slice(x, by + 1, F.size(x)), lambda a, b: F.xxhash64(a, b)), 1, F.greatest(F.size(x) - by, F.lit(0)))
    two = pairs(words, 1)
    return two if k == 2 else pairs(two, 2)


def template_runs(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(template, label, exact, least, size, k, t, run, h): a row per run of each template. ValueError for one without a run."""
    rows = []
    for i, x in enumerate(templates):
        words, k = x.text.split(), RUNS[x.exact]
        if len(words) < k:
            raise ValueError(f"a template of {len(words)} words has no run of {k}: {x.text!r}")
        rows += [(i, x.label, x.exact, x.least, len(words), k, t, words[t : t + k]) for t in range(len(words) - k + 1)]
    schema = "template int, label string, exact boolean, least double, size int, k int, t int, run array<string>"
    two, four = (F.xxhash64(F.xxhash64(F.col("run")[0], F.col("run")[1]), F.xxhash64(F.col("run")[2], F.col("run")[3])) if k == 4 else F.xxhash64(F.col("run")[0], F.col("run")[1]) for k in (2, 4))
    return spark.createDataFrame(rows, schema).withColumn("h", F.when(F.col("k") == 4, four).otherwise(two))


def hits(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """Per row of docs (doc_id, text) one row without template, and one per hit, all with row, doc_id and n_words.

    A hit has p, the text's word, and what template_runs() says of the template's. Its words are compared, not only hashes.
    The templates are the program's own, so their runs are broadcast. Texts stay in their task.
    """
    w, n = F.col("words"), F.size("words")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), words_of(F.col("text")).alias("words"))
    two = run_hashes(w, 2)
    all_runs = F.concat(F.array(F.lit(0).cast("long")), two, run_hashes(w, 4))  # the first keeps the text, whatever it has
    each = rows.withColumn("runs", all_runs).select("row", "doc_id", "words", n.alias("n_words"), F.posexplode("runs").alias("i", "h"))
    first_four = F.greatest(F.col("n_words"), F.lit(1))  # where the runs of four begin in the list
    each = each.withColumns({"of": F.when(F.col("i") == 0, 0).when(F.col("i") < first_four, 2).otherwise(4), "p": F.when(F.col("i") < first_four, F.col("i") - 1).otherwise(F.col("i") - first_four)})
    runs = template_runs(docs.sparkSession, templates)
    found = each.join(F.broadcast(runs), (each["h"] == runs["h"]) & (each["of"] == runs["k"]), "left")
    same = F.slice("words", F.col("p") + 1, F.col("k")) == F.col("run")
    return found.where((F.col("of") == 0) | same).select("row", "doc_id", "n_words", "p", "template", "label", "exact", "least", "size", "k", "t")


def spans(found: DataFrame, slack: int = 4) -> DataFrame:
    """(row, doc_id, n_words, template, label, exact, begin, share) of hits(): a row per verified place; of texts without any one row without template.

    Diagonals of a notice not more than ``slack`` words apart are one place. share: the template's words that the hits
    cover, over the longer of template and span; a place counts from the template's ``least`` on, a phrase at 1.
    """
    by, what = ["row", "doc_id", "n_words"], ["template", "label", "exact", "least", "size", "k"]
    votes = found.repartition("row").withColumn("d", F.col("p") - F.col("t")).groupBy(*by, *what, "d").agg(F.collect_set("t").alias("at"), F.min("p").alias("first"), F.max(F.col("p") + F.col("k")).alias("end"))
    near = Window.partitionBy("row", "template").orderBy("d")
    apart = F.col("d") - F.lag("d").over(near) > F.when(F.col("exact"), 0).otherwise(slack)
    places = votes.withColumn("new", F.when(apart, 1).otherwise(0)).withColumn("place", F.sum("new").over(near.rowsBetween(Window.unboundedPreceding, 0)))
    merged = places.groupBy(*by, *what, "place").agg(F.flatten(F.collect_list("at")).alias("at"), F.min("first").alias("begin"), F.max("end").alias("end"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + F.col("k") - 1)))))
    share = covered / F.greatest(F.col("size"), F.col("end") - F.col("begin"))
    held = merged.withColumn("share", F.when(F.col("template").isNotNull(), share))
    good = F.col("template").isNull() | F.when(F.col("exact"), F.col("share") == 1).otherwise(F.col("share") >= F.col("least"))
    return held.where(good).select(*by, "template", "label", "exact", "begin", "share")


def license_scan(docs: DataFrame, phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES, slack: int = 4) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row of docs (doc_id, text).

    n_base counts all places of phrases, first_word and last_word are the smallest and largest words at which one begins
    (null without). base_labels are the phrases' labels, labels those of phrases and notices, each once, in order, joined
    by commas ('' without). score is the largest share of a place: 1 with a phrase, 0 without any place. A null or empty
    text has no words. Null and repeated doc_ids and repeated rows are kept, each row on its own; other columns are
    ignored; an empty table stays empty.
    """
    base = F.col("exact")
    label = lambda on: F.array_join(F.array_sort(F.collect_set(F.when(on, F.col("label")))), ",")
    return (
        spans(hits(docs, (*phrases, *notices)), slack).groupBy("row", "doc_id", "n_words")
        .agg(
            F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("begin"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("begin"))).cast("long").alias("last_word"),
            label(base).alias("base_labels"), label(F.col("label").isNotNull()).alias("labels"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        )
        .select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
