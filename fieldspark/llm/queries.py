"""The thin queries over the given tables, one for each operator, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe_tree, hard_negatives, langid, license_scan, lm, packing, simhash, token_align, toxicity, warc
from .ngram_join import ngram_components
from .token_counts import token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_near_counts(simhash.neighbouring(_table(spark, sf_dir, "documents")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lm.score(docs, lm.fit(docs.where(~lm.is_held_out())), lm.is_held_out())


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit_languages(docs.where(~langid.held_out()))
    return langid.predict_languages(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.bpe_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain's categories as the labels table has them: low quality first, then toxic."""
    return _table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit_toxicity(docs, toxicity_labels(spark, sf_dir), ["low_quality", "toxic"])
    return toxicity.predict_toxicity(docs, chain).select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", hard_negatives.shifted_label())
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard, op2_simhash, op3_token_counts, op4_kneser_ney, op5_warc, op6_learned_partitions, op7_packing, op8_language, op9_byte_bpe, op10_toxicity, op11_token_alignment, op12_license_scan, op13_hard_negatives)}

_OP1 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w
), c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT p.a, p.b FROM p JOIN c x ON x.doc_id = p.a JOIN c y ON y.doc_id = p.b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT w.doc_id, coalesce(c.n, 0) AS n_shingles, m.low AS component_id
FROM w LEFT JOIN c ON c.doc_id = w.doc_id JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) m ON m.a = w.doc_id
"""

_OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, strlen(html) AS payload_bytes, h, array_to_string(list_transform(range(1, 41), lambda i:
        ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][instr('0123456789abcdef', h[i])]), '') AS bits FROM p),
d AS (SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * CAST(bits[5*i+1] AS INT) + 8 * CAST(bits[5*i+2] AS INT) + 4 * CAST(bits[5*i+3] AS INT) + 2 * CAST(bits[5*i+4] AS INT) + CAST(bits[5*i+5] AS INT), 1)), '') AS payload_digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS low FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to FROM f
"""

_RUNS = ", ".join(
    f"({i}, '{x.label}', {x.exact}, {x.least}, {len(w)}, {k}, {t}, '{' '.join(w[t : t + k])}')"
    for i, x in enumerate((*license_scan.PHRASES, *license_scan.NOTICES)) for w, k in [(x.text.split(), license_scan.RUNS[x.exact])] for t in range(len(w) - k + 1)
)

_OP12 = f"""
WITH r(template, label, ex, least, size, k, t, run) AS (VALUES {_RUNS}),
w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
g AS (SELECT rid, 2 AS k, unnest(range(0, len(ws) - 1)) AS p, ws FROM w UNION ALL SELECT rid, 4, unnest(range(0, len(ws) - 3)), ws FROM w),
h AS (SELECT g.rid, g.p, r.* FROM (SELECT rid, k, p, array_to_string(ws[p+1:p+k], ' ') AS run FROM g) g JOIN r ON r.k = g.k AND r.run = g.run),
d AS (SELECT rid, template, label, ex, least, size, p - t AS d, list(range(t, t + k)) AS cover, min(p) AS first, max(p + k) AS last FROM h GROUP BY ALL),
n AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY rid, template ORDER BY d) > CASE WHEN ex THEN 0 ELSE 4 END THEN 1 ELSE 0 END AS new FROM d),
c AS (SELECT *, sum(new) OVER (PARTITION BY rid, template ORDER BY d ROWS UNBOUNDED PRECEDING) AS place FROM n),
m AS (SELECT rid, template, label, ex, least, size, place, len(list_distinct(flatten(flatten(list(cover))))) AS covered, min(first) AS b, max(last) AS e FROM c GROUP BY ALL),
s AS (SELECT *, CAST(covered AS DOUBLE) / greatest(size, e - b) AS share FROM m),
v AS (SELECT * FROM s WHERE CASE WHEN ex THEN share = 1 ELSE share >= least END)
SELECT w.doc_id, CAST(len(any_value(w.ws)) AS BIGINT) AS n_words, count(*) FILTER (ex) AS n_base, CAST(min(b) FILTER (ex) AS BIGINT) AS first_word, CAST(max(b) FILTER (ex) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (ex), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0) AS score
FROM w LEFT JOIN v ON v.rid = w.rid GROUP BY w.rid, w.doc_id
"""

_OP13 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INT) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE = {"op1_ngram_jaccard": _OP1, "op5_warc": _OP5, "op12_license_scan": _OP12, "op13_hard_negatives": _OP13}
