"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers as tokenizer_files
from pyspark.sql import functions as F

from keelson.llm import (alignment, ann, byte_bpe, exact_dedup, hard_negatives, hmm, langid, license_notices, licenses, packing,
                         pii, piece_bpe, simhash, toxicity)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(langid.sample_of(docs.filter(fold(4) != 2)))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op2_simhash(spark, sf_dir):
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark, sf_dir):
    return byte_bpe.encode_digest(_table(spark, sf_dir, "documents"),
                                  tokenizer_files.path("byte_bpe_multi_50k.tiktoken"), tokenizer_files.PATTERN)


def op5_license_scan(spark, sf_dir):
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"), notices=license_notices.covered())


def op6_learned_partitions(spark, sf_dir):
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_files.path("word_bpe_49k.json"))


def op8_hmm(spark, sf_dir):
    return hmm.score(_table(spark, sf_dir, "documents"), fold(10) == 0)


def op9_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(toxicity.sample_of(docs, labels.filter(fold(5) != 0)))
    return toxicity.score(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted", "offsets")


def op10_pii(spark, sf_dir):
    return pii.digest(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    v = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(v.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_alignment(spark, sf_dir):
    return alignment.digest(_table(spark, sf_dir, "documents"), tokenizer_files.path("byte_bpe_50k.json"),
                            tokenizer_files.path("piece_bpe_32k.model"), tokenizer_files.PATTERN)


def op13_sentencepiece(spark, sf_dir):
    return piece_bpe.encode_digest(_table(spark, sf_dir, "documents"), tokenizer_files.path("piece_bpe_32k.model"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_simhash, op3_exact_dedup, op4_byte_bpe, op5_license_scan,
                                   op6_learned_partitions, op7_packing, op8_hmm, op9_toxicity, op10_pii, op11_hard_negatives,
                                   op12_alignment, op13_sentencepiece, pipeline)}

ORACLE = {"op11_hard_negatives": """
WITH t AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
      FROM t a JOIN t v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10""",
          "op3_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)"""}
