"""Corpus pipeline: language ID, exact dedup, near dedup, PII redaction, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from keelson.llm import exact_dedup, langid, packing, pii, simhash
from keelson.plans.stages import materialize
from keelson.session import fresh_path


def _numbered(docs):
    """``docs`` as one struct beside a number of each row, written once so that the numbers stay."""
    return materialize(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), force=True)


def _rows_but(rows, dropped):
    """The documents of ``rows`` whose number is not in ``dropped``; ids may repeat or be null. The numbers are written
    first, so Spark knows their size: while they fit a broadcast, no text is shuffled."""
    return rows.join(materialize(dropped.select("row"), force=True), "row", "left_anti").select("doc.*")


def language_id(spark, docs, sf_dir):
    """Documents whose language is rejected go."""
    model = langid.train(langid.sample_of(docs))
    return langid.accepted(docs, model)


def exact(spark, docs, sf_dir):
    """The row of largest (doc_id, number) of each group of equal texts stays; null ids are smallest."""
    rows = _numbered(docs)
    keyed = rows.select(F.struct(F.col("doc.doc_id").alias("doc_id"), "row").alias("key"), F.col("doc.text").alias("text"))
    return _rows_but(rows, exact_dedup.exact_groups(keyed, id_col="key").filter("NOT kept").select("doc_id.row"))


def near(spark, docs, sf_dir):
    """The row of smallest (doc_id, number) of each group stays; null ids are largest."""
    rows = _numbered(docs)
    kept = simhash.near_firsts(rows.select("doc.doc_id", "doc.text", "row"))
    return _rows_but(rows, rows.select("row").join(kept, "row", "left_anti"))


def private(spark, docs, sf_dir):
    return pii.redact(docs)


def packed(spark, docs, sf_dir):
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("simhash", near), ("pii", private), ("packing", packed)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
