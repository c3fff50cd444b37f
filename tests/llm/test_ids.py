"""Ids pass through every operator on documents as they are: null, repeated and beyond 2^53, in one batch, with clashing columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

from keelson.llm import alignment, byte_bpe, exact_dedup, hmm, langid, license_notices, licenses, packing, pii, piece_bpe, simhash, toxicity  # noqa: E402

BIG = 9007199254740993
ROWS = [(BIG, "Licensed under the Apache License, Version 2.0 see me@example.com"), (None, "a text without an id"), (3, "three small words"),
        (BIG, "Licensed under the Apache License, Version 2.0 see me@example.com"), (BIG + 2, None), (None, ""), (-BIG, "the last of them")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s", 0.5, "h", True) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, p string, score double, row string, predicted boolean").coalesce(1)


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=lambda x: (x is None, x or 0))


WANT = sorted((i for i, _ in ROWS), key=lambda x: (x is None, x or 0))


def test_ids_stay(spark, docs):
    held = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    got = {
        "byte_bpe": byte_bpe.encode_digest(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
        "piece_bpe": piece_bpe.encode_digest(docs, P.path("piece_bpe_32k.model")),
        "alignment": alignment.digest(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.PATTERN),
        "packing": packing.pack(docs, P.path("word_bpe_49k.json")),
        "hmm": hmm.score(docs, held),
        "toxicity": toxicity.score(docs, toxicity.train(docs.withColumn("toxic", F.lit(0)))),
        "exact_dedup": exact_dedup.exact_groups(docs), "simhash": simhash.near_groups(docs), "pii": pii.digest(docs),
        "langid": langid.predict(docs, langid.train(langid.sample_of(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))))}
    for name, df in got.items():
        assert ids(df) == WANT, name
    found = licenses.scan_licenses(docs, notices=license_notices.covered()).collect()
    assert {r.doc_id for r in found} == {BIG} and len(found) == 2 and {r.license for r in found} == {"Apache-2.0"}
    digests = {r.doc_id: r.decoded_sha256 for r in got["byte_bpe"].filter("doc_id IS NOT NULL").collect()}
    assert digests == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in ROWS if i is not None}
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_toxicity_of_a_row_does_not_depend_on_the_others(spark, docs):
    model = toxicity.train(docs.withColumn("toxic", F.when(F.col("text").contains("Licensed"), 1).otherwise(0)))
    rows = {(r.doc_id, r.score, r.predicted, r.offsets) for r in toxicity.score(docs, model).collect()}
    alone = {(r.doc_id, r.score, r.predicted, r.offsets) for i, _ in ROWS if i for r in toxicity.score(docs.filter(F.col("doc_id") == i), model).collect()}
    assert alone == {r for r in rows if r[0] is not None}
