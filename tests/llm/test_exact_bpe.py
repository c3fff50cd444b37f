import hashlib

import pytest
from pyspark.sql import functions as F

from keelson.llm import byte_bpe, exact_dedup

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, h string")


@pytest.mark.parametrize("hash_fn", [F.md5, lambda c: F.substring(F.md5(c), 1, 1)])
def test_exact_groups_with_and_without_collisions(spark, hash_fn):
    texts = ["A b", "a B", None, "", "É", "é", "x" * 50000] + [f"t{i % 20}" for i in range(60)]
    got = {r.doc_id: r for r in exact_dedup.exact_groups(frame(spark, texts), hash_fn=hash_fn).collect()}
    norm = [(t or "").encode().lower() for t in texts]
    for i, n in enumerate(norm):
        same = [j for j, m in enumerate(norm) if m == n]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(same), len(same), i == max(same))
        assert got[i].text_sha256 == hashlib.sha256(n).hexdigest()
    assert exact_dedup.exact_groups(frame(spark, ["a"]).limit(0)).count() == 0


@pytest.mark.parametrize("words,hot", [(1, 2), (1 << 20, 0), (1 << 20, 3)])
def test_exact_groups_with_a_full_filter_and_few_hot_groups(spark, monkeypatch, words, hot):
    monkeypatch.setattr(exact_dedup, "WORDS", words)
    monkeypatch.setattr(exact_dedup, "HOT", hot)
    texts = [f"Text {i % 7 if i % 3 else i}" for i in range(200)] + [None, "", "hot"] + ["HOT"] * 90
    docs = frame(spark, texts).unionByName(spark.createDataFrame([(None, "hot", "x"), (None, "lone", "x")], "doc_id long, text string, h string"))
    got = exact_dedup.exact_groups(docs).collect()
    norm = [(t or "").lower() for t in texts]
    assert len(got) == len(docs.collect())
    for r in got:
        if r.doc_id is None:
            assert (r.keep_id, r.kept, r.group_size) in [(len(texts) - 1, False, 92), (None, True, 1)]
            continue
        same = [j for j, m in enumerate(norm) if m == norm[r.doc_id]]
        assert (r.keep_id, r.kept) == (max(same), r.doc_id == max(same))
        assert r.group_size == len(same) + (norm[r.doc_id] == "hot")


def test_exact_groups_shuffle_no_text_of_single_rows(spark):
    docs = frame(spark, [f"text {i}" for i in range(300)])
    exact_dedup.exact_groups(docs).collect()
    shared = docs.select(F.lit("0").alias("h")).limit(0)
    marks = exact_dedup._marks(shared)
    rows = docs.select("doc_id", exact_dedup.normalised(F.col("text")).alias("norm"), F.md5("text").alias("h"))
    assert exact_dedup._marked(rows, marks).filter("marked").count() == 0


def test_bpe_equals_whole_text_encoding(spark):
    texts = [None, "", "it's 12 café  x\n\n y", "word 12 a's " * 900, "a" * 3000, "你 \U0001f600"]
    enc = byte_bpe.encoder(PATH, P.PATTERN)
    for t in texts:
        assert byte_bpe.encode(t, PATH, P.PATTERN, 64) == enc.encode_ordinary(t or "")
    for r in byte_bpe.encode_digest(frame(spark, texts), PATH, P.PATTERN).collect():
        t = texts[r.doc_id] or ""
        ids = enc.encode_ordinary(t)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
