"""Edge cases of the stages, and the whole chain against a plain version of it."""

import re

import pytest

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from keelson.llm import byte_bpe, hmm, langid, licenses, packing, pii, simhash, toxicity  # noqa: E402

COLS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, spans string, found string, "
          "doc string, kept_id long, rejected boolean, component_id long, h string, base string")


def odd(spark):
    words = "the quick brown fox jumps over a lazy dog near the river bank".split()
    texts = [None, "", "12 ;", " ".join(words), " ".join(words).upper(), " ".join(words * 4000) + " me@example.com end",
             "call +1 (706) 555-3138 " + " ".join(words), "call +1 (706) 555-3138 " + " ".join(words)]
    rows = [(i, t, "en", None, 0, 1.0, "s", "f", "d", 5, True, 7, "h", "b") for i, t in enumerate(texts)]
    rows += [rows[3], (None, "a text without an id", None, "x", None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("empty", [False, True])
def test_every_stage_takes_odd_rows(spark, empty):
    docs = odd(spark).limit(0) if empty else odd(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, None)
        rows = out.collect()
        assert name == "packing" or out.columns == docs.columns
        assert bool(rows) != empty, name
        if name == "exact_dedup" and not empty:
            assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 4, 5, 7]
            assert sum(r.doc_id is None for r in rows) == 1
        if name == "pii" and not empty:
            assert len(rows) == 10 and {r.text[:12] for r in rows if r.doc_id in (6, 7)} == {"call [PHONE]"}
            assert next(r.text for r in rows if r.doc_id == 5).endswith("[EMAIL] end")


def test_other_operators_take_odd_rows(spark):
    docs, n = odd(spark), odd(spark).count()
    from pyspark.sql import functions as F
    held = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    assert hmm.score(docs, held).count() == n
    model = toxicity.train(docs.withColumn("toxic", F.lit(0)))
    assert toxicity.score(docs, model).count() == n
    assert byte_bpe.encode_digest(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == n
    assert simhash.near_groups(docs).count() == n and pii.digest(docs).count() == n
    assert licenses.scan_licenses(docs).count() == 0
    none = docs.limit(0)
    assert hmm.score(none, held).count() == 0
    assert toxicity.score(none, toxicity.train(none.withColumn("toxic", F.lit(0)))).count() == 0


def test_chain_equals_plain_version(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.piece): (r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, "/root/testdata/sf0.01").collect()}
    model = langid.train(langid.sample_of(src))
    ok = {r.doc_id for r in langid.predict(src, model).collect() if not r.rejected}
    docs = {r.doc_id: r.text for r in src.collect() if r.doc_id in ok}
    last = {}
    for i in sorted(docs):
        last[re.sub("[A-Z]+", lambda m: m.group().lower(), docs[i] or "")] = i
    docs = {i: docs[i] for i in last.values()}
    prints, root = {i: simhash.fingerprint(t) for i, t in docs.items()}, {i: i for i in docs}
    near = [(a, b) for a in docs for b in docs if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    for _ in docs:
        before = dict(root)
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    docs = {i: t for i, t in docs.items() if root[i] == i}
    kept = src.filter(src.doc_id.isin(list(docs)))
    spans = {r.doc_id: r.spans for r in pii.digest(kept).collect()}
    want = {}
    from tokenizers import Tokenizer
    tok, zlib, np = Tokenizer.from_file(P.path("word_bpe_49k.json")), __import__("zlib"), __import__("numpy")
    for i, t in docs.items():
        out, at = "", 0
        for k, s, e in sorted((x.split(":") for x in spans[i].split(",") if x), key=lambda x: (int(x[1]), pii.KINDS.index(x[0]))):
            if int(s) >= at:
                out, at = out + t[at:int(s)] + f"[{k.upper()}]", int(e)
        ids = np.array(tok.encode(out + (t or "")[at:], add_special_tokens=False).ids + [1], dtype="<u4")
        for p in range(0, len(ids), 4096):
            want[i, p // 4096] = (len(ids[p:p + 4096]), zlib.crc32(ids[p:p + 4096].tobytes()))
    assert got == want
    assert packing.pack(kept.limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_dedup_stages_keep_one_row_of_each_group(spark):
    words = " ".join(f"w{i} and x{i * 7}" for i in range(300))
    rows = [(1, "a b c"), (1, "a b c"), (1, "d e f"), (2, "a b c"), (None, "D e f"), (None, "g h i"), (None, "g h i"), (None, "j k l"),
            (7, words), (7, words), (None, words + " end"), (8, words + " tail"), (None, "other " + words[:900]), (None, words[:900])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted((tuple(r) for r in corpus_pipeline.exact(spark, docs, None).collect()), key=key)
    groups = {}
    for r in rows:
        groups.setdefault(r[1].lower(), []).append(r)
    assert got == sorted((max(g, key=lambda r: (r[0] is not None, r[0] or 0)) for g in groups.values()), key=key)
    got = sorted((tuple(r) for r in corpus_pipeline.near(spark, docs, None).collect()), key=key)
    prints, root = [simhash.fingerprint(t) for _, t in rows], list(range(len(rows)))
    for _ in rows:
        for i, f in enumerate(prints):
            for j, g in enumerate(prints):
                if (f ^ g).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    groups = {}
    for r, p in zip(rows, root):
        groups.setdefault(p, []).append(r)
    assert len(groups) < len(set(prints))  # linked fingerprints, null ids among them
    assert [key(r)[:2] for r in got] == sorted(min(key(r)[:2] for r in g) for g in groups.values())
    ids = {r.fingerprint: r.component_id for r in simhash.near_groups(docs).collect()}
    assert all(ids[f"{prints[n]:016x}"] == min((r[0] for r in groups[root[n]] if r[0] is not None), default=None) for n in range(len(rows)))
