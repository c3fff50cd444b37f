import random
import zlib

import numpy as np
import pytest

from keelson.llm import packing, simhash

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def test_groups_equal_brute_force(spark):
    rnd = random.Random(3)
    base = [[rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(60)] for _ in range(12)]
    texts = [None, "", "a", "A b"]
    for ws in base:
        for j in range(4):
            texts.append(" ".join(ws + ["tail"] * j))
    texts += texts[-3:]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in simhash.near_groups(
        spark.createDataFrame(rows, "doc_id long, text string, node string")).collect()}
    f = [simhash.fingerprint(t) for t in texts]
    root = list(range(len(f)))
    for _ in f:
        for i in range(len(f)):
            for j in range(len(f)):
                if (f[i] ^ f[j]).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    assert [got[i].component_id for i in range(len(f))] == root
    assert [got[i].fingerprint for i in range(len(f))] == [f"{x:016x}" for x in f]


TEXTS = ["It's 42 ÉTÉ ß ²¼ ª_x!! don't", "a\tb\n\nc", "你好 é İ", "a <|endoftext|> b", "", "µm ÿ Ø×÷ 'S", None, "  two  blanks ",
         "e\u0301 \u0301 x", "ΣΑΣ ΟΔΟΣ", "\u2028a\x1cb\x85c\xa0d", "<|ENDOFTEXT|>", "x" * 500, "don't <|", "İstanbul ﬁ ǅ", "same", "same"]


def test_ids_equal_the_plain_library_call(spark, monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = packing.encoder(PATH).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    monkeypatch.setattr(packing, "CACHE", 5)
    enc = packing.Encoder(PATH)
    got = [x for n in range(0, 60, 3) for x in enc.encode(texts[n:n + 3])]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want[:60]


def test_pieces_of_odd_rows(spark):
    from tokenizers import Tokenizer
    tok, big = Tokenizer.from_file(PATH), 9007199254740993
    rows = [(None if n == 3 else big + n // 2, t, "x", 5) for n, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, length int").repartition(2)
    got = packing.pack(docs, PATH, size=64).collect()
    want = []
    for i, t, *_ in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want += [(i, p // 64, p, len(ids[p:p + 64]), zlib.crc32(ids[p:p + 64].tobytes())) for p in range(0, len(ids), 64)]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)


def test_packing_is_gapless_and_tight(spark):
    rnd = random.Random(5)
    texts = [None, ""] + [" ".join(["word"] * rnd.randint(1, 150)) for _ in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.pack(docs, PATH, size=64).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 64
        total += at
    assert len(by) <= -(-total // 64) + 2
    assert {r.doc_id for r in rows} == set(range(len(texts)))
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_local_search_empties_a_bin():
    got = packing.local_search([[1, {6: 1}], [1, {5: 1}], [1, {4: 1}]], 10)
    assert sum(n for n, _ in got) == 2


def test_local_search_moves_whole_classes_and_passes_stuck_sources():
    # bins of 6, 5 and 4: far more bins than single steps would empty, beside one of 3
    got = packing.local_search([[20_000, {6: 1}], [20_000, {5: 1}], [20_000, {4: 1}], [1, {3: 1}]], 10)
    assert sum(n for n, _ in got) <= 30_001
    rnd = random.Random(1)
    hist = {}
    for _ in range(20_000):
        x = rnd.randint(1000, 2500)
        hist[x] = hist.get(x, 0) + 1
    first = packing.best_fit(dict(hist), 4096)
    got, held = packing.local_search([list(c) for c in first], 4096), {}
    for n, have in got:
        assert 0 < sum(x * k for x, k in have.items()) <= 4096
        for x, k in have.items():
            held[x] = held.get(x, 0) + n * k
    least = -(-sum(x * k for x, k in hist.items()) // 4096)
    assert held == hist and least <= sum(n for n, _ in got) < sum(n for n, _ in first) - 50
