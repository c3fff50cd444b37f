import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import ann, catalog, hmm, licenses, sequences, toxicity

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    emit, step, first = rng.random((4, 2)), np.array([[.7, .3], [.2, .8]]), np.array([.6, .4])
    total, on = 0.0, np.zeros(4)
    for path in itertools.product(range(2), repeat=4):
        p = first[path[0]] * emit[0, path[0]]
        for t in range(1, 4):
            p *= step[path[t - 1], path[t]] * emit[t, path[t]]
        total += p
        on += p * np.array(path)
    starts, n = np.array([0]), np.array([4])
    alpha, scale = sequences.forward(emit, starts, n, first, step)
    g = alpha * sequences.backward(emit, scale, starts, n, step)
    assert math.isclose(np.log(scale).sum(), math.log(total))
    assert np.allclose(g[:, 1] / g.sum(axis=1), on / total)


def test_forward_normalised_at_some_steps_only():
    rng = np.random.default_rng(1)
    n = np.array([20, 17, 9, 8, 3, 1])
    starts = np.cumsum(n) - n
    emit, step, first = rng.random((n.sum(), 3)) * 0.01, rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(3))
    alpha, scale = sequences.forward(emit, starts, n, first, step)
    beta = sequences.backward(emit, scale, starts, n, step)
    for every in (2, 8, 50):
        a, s = sequences.forward(emit, starts, n, first, step, every)
        assert np.allclose(np.add.reduceat(np.log(s), starts), np.add.reduceat(np.log(scale), starts))
        assert np.allclose(a * sequences.backward(emit, s, starts, n, step), alpha * beta)


def test_search_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows += [(100_000, None), (100_020, [0.0] * len(rows[0][1])), (100_040, [float("nan")] * len(rows[0][1]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = dict((i, np.array(v)) for i, v in rows if i < 100_000)
    ids, x = np.array(list(good)), np.array(list(good.values()))
    hits = total = 0
    for q in (i for i in good if i % 20 == 0):
        s = x @ good[q]
        s[ids == q] = -np.inf
        want = set(ids[np.lexsort((ids, -s))[:20]])
        hits += len(want & {v for _, v, _ in got[q]})
        total += 20
        assert sorted(r for r, _, _ in got[q]) == list(range(1, 21))
    assert hits / total >= 0.9 and not any(q >= 100_000 for q in got)


def test_hmm_base_score_and_gain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    rows = docs.select("doc_id", "text", (catalog.fold(10) == 0).alias("h")).collect()
    from collections import Counter
    c = Counter(w for r in rows if not r.h for w in hmm.words(r.text))
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in hmm.score(docs, catalog.fold(10) == 0).collect()}
    for r in rows:
        ws = hmm.words(r.text)
        g = got[r.doc_id]
        assert math.isclose(g.base_score, sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in ws), rel_tol=1e-9)
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
    held = [got[r.doc_id] for r in rows if r.h]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


def test_toxicity_held_out(spark):
    lab = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = [(r.predicted, lab[r.doc_id]) for r in catalog.op9_toxicity(spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in lab]
    assert sum(p == y == 1 for p, y in got) >= 0.85 * sum(y for _, y in got)
    assert sum(p > y for p, y in got) <= 0.02 * len(got)
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    model = toxicity.train(odd.withColumn("toxic", F.lit(0)))
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, model).collect())


def test_license_scan(spark):
    t = "The work. " * 3000
    texts = [None, "", t + licenses.TEMPLATES["Apache-2.0"], licenses.TEMPLATES["MIT"] + " x " + licenses.TEMPLATES["MIT"],
             "a license to the under " * 50, "Released under the BSD License.", "Licensed under CC BY-SA 4.0.",
             licenses.TEMPLATES["GPL-3.0"].replace("3", "2"), t + 2 * (licenses.TEMPLATES["MIT"] + " and ") + t]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.license) for r in licenses.scan_licenses(df).collect())
    assert got == [(2, "Apache-2.0"), (3, "MIT"), (3, "MIT"), (8, "MIT"), (8, "MIT")]


def test_hmm_scores_repeated_and_null_ids_row_by_row(spark):
    rows = [(1, "one two three"), (1, "one two three"), (2, "rare words here"), (None, "one rare"), (4, None), (5, "")]
    rows += [(i, f"word{i} one two") for i in range(20, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = hmm.HEAD
    try:
        hmm.HEAD = 3  # most words are then joined, not broadcast
        got = hmm.score(docs, catalog.fold(10) == 0).collect()
    finally:
        hmm.HEAD = whole
    same = hmm.score(docs, catalog.fold(10) == 0).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_known, round(r.base_score, 8))
    assert len(got) == len(rows) and sorted(map(key, got)) == sorted(map(key, same))
    ones = [r for r in got if r.doc_id == 1]
    assert len(ones) == 2 and ones[0] == ones[1]


def test_toxicity_sample_is_bounded_by_characters(spark):
    docs = spark.createDataFrame([(1, "a" * 50), (2, "b" * 900), (3, None), (4, "c" * 40)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert sorted(r.doc_id for r in toxicity.sample_of(docs, labels, chars=100).collect()) == [1, 3, 4]


def plain_scores(texts, held):
    """Scores by the definition: counts, three rounds of forward and backward sums step by step, whole-text likelihood."""
    from collections import Counter
    ws = [hmm.words(t) for t in texts]
    c = Counter(w for w, h in zip(ws, held) if not h for w in w)
    n, v = sum(c.values()), len(c)
    own = [w for w in sorted(c, key=lambda w: (-c[w], w)) if w != hmm.END][:hmm.SYMBOLS]
    symbol, end = {w: i for i, w in enumerate(own)}, hmm.SYMBOLS + hmm.CLASSES
    mass = np.full(hmm.CLASSES, 0.1)
    for w in c:
        if w != hmm.END and w not in symbol:
            mass[hmm.word_class(w)] += c[w] + 0.1
    ids = [[end if w == hmm.END else symbol.get(w, hmm.SYMBOLS + hmm.word_class(w)) for w in t] for t in ws]
    model = hmm.start_model()
    for _ in range(hmm.ROUNDS):
        k, m = model["step"].shape[0], len(model["emit"])
        counts, first, trans = np.full((m, k), 0.01), np.full(k, 0.1), np.full((k, k), 0.1)
        for t, h in zip(ids, held):
            if h:
                continue
            a = [model["first"] * model["emit"][t[0]]]
            for i in t[1:]:
                a.append(a[-1] @ model["step"] * model["emit"][i])
            b = [np.ones(k)]
            for i in reversed(t[1:]):
                b.append(model["step"] @ (model["emit"][i] * b[-1]))
            b.reverse()
            p = a[-1].sum()
            first += a[0] * b[0] / p
            for j, i in enumerate(t):
                counts[i] += a[j] * b[j] / p
                if j:
                    trans += np.outer(a[j - 1], model["emit"][i] * b[j]) * model["step"] / p
        model = {"first": first / first.sum(), "step": trans / trans.sum(axis=1, keepdims=True), "emit": counts / counts.sum(axis=0)}
    out = []
    for t, w in zip(ids, ws):
        a = model["first"] * model["emit"][t[0]]
        for i in t[1:]:
            a = a @ model["step"] * model["emit"][i]
        share = sum(math.log10((c[x] + 0.1) / mass[i - hmm.SYMBOLS]) for x, i in zip(w, t) if hmm.SYMBOLS <= i < end)
        out.append((len(t), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + .1) / (n + .1 * (v + 1))) for x in w),
                    math.log10(a.sum()) + share))
    return out


def test_hmm_scores_equal_plain_recursion(spark, monkeypatch):
    import random
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["a", "B", "b", "the", "cat", "xat", f"w{rnd.randint(0, 9)}"]) for _ in range(rnd.randint(0, 25))) for _ in range(40)]
    texts += [None, "", " \t ", "café   z"]
    held = [i % 5 == 0 for i in range(len(texts))]
    big = 9007199254740993
    rows = [(None if i == 3 else big + i, t, h, "x", 1) for i, (t, h) in enumerate(zip(texts, held))]
    df = spark.createDataFrame(rows, "doc_id long, text string, h boolean, ids string, row int").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0)
    for symbols, head, steps in ((8192, 131_072, 50_000), (4, 6, 3), (2, 3, 7)):  # few symbols, a short head, texts longer than a block
        for name, value in (("SYMBOLS", symbols), ("HEAD", head), ("STEPS", steps)):
            monkeypatch.setattr(hmm, name, value)
        got = sorted(map(tuple, hmm.score(df, F.col("h")).collect()), key=key)
        want = sorted(((r[0], r[2], *s) for r, s in zip(rows, plain_scores(texts, held))), key=key)
        for g, w in zip(got, want):
            assert g[:5] == w[:5] and np.allclose(g[5:], w[5:], rtol=1e-9, atol=1e-9), (g, w)
        assert len(got) == len(want)


def test_hmm_goes_through_long_texts_in_blocks(spark, monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(1000))
    df = spark.createDataFrame([(1, text), (2, "w1 w4 w9")], "doc_id long, text string")
    whole = [tuple(r) for r in hmm.score(df, F.lit(False)).orderBy("doc_id").collect()]
    monkeypatch.setattr(hmm, "STEPS", 100)
    parts = [tuple(r) for r in hmm.score(df, F.lit(False)).orderBy("doc_id").collect()]
    assert all(np.allclose(a[2:], b[2:], rtol=1e-10) for a, b in zip(whole, parts))


def test_search_takes_odd_rows(spark):
    rng = np.random.default_rng(2)
    big = 9007199254740980
    rows = [(big + i, rng.normal(size=8).astype(float).tolist(), "v", 1) for i in range(90)]
    odd = [(None, rows[0][1], "v", 1), (None, None, None, None), (40, [1.0] * 7, "v", 1), (60, [1.0] * 9, "v", 1), (80, [], "v", 1),
           (100, [None] * 8, "v", 1), (120, [float("inf")] * 8, "v", 1), (140, [0.0] * 8, "v", 1), (None, [1.0] * 7, "v", 2)]
    ties = [(7, rows[5][1], "v", 1), (3, rows[5][1], "v", 1)]
    df = spark.createDataFrame(rows + odd + ties, "vec_id long, embedding array<double>, v string, part int").repartition(3)
    good = {i: np.array(e) for i, e, *_ in rows + ties}
    want = []
    for q in (i for i in good if i % 20 == 0):
        near = sorted(((-float((good[i] * good[q]).sum()), i) for i in good if i != q))[:20]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(near, 1)]
    got = sorted(tuple(r) for r in ann.search(df, F.col("vec_id") % 20 == 0).collect())
    assert [r[:3] for r in got] == [r[:3] for r in sorted(want)] and np.allclose([r[3] for r in got], [r[3] for r in sorted(want)])
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(df.filter("vec_id IS NULL"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("every", [1, 8])
def test_step_order_gives_the_same_sums(every):
    rng = np.random.default_rng(5)
    n = np.array(sorted(rng.integers(1, 40, 30), reverse=True))
    starts = np.cumsum(n) - n
    k = 8
    emit, first, step = rng.random((n.sum(), k)) * 1e-3, rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k)
    alpha, scale = sequences.forward(emit, starts, n, first, step, every)
    active, place, at, text = sequences.by_step(starts, n)
    a = emit[at]
    s = sequences.forward_by_step(a, active, place, n, first, step, every)
    assert np.allclose(a, alpha[at], rtol=1e-12) and np.allclose(s, scale[at], rtol=1e-12)
    assert (text == np.repeat(np.arange(len(n)), n)[at]).all()
    beta = sequences.backward(emit, scale, starts, n, step)
    e = emit[at] / s[:, None]
    b = sequences.backward_by_step(e, active, place, step)
    assert np.allclose(b, beta[at], rtol=1e-12) and np.allclose(e, (emit * beta / scale[:, None])[at], rtol=1e-12)
    # one sequence in two blocks: the first one's last beta is given
    emit, cut, one = rng.random((30, k)), 16, np.array([30])
    alpha, scale = sequences.forward(emit, np.array([0]), one, first, step, every)
    beta = sequences.backward(emit, scale, np.array([0]), one, step)
    active, place, _, _ = sequences.by_step(np.array([0]), np.array([cut]))
    b = sequences.backward_by_step(emit[:cut] / scale[:cut, None], active, place, step, beta[cut - 1])
    assert np.allclose(b, beta[:cut], rtol=1e-12)


def test_counts_of_texts_of_one_token(spark):
    """A group without a second step: each text is one first step, and no step follows another."""
    model = hmm.start_model()
    end = np.array([hmm.SYMBOLS + hmm.CLASSES], np.int32).tobytes()
    got = {r[0]: sum(r[1:]) for r in hmm.expected(spark.createDataFrame([(end,)] * 3, "ids binary").coalesce(1), model).collect()}
    assert abs(got.pop(hmm.SYMBOLS + hmm.CLASSES) - 3) < 1e-9 and abs(got.pop(-1) - 3) < 1e-9
    assert set(got.values()) == {0.0}
    rows = spark.createDataFrame([(1, end)], "doc_id long, ids binary")
    assert abs(hmm.likelihood(rows, model).first().hmm - math.log10(model["first"] @ model["emit"][-1])) < 1e-9
