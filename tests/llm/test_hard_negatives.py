"""Hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score double, slot string, q array<int>"


def plain(rows, anchor, positives=5, low=30, high=90, k=10):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by the definition."""
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in e], label) for i, e, label in rows
            if i is not None and e is not None and label is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, e, label in good:
        if not anchor(i):
            continue
        scored = sorted(((sum(a * b for a, b in zip(e, f)), j, m) for j, f, m in good if len(f) == len(e)), key=lambda x: (-x[0], x[1]))
        for ps, p, _ in [x for x in scored if x[2] == label and x[1] != i][:positives]:
            near = [x for x in scored if x[2] != label and low * ps <= 100 * x[0] <= high * ps][:k]
            out += [(i, p, n, j, ps, s) for n, (s, j, _) in enumerate(near, 1)]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "r", 0.5, "s", [1]) for r in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, hn.mine(df, F.col("vec_id") % 10 == 0, **more).collect()))


@pytest.mark.parametrize("groups,block", [(1, 1024), (3, 7)])
def test_equals_brute_force(spark, groups, block, monkeypatch):
    rnd = random.Random(groups)
    rows = [(i, [rnd.choice([0.1, 0.25, 0.5, -0.2, 0.3]) for _ in range(6)], rnd.choice([0, 1, 1])) for i in range(300)]
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(40)]  # ties
    rows += [(9007199254740990 + i, rows[20 + i][1], 0) for i in range(5)]
    rows += [(2000, [0.0] * 6, 1), (2010, None, 1), (2020, [None] * 6, 1), (2030, [float("nan")] * 6, 0), (2040, [0.3] * 6, None),
             (None, [0.3] * 6, 0), (2050, [0.3, 0.4], 1), (2060, [0.3, 0.1], 0), (2070, [0.2, 0.3], 1), (2080, [], 1), (2090, [], 0),
             (2100, [float("inf")] * 6, 1), (2110, [-0.5] * 6, 1)]
    monkeypatch.setattr(hn, "ANCHORS", block)
    got = run(spark, rows, groups=groups)
    assert got and got == plain(rows, lambda i: i % 10 == 0)


def test_repeated_rows_and_empty_table(spark):
    rnd = random.Random(4)
    rows = [(i // 2, [rnd.random() for _ in range(4)], i % 3) for i in range(120)] + [(10, [0.5] * 4, 1)] * 2
    got = run(spark, rows)
    assert got == plain(rows, lambda i: i % 10 == 0)
    assert run(spark, []) == [] and run(spark, [(1, [0.5], 1)]) == []


def test_other_windows_and_wide_numbers(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.random() * 1e6 for _ in range(4)], i % 2) for i in range(60)]
    want = plain(rows, lambda i: i % 10 == 0, positives=3, low=10, high=100, k=4)
    assert run(spark, rows, positives=3, low=10, high=100, k=4) == want
    assert (hn.products(np.array([[3.0 * 2 ** 40]]), np.array([[2.0 ** 20]])) == [[3 * 2 ** 60]]).all()
    assert (hn.products(np.array([[2.0 ** 60]]), np.array([[-2.0 ** 60]])) == [[-2 ** 63]]).all()
