import numpy as np
from pyspark.sql import functions as F

from keelson.llm import ann


def exact(ids, x, q, k):
    s = x @ x[ids == q][0]
    s[ids == q] = -np.inf
    return set(ids[np.lexsort((ids, -s))[:k]])


def test_recall_on_a_table_of_several_samples(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 300)
    monkeypatch.setattr(ann, "HELD", 60)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = [i for i in ids if i % 20 == 0]
    assert len(ids) > 5 * ann.SAMPLE
    assert sum(len(exact(ids, x, q, 20) & got[q]) for q in asked) >= 0.9 * 20 * len(asked)


def test_queries_of_small_parts_get_all_k(spark, monkeypatch):
    # one small far-off cluster: its part holds fewer than k rows, other parts must be searched too
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 1, (4, 16)) * 4
    x = np.concatenate([c + rng.normal(0, 0.2, (n, 16)) for c, n in zip(centre, (150, 150, 150, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    model = {"a": np.zeros((16, 1)), "b": np.zeros((1, 4)), "w": centre.T, "c": -(centre ** 2).sum(axis=1) / 2, "probes": 1}
    monkeypatch.setattr(ann, "train", lambda sample, parts=4: model)
    monkeypatch.setattr(ann, "TARGET", 0.0)  # one probe
    count = {}
    for r in ann.search(df, F.col("vec_id") >= 440).collect():
        count[r.query_id] = count.get(r.query_id, 0) + 1
    assert len(count) == len(x) - 440 and set(count.values()) == {20}
