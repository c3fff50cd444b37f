"""Approximate nearest neighbours by learned partitions.

A bounded sample (``SAMPLE`` rows, smallest hashes of the id) gives an exact neighbour graph, which is cut into
balanced parts by capacity-bound label propagation. A softmax classifier learned on the parts sends every row to its most
probable part and every query to several: the fewest that reach ``TARGET`` recall of the exact neighbours over all rows for
at most ``HELD`` rows kept out of the fit, and more where these parts hold too few candidates. Parts are split into
candidate and query blocks by their counted sizes, so a hot part is many tasks; each pair of blocks is scored
in double precision and the best k of each query over all its blocks stay, ties to the smaller id.
Null and zero vectors, those with null or non-finite components, those of another length than most and rows with a null
id take no part. Rows that repeat an id are candidates each, but not of a query of that id; a query id given twice gets one list
of k rows from the nearest of both, where a candidate near both may stand twice. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE, PARTS, NEIGHBOURS, TARGET, BLOCK, QUERIES = 3000, 12, 10, 0.98, 8000, 1000
HELD = 300  # rows kept out of the fit, at most a tenth of those drawn


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v of the rows that take part; those of another length than most (the longer of equally frequent ones)
    and those with a null id do not."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good & F.exists("v", lambda x: x != 0))
    sizes = v.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.agg(F.max_by("size", F.struct("n", "size")).alias("size")).first()["size"]  # one row
    return v.filter(F.size("v") == F.lit(common))


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Label of each node: breadth-first start, then moves to the part of most neighbours that has room."""
    n, cap = len(graph), -(-len(graph) // parts)
    order, seen = [], np.zeros(n, bool)
    for root in range(n):
        queue = [root]
        while queue:
            i = queue.pop()
            if not seen[i]:
                seen[i] = True
                order.append(i)
                queue += [j for j in graph[i] if not seen[j]]
    label = np.empty(n, int)
    label[order] = np.arange(n) // cap
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), label[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(label, graph.shape[1])), 1)
        room, new = np.full(parts, cap), np.full(n, -1)
        for at in np.argsort(-votes, axis=None, kind="stable"):
            i, p = divmod(int(at), parts)
            if new[i] < 0 and room[p]:
                new[i], room[p] = p, room[p] - 1
        if (new == label).all():
            break
        label = new
    return label


def _logits(x, model):
    return np.tanh(x @ model["a"]) @ model["b"] + x @ model["w"] + model["c"]


def train(sample: np.ndarray, parts: int = PARTS) -> dict:
    n, dim = sample.shape
    parts = max(1, min(parts, n // 50))
    near = sample @ sample.T
    np.fill_diagonal(near, -np.inf)
    k = min(NEIGHBOURS, n - 1)
    graph = np.argsort(-near, axis=1)[:, :k] if k > 0 else np.zeros((n, 0), int)
    label = balanced_parts(graph, parts)
    rng = np.random.default_rng(3)
    m = {"a": rng.normal(0, dim ** -0.5, (dim, 64)), "b": np.zeros((64, parts)), "w": np.zeros((dim, parts)), "c": np.zeros(parts)}
    spread = sample.std() or 1.0
    x = sample / spread
    for step in range(400):
        h = np.tanh(x @ m["a"])
        z = h @ m["b"] + x @ m["w"] + m["c"]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), label] -= 1
        p /= n
        back = (p @ m["b"].T) * (1 - h * h)
        for key, g in (("b", h.T @ p), ("w", x.T @ p), ("c", p.sum(axis=0)), ("a", x.T @ back)):
            m[key] = m[key] - 1.0 * g
    m["a"], m["w"] = m["a"] / spread, m["w"] / spread
    return m


def probes_for(rows: DataFrame, held: np.ndarray, ids: np.ndarray, model: dict, k: int) -> int:
    """The fewest probes that find ``TARGET`` of the exact ``k`` neighbours, over all ``rows``, of the ``held`` queries."""
    parts = len(model["c"])
    if not len(held) or parts == 1:
        return parts

    def run(batches):
        best = None  # query, score, part: the best k of each query so far in this task
        for b in batches:
            if not len(b):
                continue
            v = np.stack(b["v"].to_list())
            score = held @ v.T
            score[ids[:, None] == b["vec_id"].to_numpy()[None, :]] = -np.inf
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            q = np.repeat(np.arange(len(held)), top.shape[1])
            home = _logits(v, model).argmax(axis=1)
            new = pd.DataFrame({"q": q, "score": np.take_along_axis(score, top, 1).ravel(), "part": home[top].ravel()})
            both = new if best is None else pd.concat([best, new])
            best = both[both["score"] > -np.inf].sort_values(["q", "score"], ascending=[True, False], kind="stable").groupby("q").head(k)
        if best is not None:
            yield best

    near = rows.select("vec_id", "v").mapInPandas(run, "q int, score double, part int")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "part"))
    found = near.withColumn("r", rank).filter(F.col("r") <= k).groupBy("q", "part").count().collect()
    probe = np.argsort(np.argsort(-_logits(held, model), axis=1, kind="stable"), axis=1)
    hits = np.zeros(parts)
    for r in found:
        hits[probe[r["q"], r["part"]]] += r["count"]
    share = np.cumsum(hits) / max(1.0, hits.sum())
    return next((p for p in range(1, parts + 1) if share[p - 1] >= TARGET), parts)


def route(vectors: DataFrame, model: dict, probes: int, held: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """Each row with its ``probes`` most probable parts, or with more until they hold (``held`` by part) ``least`` rows."""
    def run(batches):
        for b in batches:
            if len(b):
                top = np.argsort(-_logits(np.stack(b["v"].to_list()), model), axis=1, kind="stable").astype(np.int32)
                many = np.full(len(b), probes)
                if held is not None:
                    many = np.maximum(many, (np.cumsum(held[top], axis=1) < least).sum(axis=1) + 1)
                yield b.assign(part=[t[:n] for t, n in zip(top, many)])

    return vectors.mapInPandas(run, "vec_id long, v array<double>, part array<int>").withColumn("part", F.explode("part"))


def _best(key, q: pd.DataFrame, c: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    if len(q) and len(c):
        qv, cv, cid = np.stack(q["v"].to_list()), np.stack(c["v"].to_list()), c["vec_id"].to_numpy()
        for qid, x, row in zip(q["vec_id"], qv, qv @ cv.T):
            row = np.where(cid == qid, -np.inf, row)
            cut = np.partition(row, -k)[-k] if len(row) > k else -np.inf
            near = np.flatnonzero((row >= cut - 1e-9 * (1 + abs(cut))) & (row > -np.inf)) if cut > -np.inf else np.flatnonzero(row > -np.inf)
            s = (cv[near] * x).sum(axis=1)
            best = np.lexsort((cid[near], -s))[:k]
            out += [(qid, int(cid[near[i]]), float(s[i])) for i in best]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` where ``is_query`` holds."""
    rows = usable(vectors)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE + HELD).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not drawn:
        return rows.sparkSession.createDataFrame([], empty)
    fit = min(SAMPLE, len(drawn) - min(HELD, len(drawn) // 10))
    out, ids = np.array([r["v"] for r in drawn]), np.array([r["vec_id"] for r in drawn])
    model = train(out[:fit])
    probes = probes_for(rows, out[fit:], ids[fit:], model, k)
    index = route(rows, model, 1)
    held = np.zeros(len(model["c"]), np.int64)
    for r in index.groupBy("part").count().collect():  # PARTS rows at most
        held[r["part"]] = r["count"]
    asked = route(rows.filter(is_query), model, probes, held, k + 1)  # a query may be one of its candidates
    size = rows.sparkSession.createDataFrame([(p, -(-int(n) // BLOCK)) for p, n in enumerate(held) if n], "part int, cb int")
    most = asked.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("qb"))
    blocks = F.broadcast(size.join(most, "part"))  # PARTS rows at most
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    c = index.join(blocks, "part").withColumn("cblock", own("cb")).withColumn("qblock", every("qb")).select("part", "cblock", "qblock", "vec_id", "v")
    q = asked.join(blocks, "part").withColumn("qblock", own("qb")).withColumn("cblock", every("cb")).select("part", "cblock", "qblock", "vec_id", "v")
    keys = ["part", "cblock", "qblock"]
    found = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(
        lambda key, a, b: _best(key, a, b, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
