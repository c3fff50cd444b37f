"""Toxic spans by a two-state linear-chain CRF; document scores from its marginals.

Token labels are derived from document labels: a token of a toxic document is labelled when its word
or prefix is far commoner in toxic documents. The CRF (word and prefix weights, transitions) is
trained in numpy on at most ``SAMPLE`` labelled rows of at most ``CHARS`` characters together, cut into blocks of
``BLOCK`` tokens that cover the whole texts. Marginals of whole texts give offending offsets and, through a logistic calibrator, the
score. Null and empty texts have no token and get the calibrator's base score.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.sequences import backward, by_length, forward
from keelson.plans.stages import materialize

SAMPLE, CHARS, BLOCK, EPOCHS, STEPS = 6000, 24_000_000, 64, 30, 400_000
_TOKEN = re.compile(r"[^\W\d_]+")


def _features(word: str):
    return ("w" + word, "p" + word[:4], "q" + word[:5])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def marginals(unary, lengths, model, most=STEPS):
    """P(toxic) of every token; ``lengths`` of the sequences in order, worked on ``most`` tokens at a time."""
    out, begin = np.empty(len(unary)), np.cumsum(lengths) - lengths
    for group in by_length(lengths, most):
        group = group[lengths[group] > 0]
        if not len(group):
            continue
        n = lengths[group]
        starts = np.cumsum(n) - n
        at = np.repeat(begin[group] - starts, n) + np.arange(n.sum())
        p = _sigmoid(unary[at])
        emit = np.stack([1 - p, p], axis=1)
        alpha, scale = forward(emit, starts, n, model["first"], model["step"])
        g = alpha * backward(emit, scale, starts, n, model["step"])
        out[at] = g[:, 1] / g.sum(axis=1)
    return out


def train(sample: DataFrame) -> dict:
    """``sample``: doc_id, text, toxic (bounded). Words are held as numbers, features once for each different word."""
    number, texts, y = {}, [], []
    for r in sample.orderBy("doc_id", "toxic").toLocalIterator():
        found = _TOKEN.findall((r["text"] or "").lower())
        texts.append(np.array([number.setdefault(w, len(number)) for w in found], dtype=np.int32))
        y.append(float(r["toxic"] == 1))
    feats, y, sizes = [_features(w) for w in number], np.array(y), np.array([len(t) for t in texts], dtype=int)
    n, df, seen = [int((y == k).sum()) for k in (0, 1)], [Counter(), Counter()], set()
    for t, k in zip(texts, y):
        if (key := t.tobytes()) not in seen:  # copies count once
            seen.add(key)
            df[int(k)].update({f for w in np.unique(t).tolist() for f in feats[w]})
    odds = {f: np.log((c + 0.1) / (n[1] + 1)) - np.log((df[0][f] + 0.1) / (n[0] + 1)) for f, c in df[1].items() if c >= 3}
    toxic = {f for f, v in odds.items() if v > 3}
    index = {f: i for i, f in enumerate(sorted(f for f in odds if df[1][f] >= 5 or f in toxic))}
    model = {"index": index, "first": np.array([0.99, 0.01]), "step": np.array([[0.99, 0.01], [0.5, 0.5]])}
    weight, bias, ids = np.zeros(len(index) + 1), -4.0, np.concatenate([np.zeros(0, np.int32), *texts])
    of_word = np.array([[index.get(f, len(index)) for f in fs] for fs in feats], dtype=np.int32).reshape(-1, 3)
    if len(ids):
        hot = np.array([any(f in toxic for f in fs) for fs in feats])
        label = (np.repeat(y == 1, sizes) & hot[ids]).astype(float)
        lengths = np.array([min(BLOCK, m - i) for m in sizes.tolist() for i in range(0, m, BLOCK)])
        inner = np.ones(len(ids), bool)
        inner[np.cumsum(lengths) - lengths] = False
        now = np.flatnonzero(inner)
        square = np.full(len(weight), 1e-6)
        # transition factors: the maximum-likelihood bigram odds of the token labels
        step = np.bincount(label[now - 1].astype(np.int8) * 2 + label[now].astype(np.int8), minlength=4).reshape(2, 2) + 1.0
        model["step"] = step / step.sum(axis=1, keepdims=True)
        model["first"] = np.array([1 - label.mean(), label.mean()]) * 0.998 + 0.001
        for _ in range(EPOCHS):
            g = label - marginals((bias + weight[of_word].sum(axis=1))[ids], lengths, model, 1 << 15)
            by_word = np.bincount(ids, g, len(feats))
            grad = sum(np.bincount(of_word[:, j], by_word, len(weight)) for j in range(3)) - 0.01 * weight
            square += grad ** 2
            weight += grad / np.sqrt(square)
            weight[-1] = 0.0
            bias += 0.2 * np.sign(g.sum()) * min(1.0, abs(g.mean()) * 50)
    model |= {"weight": weight, "bias": bias, "doc": np.zeros(3)}
    unary = (bias + weight[of_word].sum(axis=1))[ids]
    x, c = np.array([f for f, _ in _documents(unary, sizes, model)]), np.array([-2.0, 0.0, 0.0])
    for _ in range(3000 if len(x) else 0):
        c += 2.0 * ((y - _sigmoid(x @ c)) @ x) / len(x)
    return model | {"doc": c}


class _Unary(dict):
    def __init__(self, model):
        self.model = model

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        index, weight = self.model["index"], self.model["weight"]
        self[word] = v = self.model["bias"] + sum(weight[index.get(f, len(index))] for f in _features(word))
        return v


def _documents(unary, lengths, model):
    """Per text: calibrator input (1, max marginal, log expected toxic tokens), marginals."""
    p = marginals(unary, lengths, model)
    for part in np.split(p, np.cumsum(lengths)[:-1]) if len(lengths) else ():
        yield (1.0, part.max() if len(part) else 0.0, np.log1p(part.sum())), part


def _score(texts, model, cache):
    return _documents(np.array([cache[w] for ws in texts for w in ws]), np.array([len(w) for w in texts], dtype=int), model)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, predicted, offsets (start:end of tokens whose marginal is at least one half). Each row is scored on
    its own, whatever its id (null, repeated, any long); a null text counts as empty; extra columns are ignored; an empty
    table gives an empty result."""
    def run(batches):
        cache = _Unary(model)
        for b in batches:
            out, whole = [], b.column("text").to_pylist()
            for i in range(0, len(whole), 1000):
                texts = [t or "" for t in whole[i:i + 1000]]
                words = [_TOKEN.findall(t.lower()) for t in texts]
                for t, (f, part) in zip(texts, _score(words, model, cache)):
                    s = float(_sigmoid(np.dot(f, model["doc"])))
                    hot = set(np.flatnonzero(part >= 0.5).tolist())
                    spans = [f"{m.start()}:{m.end()}" for j, m in enumerate(_TOKEN.finditer(t.lower())) if j in hot] if hot else []
                    out.append((s, int(s >= 0.5), ",".join(spans)))
            types = (pa.float64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([r[n] for r in out], t) for n, t in enumerate(types))],
                                             names=["doc_id", "score", "predicted", "offsets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int, offsets string")


def sample_of(docs: DataFrame, labels: DataFrame, n: int = SAMPLE, chars: int = CHARS) -> DataFrame:
    """At most ``n`` labelled rows, smallest hashes first, whole texts of at most ``chars`` characters together:
    rows go by length, so a very long one never displaces the others."""
    some = labels.filter("toxic IS NOT NULL").select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(n)
    rows = materialize(docs.select("doc_id", "text").join(some, "doc_id"), force=True)
    size = F.coalesce(F.length("text"), F.lit(0))
    before = Window.orderBy(size, "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # n rows, those of ``some``
    return rows.withColumn("total", F.sum(size).over(before)).filter(F.col("total") <= chars).drop("total")
