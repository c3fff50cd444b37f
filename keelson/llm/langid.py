"""Language ID: averaged hashed subword embeddings with a linear softmax.

Subwords are byte pairs and triples of the lower-cased text (ASCII non-letters become spaces),
hashed to ``BUCKETS``. Training: SGD in numpy on at most ``SAMPLE`` labelled rows (smallest hashes of
doc_id); a fifth of them calibrates a temperature and the rejection threshold. Null texts and texts
with no letter are ``und`` with score 0. Without labelled rows every text is ``und``. Extra columns have no part in a
prediction; repeated rows get equal predictions; an id with several labelled rows counts once in training.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, DIM, SAMPLE, EPOCHS = 8192, 16, 2000, 12
_MAP = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BLOCK = 1 << 20


def features(text: str) -> np.ndarray:
    """Mean subword counts of the whole text."""
    raw = np.frombuffer((" " + text + " ").encode("utf-8", "replace").translate(_MAP), np.uint8)
    out = np.zeros(BUCKETS)
    for i in range(0, len(raw), BLOCK):
        b = raw[i:i + BLOCK + 2].astype(np.uint32)
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(263) + b[2:] + np.uint32(77)
        for g in (two[:BLOCK], three[:BLOCK]):
            out += np.bincount((g * np.uint32(2654435761)) >> np.uint32(19), minlength=BUCKETS)
    return out / max(1.0, out.sum())


def has_letter(text) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _softmax(z):
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(sample: DataFrame) -> dict:
    """``sample``: doc_id, text, lang (bounded). The model: languages, weights, temperature, threshold."""
    def run(batches):
        for b in batches:
            b = b[b["text"].map(has_letter)]
            yield pd.DataFrame({"lang": b["lang"], "f": [features(t).astype(np.float32).tobytes() for t in b["text"]]})

    rows = sample.select("lang", "text").mapInPandas(run, "lang string, f binary").collect()  # 32 KiB a row
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return {"langs": []}
    rows = sorted((r["lang"], bytes(r["f"])) for r in rows)
    np.random.default_rng(5).shuffle(rows)
    x = np.array([np.frombuffer(f, np.float32) for _, f in rows])
    y = np.array([langs.index(a) for a, _ in rows])
    rng = np.random.default_rng(7)
    emb, w, bias = rng.normal(0, 0.1, (BUCKETS, DIM)), rng.normal(0, 0.1, (DIM, len(langs))), np.zeros(len(langs))
    held = np.arange(len(y)) % 5 == 0 if len(y) >= 20 else np.zeros(len(y), bool)
    fit = np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        rate = 20.0 * (1 - epoch / EPOCHS)
        for at in np.array_split(rng.permutation(fit), max(1, len(fit) // 32)):
            h = x[at] @ emb
            g = _softmax(h @ w + bias)
            g[np.arange(len(at)), y[at]] -= 1
            g /= len(at)
            back = x[at].T @ (g @ w.T)
            w -= rate / 20 * (h.T @ g)
            bias -= rate / 20 * g.sum(axis=0)
            emb -= rate * back
    score = emb @ w
    check = np.flatnonzero(held) if held.any() else fit
    z = x[check] @ score + bias
    ts = np.geomspace(0.2, 8, 25)
    loss = [-np.log(_softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in ts]
    t = float(ts[int(np.argmin(loss))])
    low = float(np.quantile(_softmax(z / t).max(axis=1), 0.001))
    return {"langs": langs, "score": score / t, "bias": bias / t, "reject_below": min(0.5, low)}


def sample_of(docs: DataFrame, n: int = SAMPLE) -> DataFrame:
    """At most ``n`` labelled rows, one for each id, smallest hashes first; ids are picked before texts are read."""
    rows = docs.filter("lang IS NOT NULL").select("doc_id", "text", "lang")
    some = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    one = rows.join(some, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r"))
    return one.select("doc_id", "r.text", "r.lang").orderBy("doc_id")


def guess(model: dict):
    """The prediction as a function of a text column: struct of lang_pred, score and rejected."""
    def one(text):
        if not model["langs"] or not has_letter(text):
            return "und", 0.0, True
        p = _softmax(features(text) @ model["score"] + model["bias"])
        return model["langs"][int(p.argmax())], float(min(p.max(), 1.0)), bool(p.max() < model["reject_below"])

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in text], columns=["lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score and rejected; the calibrated score is the largest probability."""
    return docs.select("doc_id", guess(model)("text").alias("g")).select("doc_id", "g.lang_pred", "g.score", "g.rejected")


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is not rejected."""
    return docs.filter(~guess(model)("text").getField("rejected"))
