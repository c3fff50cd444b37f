"""Hidden Markov language model.

Token counts cover the whole training corpus (a table; the ``HEAD`` commonest words also go to the
tasks, the others are joined). The ``SYMBOLS`` commonest words and the end token are symbols of their own; each other word is
emitted as its suffix class times its share of the class (the same smoothing as the base model). Baum-Welch:
every round each partition adds up expected counts of its texts, Spark sums them by symbol. The score is
the exact scaled forward likelihood. Null text counts as empty: its only token is the end. Rows are told apart by a
number of their own, so repeated or null ids are scored row by row; a row with a null ``held`` is not learned from.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.sequences import backward_by_step, by_length, by_step, forward, forward_by_step
from keelson.plans.stages import materialize

STATES, SYMBOLS, CLASSES, HEAD, ROUNDS, STEPS = 8, 8192, 64, 131_072, 3, 160_000
EVERY = 8  # steps between normalisations of the forward sums
WORDS = 300_000  # different words a task counts before it passes them on
END = b" "  # no word holds a space


def words(text) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split() + [END]


def word_class(w: bytes) -> int:
    return zlib.crc32(w[-3:]) % CLASSES


def token_counts(docs: DataFrame) -> DataFrame:
    """word, cls, c. A task counts all its texts together, at most ``WORDS`` different words at a time."""
    def run(batches):
        c = Counter()

        def counted():
            return pd.DataFrame({"word": list(c), "n": list(c.values()), "cls": [word_class(w) for w in c]})

        for b in batches:
            for t in b["text"]:
                c.update(words(t))
                if len(c) >= WORDS:
                    yield counted()
                    c.clear()
        yield counted()

    return (docs.select("text").mapInPandas(run, "word binary, n long, cls int")
            .groupBy("word", "cls").agg(F.sum("n").alias("c")))


def vocabulary(counts: DataFrame) -> dict:
    """Bounded part of the model: head words, totals, class normalisers."""
    top = counts.orderBy(F.desc(F.col("word") == F.lit(bytearray(END))), F.desc("c"), "word").limit(HEAD).collect()
    head = {bytes(r["word"]): r["c"] for r in top}
    own = [w for w in head if w != END][:SYMBOLS]
    per = counts.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    n, v = sum(r["n"] for r in per), sum(r["v"] for r in per)
    mass = np.full(CLASSES, 0.1)
    for r in per:
        mass[r["cls"]] += r["n"] + 0.1 * r["v"]
    for w in [*own, END]:
        if w in head:
            mass[word_class(w)] -= head[w] + 0.1
    return {"head": head, "symbol": {w: i for i, w in enumerate(own)}, "n": n, "v": v, "mass": np.log10(np.maximum(mass, 0.1))}


def encode(docs: DataFrame, vocab: dict, held: Column) -> DataFrame:
    """doc_id, held_out, symbol ids, totals of head words, and the other words with their counts. Only the text travels
    through Python."""
    head, symbol, mass = vocab["head"], vocab["symbol"], vocab["mass"]
    base = float(np.log10(vocab["n"] + 0.1 * (vocab["v"] + 1)))
    end = SYMBOLS + CLASSES
    # by the place of a word in the head: its symbol, count, log count, and share of its class where it has no symbol
    code = {w: n for n, w in enumerate(head)}
    code.setdefault(END, len(code))
    count = np.array([head.get(w, 0) for w in code], np.float64)
    sym = np.array([end if w == END else symbol.get(w, SYMBOLS + word_class(w)) for w in code], np.int32)
    log_count = np.log10(count + 0.1)
    in_class = (sym >= SYMBOLS) & (sym < end)
    share = np.where(in_class, log_count - mass[np.where(in_class, sym - SYMBOLS, 0)], 0.0)

    def one(text):
        ws = words(text)
        at = np.fromiter(map(code.get, ws, repeat(-1)), np.int32, len(ws))
        other = np.flatnonzero(at < 0)
        known = at if not len(other) else at[at >= 0]
        ids = sym[at]
        total, rest = float(share[known].sum()), Counter()
        if len(other):
            far = [ws[i] for i in other.tolist()]
            rest.update(far)
            classes = [word_class(w) for w in far]
            ids[other] = [SYMBOLS + c for c in classes]
            total -= float(mass[classes].sum())
        return (len(ws), int((count[known] > 0).sum()), float(log_count[known].sum()) - base * len(ws), total, ids.tobytes(),
                list(rest), list(rest.values()))

    names = ["n_tokens", "known", "base", "share", "ids", "rest", "rest_n"]

    @F.pandas_udf("n_tokens long, known long, base double, share double, ids binary, rest array<binary>, rest_n array<long>")
    def run(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in text], columns=names)

    return docs.select("doc_id", held.alias("held_out"), run("text").alias("p")).select("doc_id", "held_out", "p.*")


def _groups(b):
    """Texts of at most ``STEPS`` tokens in groups of about as many; a longer text is a group of its own."""
    ids = [np.frombuffer(x, np.int32) for x in b]
    lengths = np.array([len(x) for x in ids])
    for group in by_length(lengths, STEPS):
        n = lengths[group]
        yield group, np.concatenate([ids[i] for i in group]), np.cumsum(n) - n, n


def _blocks(ids: np.ndarray):
    return [ids[s:s + STEPS] for s in range(0, len(ids), STEPS)]


def _long_forward(ids: np.ndarray, model: dict):
    """A long text in blocks: of each block its symbols, the state distribution before it, and its log10 likelihood."""
    first, out = model["first"], []
    for part in _blocks(ids):
        alpha, scale = forward(model["emit"][part], np.array([0]), np.array([len(part)]), first, model["step"], EVERY)
        out.append((part, first, float(np.log10(scale).sum())))
        first = alpha[-1] @ model["step"]
    return out


def start_model(k: int = STATES) -> dict:
    rng = np.random.default_rng(11)
    m = SYMBOLS + CLASSES + 1
    emit = rng.dirichlet(np.full(m, 5.0), k)
    return {"first": np.full(k, 1 / k), "step": np.full((k, k), 0.05 / (k - 1)) + np.eye(k) * (0.95 - 0.05 / (k - 1)), "emit": emit.T.copy()}


def expected(codes: DataFrame, model: dict) -> DataFrame:
    """Expected counts, a row for each symbol (-1: first states; -2-i: transitions from state i)."""
    def run(batches):
        k, m = model["step"].shape[0], len(model["emit"])
        by_symbol, trans, first = np.zeros((m, k)), np.zeros((k, k)), np.zeros(k)

        def add(ids, starts, n, begin, last=None):
            """Adds the group's counts; returns the alphas of its last place, and of its first steps the weight of each
            state's step into them and the marginals."""
            active, place, at, _ = by_step(starts, n)
            ids = ids[at]
            weight = model["emit"][ids]
            alpha = weight.copy()
            weight /= forward_by_step(alpha, active, place, n, begin, model["step"], EVERY)[:, None]
            beta = backward_by_step(weight, active, place, model["step"], last)
            width = np.array(active, int)
            before = np.arange(active[0], len(ids)) - np.repeat(width[:-1], width[1:])
            nonlocal trans
            trans = trans + model["step"] * (alpha[before].T @ weight[active[0]:])
            end = alpha[-1].copy()
            alpha *= beta
            for s in range(k):
                by_symbol[:, s] += np.bincount(ids, alpha[:, s], m)
            return end, weight[:active[0]], alpha[:active[0]]

        for b in batches:
            for _, ids, starts, n in _groups(b["ids"]):
                if len(ids) <= STEPS or len(n) > 1:
                    first += add(ids, starts, n, model["first"])[2].sum(axis=0)
                    continue
                weight = last = None  # of a long text block by block from the end, its alphas made again from the block's start
                for part, begin, _ in reversed(_long_forward(ids, model)):
                    end, into, gamma = add(part, np.array([0]), np.array([len(part)]), begin, last)
                    if weight is not None:
                        trans = trans + model["step"] * np.outer(end, weight)
                    weight = into[0]
                    last = model["step"] @ weight
                first += gamma[0]
        keys = np.concatenate([np.flatnonzero(by_symbol.any(axis=1)), [-1], -2 - np.arange(k)])
        vals = np.concatenate([by_symbol[by_symbol.any(axis=1)], first[None], trans])
        yield pd.DataFrame({"symbol": keys} | {f"s{i}": vals[:, i] for i in range(k)})

    cols = [f"s{i}" for i in range(model["step"].shape[0])]
    return (codes.select("ids").mapInPandas(run, "symbol long, " + ", ".join(f"{c} double" for c in cols))
            .groupBy("symbol").agg(*[F.sum(c).alias(c) for c in cols]))


def baum_welch(codes: DataFrame, rounds: int = ROUNDS) -> dict:
    model = start_model()
    for _ in range(rounds):
        k, m = model["step"].shape[0], len(model["emit"])
        counts = np.full((m, k), 0.01)
        first, trans = np.full(k, 0.1), np.full((k, k), 0.1)
        for r in expected(codes, model).collect():  # at most SYMBOLS + CLASSES + STATES + 2 rows
            v = np.array(r[1:])
            if r[0] >= 0:
                counts[r[0]] += v
            elif r[0] == -1:
                first += v
            else:
                trans[-2 - r[0]] += v
        model = {"first": first / first.sum(), "step": trans / trans.sum(axis=1, keepdims=True), "emit": counts / counts.sum(axis=0)}
    return model


def likelihood(codes: DataFrame, model: dict) -> DataFrame:
    """``codes`` without ids, with hmm: the log10 likelihood of the symbols."""
    @F.pandas_udf("double")
    def run(b: pd.Series) -> pd.Series:
        out = np.zeros(len(b))
        for group, ids, starts, n in _groups(b):
            if len(ids) > STEPS and len(n) == 1:
                out[group] = sum(x for _, _, x in _long_forward(ids, model))
                continue
            active, place, at, text = by_step(starts, n)
            scale = forward_by_step(model["emit"][ids[at]], active, place, n, model["first"], model["step"], EVERY)
            out[group] = np.bincount(text, np.log10(scale), len(n))
        return pd.Series(out)

    return codes.withColumn("hmm", run("ids")).drop("ids")


def score(docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Learns where ``held`` is false."""
    counts = materialize(token_counts(docs.filter(~held)), force=True)
    vocab = vocabulary(counts)
    codes = materialize(encode(docs, vocab, held).withColumn("row", F.monotonically_increasing_id()), force=True)
    model = baum_welch(codes.filter("NOT held_out"))
    rest = codes.select("row", F.inline(F.arrays_zip("rest", "rest_n")))
    rest = (rest.join(counts.select(F.col("word").alias("rest"), "c"), "rest", "left").groupBy("row")
            .agg(F.sum(F.col("rest_n") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("more"),
                 F.sum(F.when(F.col("c") > 0, F.col("rest_n")).otherwise(0)).alias("more_known")))
    out = likelihood(codes, model).join(rest, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(vocab["n"]).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
                      (F.col("hmm") + F.col("share") + more).alias("score"))
