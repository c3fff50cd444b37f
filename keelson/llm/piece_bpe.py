"""SentencePiece (merge type) encoding by a prefix table.

The pieces of a text's prefix are the pieces of a shorter prefix plus one last piece, so a table of each prefix's last
piece holds the whole encoding. An automaton finds the pieces that end at a place; the one whose pair with the last piece
before it is compatible (merging both together gives these two again) is the prefix's last piece, and the ids are read
backwards from the end of the text. Compatibility is tested by undoing merges at the seam, the last made first: a pair
that would have merged before the merge now undone is incompatible.

Where no piece holds a space after another character, words encode separately; the ids of ``CACHE`` words and the
tests of ``PAIRS`` pairs are kept for each process. Normalisation and decoding are the library's own. A null text counts as empty (no ids). Only the text travels
through Python, so ids of any size, null ids, repeated rows and extra columns stay as they are; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import hashlib
import re
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 300_000  # words kept; the cache starts again beyond it
STEP = 1_000_000  # characters encoded together
LONGEST = 64  # longer words are not kept
PAIRS = 400_000  # tested pairs kept, likewise
SPACE = "▁"


def merge_all(symbols: list[str], rank: dict[str, int]):
    """The symbols left and the last merge made, always merging the pair of best rank, the leftmost of equal ones."""
    symbols, last = list(symbols), None
    while True:
        best = min(((rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in rank), default=None)
        if best is None:
            return symbols, last
        i = best[1]
        last = symbols[i], symbols[i + 1]
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]


class PieceModel:
    """A merge-type model file of the sentencepiece library: ``encode`` (any texts) and the library's ``decode``."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = n = lib.get_piece_size()
        if any(lib.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        plain = {lib.id_to_piece(i): i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))}
        byte_id = {int(lib.id_to_piece(i)[3:-1], 16): i for i in range(n) if lib.is_byte(i)}
        scores = {s: r for r, s in enumerate(sorted({lib.get_score(i) for i in plain.values()}, reverse=True))}
        rank = {p: scores[lib.get_score(i)] for p, i in plain.items() if len(p) > 1}
        self._unknown = lambda c: [byte_id[b] for b in c.encode("utf-8")] if byte_id else [lib.unk_id()]
        # codes: the id of a piece; characters that only occur inside pieces get codes beyond the ids
        letters = sorted({c for p in plain for c in p})
        code = dict(plain)
        for c in letters:
            code.setdefault(c, n + len(code))
        top = max(code.values(), default=0) + 1
        self.emit = {k: self._unknown(c) for c, k in code.items() if k >= n}
        self.size, self.order, self.left, self.right = [1] * top, [-1] * top, [-1] * top, [-1] * top
        self.merged: dict[int, int] = {}
        self.tested = 0
        self.shift = top.bit_length()
        self.automaton = ahocorasick.Automaton()
        for c in letters:
            self.automaton.add_word(c, (1, {-1: True}, code[c]))
        for p, r in rank.items():
            whole, last = merge_all(list(p), rank)
            if whole != [p]:
                continue  # never made by merging
            a, b = code[last[0]], code[last[1]]
            if max(rank.get(last[0], -1), rank.get(last[1], -1)) > r:
                raise ValueError(f"piece {p!r} ranks before its parts")
            k = code[p]
            # twice the rank: an odd bound lets a pair of equal rank win, see compatible()
            self.size[k], self.order[k], self.left[k], self.right[k] = len(p), 2 * r, a, b
            self.merged[a << self.shift | b] = 2 * r
            self.automaton.add_word(p, (len(p), {-1: True}, k))
        if letters:
            self.automaton.make_automaton()
        self.separate = not any(SPACE in p.lstrip(SPACE) for p in plain)
        self.words: dict[str, tuple] = {}
        self.names = [str(i) for i in range(n)]

    def compatible(self, u: int, v: int) -> bool:
        """True when merging the texts of the pieces ``u`` and ``v`` together gives ``u``, ``v`` again."""
        bound, merged, order, shift = 1 << 62, self.merged, self.order, self.shift
        while True:
            at = merged.get(u << shift | v)
            if at is not None and at < bound:
                return False
            x, y = order[u], order[v]
            if x > y:  # the left piece was made last; an equal pair at the seam lies further right and comes after it
                bound, u = x, self.right[u]
            elif y >= 0:  # of equal ranks the right one is made last, and an equal pair at the seam comes before it
                bound, v = y + 1, self.left[v]
            else:
                return True

    def last_pieces(self, s: str) -> list[int]:
        """For each prefix of ``s`` (normalised) the code of its last piece, by the prefix's last place; -1 for a
        character of no piece, and at the end, where place -1 finds it, for the empty prefix."""
        last = [-1] * (len(s) + 1)
        if not len(self.automaton):
            return last
        for end, (size, fits, k) in self.automaton.iter(s):
            if last[end] < 0:
                p = last[end - size]
                fit = fits.get(p)
                if fit is None:
                    fit = fits[p] = self.compatible(p, k)
                    self.tested += 1
                if fit:
                    last[end] = k
        if self.tested >= PAIRS:
            self.tested = 0
            for _, fits, _ in self.automaton.values():
                fits.clear()
                fits[-1] = True
        return last

    def word_ids(self, s: str) -> tuple:
        last, out, i, n, size = self.last_pieces(s), [], len(s) - 1, self.n, self.size
        while i >= 0:
            k = last[i]
            if 0 <= k < n:
                out.append(k)
                i -= size[k]
            else:
                out.extend(reversed(self.emit[k] if k >= 0 else self._unknown(s[i])))
                i -= 1
        return tuple(reversed(out))

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of whole texts."""
        cut = [self.library.normalize(t or "") for t in texts]
        cut = [_WORDS.findall(s) for s in cut] if self.separate else [[s] if s else [] for s in cut]
        these = set().union(*cut)
        new = [w for w in these if w not in self.words]
        if len(self.words) + len(new) > CACHE:
            self.words = {w: self.words[w] for w in these if w in self.words}
        self.words.update((w, self.word_ids(w)) for w in new)
        out = [list(chain.from_iterable(map(self.words.__getitem__, ws))) for ws in cut]
        for w in new:
            if len(w) > LONGEST:
                del self.words[w]
        return out


_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@functools.lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def _steps(texts: pd.Series):
    """The texts in lists of about ``STEP`` characters."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t or "")
        if size >= STEP:
            yield some
            some, size = [], 0
    yield some


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text_col`` in the array column ``out``."""
    @F.pandas_udf("array<int>")
    def run(text: pd.Series) -> pd.Series:
        m = model(path)
        return pd.Series([ids for some in _steps(text) for ids in m.encode(some)], dtype=object)

    return docs.withColumn(out, run(text_col))


def encode_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 (the library's decode of the ids) for every whole text."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(text: pd.Series) -> pd.DataFrame:
        m, rows = model(path), []
        for some in _steps(text):
            for ids in m.encode(some):
                rows.append((len(ids), hashlib.sha256(",".join(map(m.names.__getitem__, ids)).encode()).hexdigest(),
                             hashlib.sha256(m.library.decode(ids).encode("utf-8")).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", run("text").alias("p")).select("doc_id", "p.n_tokens", "p.ids_sha256", "p.decoded_sha256")
