"""Best-fit packing of tokenised documents into sequences of at most ``size`` tokens.

Spark tokenises, counts pieces by length and numbers the pieces of each length. The plan is made on
the length histogram (at most ``size`` rows whatever the input): best-fit decreasing over classes
of bins with equal contents, then swap-based local search that moves or exchanges documents (one for
one, two for one) from the emptiest bins into bins as full or fuller, each step raising the squared fill,
until the lower bound is met or no class of bins has a step left. Null text counts as empty (one end token). Ids travel
beside the texts as they are: null, repeated and large ids stay; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections import Counter
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.alignment import byte_letters
from keelson.plans.stages import materialize

_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xff]*")  # normalising such text is lower-casing
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\s\x01a-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
CACHE = 300_000  # parts between blanks whose ids a process keeps; the cache starts again beyond it
STEP = 1_000_000  # characters encoded together
LONGEST = 64  # longer parts are not kept


def word_ranks(tok):
    """The vocabulary as ranks of the tiktoken library, where a null character ends a word and the character 1 stands
    between parts (no plain text holds either); None unless it is a byte-level BPE with word ends whose merges make
    rising ids."""
    import tiktoken

    spec, letters = json.loads(tok.to_str()), byte_letters()
    m, added = spec["model"], {t["content"] for t in spec["added_tokens"]}
    if m["type"] != "BPE" or m.get("end_of_word_suffix") != "</w>" or m.get("continuing_subword_prefix"):
        return None
    ids = [m["vocab"]["".join(x.split(" ") if isinstance(x, str) else x)] for x in m["merges"]]
    ranks, least = {}, min(ids, default=0)
    for entry, i in m["vocab"].items():
        if entry not in added:
            body = entry.removesuffix("</w>")
            ranks[bytes(letters[c] for c in body) + b"\0" * (body != entry)] = i
    single = [ranks.get(bytes([b]) + e, least) for b in range(256) for e in (b"", b"\0")]
    if ids != sorted(set(ids)) or max(single) >= least or len(ranks) != len(ids) + 512:
        return None
    return tiktoken.Encoding("words", pat_str=r"[^\x00\x01\s]+\x00|\x01", mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, as the library's plain call gives them.

    No token holds a blank, so the parts between blanks encode separately. A text that may name a special token goes to the
    library whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.ranks = word_ranks(self.tok)
        self.parts: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in got]

    def _encode_parts(self, new: list[str]) -> dict[str, bytes]:
        if self.ranks and new:
            joined = "\1".join(new)
            plain = new if _PLAIN.fullmatch(joined.replace("\1", " ")) and joined.count("\1") == len(new) - 1 else [
                p for p in new if _PLAIN.fullmatch(p)]
        if not self.ranks or not new or not plain:
            return dict(zip(new, self.library(new)))
        words = _WORD.sub("\\g<0>\0", "\1".join(plain).lower())
        ids = np.array(self.ranks.encode_ordinary(words + "\1"), dtype="<u4")
        between = ids == self.ranks.encode_single_token(b"\1")
        stops = (4 * (np.flatnonzero(between) - np.arange(len(plain)))).tolist()
        flat = ids[~between].tobytes()
        out = {p: flat[s:e] for p, s, e in zip(plain, [0, *stops], stops)}
        odd = [p for p in new if p not in out] if len(out) < len(new) else []
        return out | dict(zip(odd, self.library(odd)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [t.split(" ") if t and "<|" not in t else [] for t in texts]
        these = set().union(*cut)
        new = [p for p in these if p not in self.parts]
        if len(self.parts) + len(new) > CACHE:
            self.parts = {p: self.parts[p] for p in these if p in self.parts}
        self.parts.update(self._encode_parts(new))
        out = [b"".join(map(self.parts.__getitem__, ps)) for ps in cut]
        for p in new:
            if len(p) > LONGEST:
                del self.parts[p]
        whole = [n for n, t in enumerate(texts) if t and "<|" in t]
        for n, ids in zip(whole, self.library([texts[n] for n in whole])):
            out[n] = ids
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


_PIECES = ["piece", "start", "length", "ids_crc32"]
_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, size: int = 4096, end_id: int = 1) -> DataFrame:
    """A row for each piece of each text with its end id: doc_id, piece, start, length, ids_crc32."""
    end, wide = np.array([end_id], dtype="<u4").tobytes(), 4 * size

    def cut(texts, enc):
        for n, ids in enumerate(enc.encode(texts)):
            ids = memoryview(ids + end)
            for p, s in enumerate(range(0, len(ids), wide)):
                part = ids[s:s + wide]
                yield n, p, s // 4, len(part) // 4, zlib.crc32(part)

    def run(batches):
        enc = encoder(path)
        for b in batches:
            sizes = np.cumsum(pa.compute.fill_null(pa.compute.utf8_length(b.column("text")), 0).to_numpy(zero_copy_only=False))
            stops = [*np.flatnonzero(np.diff(sizes // STEP)) + 1, b.num_rows]
            for s, e in zip([0, *stops], stops):
                out = list(cut(b.column("text").slice(s, e - s).to_pylist(), enc))
                if out:
                    at, *cols = (np.array(c, np.int64) for c in zip(*out))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(s, e - s).take(pa.array(at)), pa.array(cols[0].astype(np.int32)),
                                                      *map(pa.array, cols[1:])], names=["doc_id", *_PIECES])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DDL)


def best_fit(hist: dict[int, int], size: int) -> list[list]:
    """Classes [number of bins, contents {length: items}] by best-fit decreasing."""
    free: dict[int, list] = {size: []}
    for length in sorted(hist, reverse=True):
        left = hist[length]
        while left:
            r = min((r for r, c in free.items() if r >= length and c), default=None)
            fits = (r or size) // length
            many, have = free[r].pop() if r is not None else (max(1, left // fits), {})
            use = min(many, left // fits)
            k = fits if use else left
            use = use or 1
            if many > use:
                free[r].append((many - use, have))
            free.setdefault((r or size) - k * length, []).append((use, have | {length: k}))
            left -= use * k
    return [[n, dict(have)] for cs in free.values() for n, have in cs]


def _fill(have) -> int:
    return sum(x * k for x, k in have)


class _Targets:
    """What each class of bins can take: one row for each length it may give back (or none)."""

    def __init__(self, size: int):
        self.size, self.used, self.where = size, 0, {}
        self.rows = np.zeros((4, 1024), np.int64)  # class, given length, most tokens it takes for that, fill; -1: gone
        self.names: list[tuple] = []

    def add(self, have: tuple) -> None:
        room, give = self.size - _fill(have), [0, *(x for x, _ in have)]
        if room <= 0:
            return
        if self.used + len(give) > self.rows.shape[1]:
            live = self.rows[:, :self.used]
            live = live[:, live[0] >= 0]
            order = list(dict.fromkeys(live[0].tolist()))
            new = {c: n for n, c in enumerate(order)}
            self.names = [self.names[c] for c in order]
            live[0] = [new[c] for c in live[0].tolist()]
            self.used, width = live.shape[1], max(1024, 2 * (live.shape[1] + len(give)))
            self.rows = np.zeros((4, width), np.int64)
            self.rows[:, :self.used] = live
            self.where, at = {}, 0
            for h in self.names:
                self.where[h] = (at, at + 1 + len(h))
                at += 1 + len(h)
        a, b = self.used, self.used + len(give)
        self.rows[:, a:b] = [[len(self.names)] * len(give), give, [room + g for g in give], [self.size - room] * len(give)]
        self.names.append(have)
        self.where[have], self.used = (a, b), b

    def drop(self, have: tuple) -> None:
        if have in self.where:
            a, b = self.where.pop(have)
            self.rows[0, a:b] = -1
            self.rows[3, a:b] = -1  # no fuller class than any

    def best(self, have: tuple, alone: bool):
        """(target, lengths taken, length given) of largest gain for a bin ``have``, into bins at least as full."""
        groups = {x: (x,) for x, _ in have}
        for n, (x, k) in enumerate(have):
            for y, _ in have[n + (k < 2):]:
                groups.setdefault(x + y, (x, y))
        sums = np.array(sorted(groups), np.int64)
        name, give, limit, fill = self.rows[:, :self.used]
        at = np.searchsorted(sums, limit, side="right") - 1
        gain = np.where((at >= 0) & (fill >= _fill(have)), sums[at] - give, 0)
        if alone and have in self.where:
            gain[slice(*self.where[have])] = 0
        if not len(gain) or gain.max() <= 0:
            return None
        row = int(gain.argmax())
        return self.names[name[row]], groups[int(sums[at[row]])], (int(give[row]),) if give[row] else ()


def local_search(classes: list[list], size: int) -> list[list]:
    """Sweeps from the emptiest class up until a whole sweep finds no step. A step is made in as many pairs of bins of
    the two classes as there are; a class without a step is left for the next one."""
    count: dict[tuple, int] = {}
    targets = _Targets(size)

    def put(have: tuple, n: int) -> None:
        if have and n:
            if have not in count:
                targets.add(have)
            count[have] = count.get(have, 0) + n

    def take_out(have: tuple, n: int) -> None:
        count[have] -= n
        if not count[have]:
            del count[have]
            targets.drop(have)

    def change(have, take, give) -> tuple:
        out = Counter(dict(have))
        out.update(take)
        out.subtract(give)
        return tuple(sorted((x, k) for x, k in out.items() if k))

    for n, have in classes:
        put(tuple(sorted(have.items())), n)
    bins, least = sum(count.values()), -(-sum(n * _fill(h) for h, n in count.items()) // size)
    moved = True
    while moved and bins > least:
        moved, heap = False, [(_fill(h), h) for h in count]
        heapify(heap)
        while heap and bins > least:
            source = heappop(heap)[1]
            if source not in count:
                continue
            step = targets.best(source, count[source] == 1)
            if step is None:
                continue
            moved = True
            target, take, give = step
            many = count[source] // 2 if target == source else min(count[source], count[target])
            take_out(source, many)
            take_out(target, many)
            left, filled = change(source, give, take), change(target, take, give)
            for have in (left, filled):
                put(have, many)
            bins -= 0 if left else many
            for have in {left, filled, source, target}:
                if have in count:
                    heappush(heap, (_fill(have), have))
    return [[n, dict(h)] for h, n in count.items()]


def plan(hist: dict[int, int], size: int) -> dict[int, np.ndarray]:
    """length -> rows (first rank, items a bin, first bin, first offset), by rank."""
    rows, used, base = {}, {}, 0
    for n, have in local_search(best_fit(hist, size), size):
        at = 0
        for length, k in sorted(have.items(), reverse=True):
            rows.setdefault(length, []).append((used.get(length, 0), k, base, at))
            used[length] = used.get(length, 0) + n * k
            at += k * length
        base += n
    return {x: np.array(v, dtype=np.int64) for x, v in rows.items()}


def pack(docs: DataFrame, path: str, size: int = 4096, end_id: int = 1) -> DataFrame:
    parts = materialize(pieces(docs, path, size, end_id), force=True)
    hist = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = plan(hist, size)
    salts = max(16, sum(hist.values()) // 50_000)
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (parts.withColumn("i", F.row_number().over(order)).join(first, ["length", "salt"])
              .withColumn("rank", F.col("first") + F.col("i") - 1))

    def place(batches):
        for b in batches:
            seq, off = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            for x in np.unique(length):
                m, rows = length == x, where[int(x)]
                row = rows[np.searchsorted(rows[:, 0], rank[m], side="right") - 1]
                i = rank[m] - row[:, 0]
                seq[m], off[m] = row[:, 2] + i // row[:, 1], row[:, 3] + i % row[:, 1] * x
            cols = ["doc_id", *_PIECES]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(seq), pa.array(off)],
                                             names=[*cols, "sequence_id", "offset"])

    return ranked.select("doc_id", *_PIECES, "rank").mapInArrow(place, _DDL + ", sequence_id long, offset long")
