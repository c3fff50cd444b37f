"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Tokenizer A is a byte-level BPE file of the tokenizers library (encodes a space and the text, special tokens' strings as
plain text), B a merge-type model of the sentencepiece library (adds that space itself). Each text is an interval of
tokens; a cut is a byte offset where a token of both ends. An interval is halved at the cut nearest its middle, each
candidate end of A being looked up in the ends of B by bisect, until no interval has a cut inside: these are the groups.
All intervals of many texts are halved together, in arrays. Inside groups, tokens whose bytes overlap are linked. Words
that both tokenizers encode separately are aligned once while a process keeps them.

How many documents hold a pair of ids linked is counted over the whole corpus: tasks number the pairs of each block of
texts (``BLOCK`` characters; a longer text is a block), so that the shuffle carries a row for each pair and block, and the
counts return to the block. The highest count of each id of A (as many numbers as A has ids) goes to the tasks.

A text that is null, empty or not given back byte by byte by both tokenizers has no tokens: zeros and an empty digest.
Each row is a document of its own, whatever its id (repeated, null or any long); extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.plans.stages import materialize

BLOCK = 4_000_000  # characters of texts that share one numbering of pairs
STEP = 250_000  # characters aligned together
CACHE = 250_000  # words whose alignment each process keeps; the cache starts again beyond it
LONGEST = 64  # longer words are not kept


def byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable ones stand for themselves, others follow from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _plain_byte_level(spec: dict) -> bool:
    """True for a byte-level BPE without normaliser whose merges make ids in rising order: the ids are merge ranks, which
    the tiktoken library encodes by, several times faster on single words."""
    if spec["normalizer"] or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["model"]["type"] != "BPE":
        return False
    pre, model = spec["pre_tokenizer"], spec["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    return (pre.get("use_regex", True) and not pre.get("add_prefix_space") and not model.get("ignore_merges")
            and ids == sorted(set(ids)) and len(ids) + 256 == len(set(model["vocab"]) - {t["content"] for t in spec["added_tokens"]}))


class Pair:
    """Both tokenizers with the bytes of their tokens. ``pattern`` is the byte-level split of A."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        import sentencepiece
        from tokenizers import Tokenizer

        a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        a.encode_special_tokens = True
        letters, entries = byte_letters(), {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}
        self.na, self.nb = max(entries, default=-1) + 1, self.b.get_piece_size()
        as_bytes = lambda t: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode("utf-8")
        self.a_bytes = [as_bytes(entries.get(i, "")) for i in range(self.na)]
        self.encode_a = lambda parts: [e.ids for e in a.encode_batch_fast(parts, add_special_tokens=False)]
        spec = json.loads(a.to_str())
        if _plain_byte_level(spec):
            import tiktoken

            ranks = {as_bytes(t): i for t, i in spec["model"]["vocab"].items()}
            added = {t["content"].encode("utf-8") for t in spec["added_tokens"]}
            ranks = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={t: i for t, i in ranks.items() if t not in added}, special_tokens={})
            self.encode_a = lambda parts: [ranks.encode_ordinary(p) for p in parts]
        pieces = [self.b.id_to_piece(i) for i in range(self.nb)]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                        for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # no piece holds a space after another character, and spaces stay as they are: words encode separately
        self.separate = not any("▁" in p.lstrip("▁") for p in pieces) and self.b.normalize(" a  b ") == "▁▁a▁▁b▁"
        a, b = [str(i) for i in range(self.na)], [str(i) for i in range(self.nb)]
        self.words = ["," + x for x in a] + [";" + x for x in a] + ["," + x for x in b] + ["|" + x for x in b]
        self.kept: dict[str, tuple] = {}

    def parts(self, text: str) -> list[str]:
        """A space and the text, cut before each space after a character that is surely none: both tokenizers start a
        token there, whatever stands beside."""
        if not self.separate:
            return [" " + text]
        out, at, safe = [], "", False
        for w in text.split(" "):
            if safe:
                out.append(at)
                at = " " + w
            else:
                at += " " + w
            c = w[-1:]
            safe = "!" <= c <= "~" or c.isalnum()
        out.append(at)
        return out

    def align_parts(self, parts: list[str]) -> list:
        """For each part (n_a, n_b, n_groups, n_links, groups, links); None where the bytes of A or B differ from it."""
        ids_a = self.encode_a(parts)
        ids_b = self.b.encode([p[1:] for p in parts], num_threads=1)
        same = [b"".join(map(self.a_bytes.__getitem__, a)) == t == b"".join(map(self.b_bytes.__getitem__, b))
                for a, b, t in zip(ids_a, ids_b, (p.encode("utf-8") for p in parts))]
        r = align([a for a, ok in zip(ids_a, same) if ok], [b for b, ok in zip(ids_b, same) if ok], self)
        links, stops = (r["a"][r["link_a"]] * self.nb + r["b"][r["link_b"]]).astype("<i8"), np.cumsum(r["n_links"]).tolist()
        got = zip(r["na"].tolist(), r["nb"].tolist(), r["n_groups"].tolist(), r["n_links"].tolist(), group_texts(r, self),
                  (links[s:e].tobytes() for s, e in zip([0, *stops], stops)))
        return [next(got) if ok else None for ok in same]

    def align_texts(self, texts: list[str]) -> list[tuple]:
        """Of each text the same as of a part; zeros and empty where it has no tokens."""
        cut = [self.parts(t) if t else [] for t in texts]
        these = set().union(*cut)
        new = [p for p in these if p not in self.kept]
        if len(self.kept) + len(new) > CACHE:
            self.kept = {p: self.kept[p] for p in these if p in self.kept}
        self.kept.update(zip(new, self.align_parts(new) if new else []))
        out = []
        for t, ps in zip(texts, cut):
            got = list(map(self.kept.__getitem__, ps))
            if None in got and len(got) > 1:
                got = self.align_parts([" " + t])
            if not got or None in got:
                out.append((0, 0, 0, 0, "", b""))
            else:
                na, nb, groups, links, text, codes = zip(*got)
                out.append((sum(na), sum(nb), sum(groups), sum(links), ";".join(text), b"".join(codes)))
        for p in new:
            if len(p) > LONGEST:
                del self.kept[p]
        return out


@functools.lru_cache(maxsize=2)
def pair(a_path: str, b_path: str, pattern: str) -> Pair:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Pair(a_path, b_path, pattern)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
    """(tokens of A, tokens of B) that end together, as two rows. ``last_a`` and ``last_b`` number the last tokens of each
    text, which do. Ends are rising offsets over all texts."""
    found = [np.stack([last_a, last_b])]
    # an interval: tokens lo..hi of A and blo..bhi of B, whose last ones end together; tried: ends looked up so far
    lo, hi, blo, bhi = np.r_[0, last_a[:-1] + 1], last_a, np.r_[0, last_b[:-1] + 1], last_b
    tried = np.zeros(len(lo), np.int64)
    while True:
        # without an end inside in A or in B, or with all ends inside looked up: a group
        more = (tried < hi - lo) & (bhi > blo)
        lo, hi, blo, bhi, tried = lo[more], hi[more], blo[more], bhi[more], tried[more]
        if not len(lo):
            return np.concatenate(found, axis=1)
        away = (tried + 1) // 2  # middle, one right, one left, two right ...
        at = lo + (hi - lo - 1) // 2 + np.where(tried % 2 == 1, away, -away)
        other = np.searchsorted(ends_b, ends_a[at])  # bisect
        cut = ends_b[other] == ends_a[at]
        if cut.any():
            found.append(np.stack([at[cut], other[cut]]))
        miss = ~cut
        lo, hi, blo, bhi, tried = (np.concatenate(x) for x in (
            (lo[miss], lo[cut], at[cut] + 1), (hi[miss], at[cut], hi[cut]),
            (blo[miss], blo[cut], other[cut] + 1), (bhi[miss], other[cut], bhi[cut]),
            (tried[miss] + 1, np.zeros(2 * int(cut.sum()), np.int64))))


def align(ids_a: list, ids_b: list, p: Pair) -> dict:
    """Of texts with tokens: flat ids, group of each token, token numbers of each link, and the counts of each text."""
    na, nb = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.fromiter((i for x in ids for i in x), np.int64, int(n.sum())) for ids, n in ((ids_a, na), (ids_b, nb)))
    ends_a, ends_b = np.cumsum(p.a_len[a]), np.cumsum(p.b_len[b])
    last_a, last_b = np.cumsum(na) - 1, np.cumsum(nb) - 1
    cuts = shared_cuts(ends_a, ends_b, last_a, last_b)
    stop_a, stop_b = np.sort(cuts[0]), np.sort(cuts[1])
    group_a, group_b = np.searchsorted(stop_a, np.arange(len(a))), np.searchsorted(stop_b, np.arange(len(b)))
    # bytes between neighbouring ends of either lie in one token of each: a link
    inner = np.ones(len(b), bool)
    inner[stop_b] = False
    ends = np.sort(np.concatenate([ends_a, ends_b[inner]]), kind="stable")
    groups = np.searchsorted(stop_a, last_a, side="right")
    n_groups = np.diff(np.r_[0, groups])
    return {"a": a, "b": b, "na": na, "nb": nb, "group_a": group_a, "group_b": group_b, "stop_a": stop_a, "stop_b": stop_b,
            "link_a": np.searchsorted(ends_a, ends), "link_b": np.searchsorted(ends_b, ends),
            "n_groups": n_groups, "n_links": na + nb - n_groups}


def group_texts(r: dict, p: Pair) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text."""
    a, b = r["a"], r["b"]
    start_a, start_b = np.r_[0, r["stop_a"] + 1], np.r_[0, r["stop_b"] + 1]
    first_a, first_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    first_a[start_a[:-1]] = first_b[start_b[:-1]] = True
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + start_b[r["group_a"]]] = a + np.where(first_a, p.na, 0)
    out[np.arange(len(b)) + start_a[r["group_b"] + 1]] = 2 * p.na + b + np.where(first_b, p.nb, 0)
    stops = np.cumsum(r["na"] + r["nb"])
    return ["".join(map(p.words.__getitem__, out[s:e].tolist()))[1:] for s, e in zip(np.r_[0, stops[:-1]], stops)]


_ROWS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.binary()),
                   ("docs", pa.binary())])
_DDL = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, "
        "pairs binary, docs binary")


def _steps(batches) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about ``STEP`` characters at a time."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
            ids.append(i)
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= STEP:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _block(number: int, rows: list, codes: list) -> pa.RecordBatch:
    """Rows of one block: its documents with their links as places in the block's pairs, then the pairs themselves."""
    flat = np.concatenate(codes)
    pairs, place = np.unique(flat, return_inverse=True)
    n_links = np.array([r[4] for r in rows], np.int64)
    doc = np.repeat(np.arange(len(rows)), n_links)
    held = np.bincount(np.unique(doc * max(1, len(pairs)) + place) % max(1, len(pairs)), minlength=len(pairs))
    place, stops = place.astype("<u4"), np.cumsum(n_links)
    out = [(number, *r, place[e - r[4]:e].tobytes(), None, None) for r, e in zip(rows, stops.tolist())]
    out.append((number, None, 0, 0, 0, 0, None, None, pairs.astype("<i8").tobytes(), held.astype("<i8").tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ROWS)], schema=_ROWS)


def aligned(docs: DataFrame, a_path: str, b_path: str, pattern: str) -> DataFrame:
    """A row for each document (links as places in the pairs of its block) and one for each block (its pairs, and how many
    of its documents hold each). The numbering of a block holds for the rows of one run: write them before use."""
    def run(batches):
        p, rows, codes, size = pair(a_path, b_path, pattern), [], [], 0
        number = TaskContext.get().partitionId() << 32
        for ids, texts in _steps(batches):
            for i, (*n, text, links) in zip(ids, p.align_texts(texts)):
                rows.append((i, *n, hashlib.sha256(text.encode()).hexdigest() if text else ""))
                codes.append(np.frombuffer(links, "<i8"))
            size += sum(map(len, texts))
            if size >= BLOCK:
                yield _block(number, rows, codes)
                number, rows, codes, size = number + 1, [], [], 0
        if rows:
            yield _block(number, rows, codes)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DDL)


def pair_rows(rows: DataFrame) -> DataFrame:
    """block, place, pair, docs: the pairs of each block."""
    def run(batches):
        for b in batches:
            for block, pairs, docs in zip(*(b.column(c).to_pylist() for c in ("block", "pairs", "docs"))):
                pairs, docs = np.frombuffer(pairs, "<i8"), np.frombuffer(docs, "<i8")
                for s in range(0, len(pairs), 50_000):
                    part = pairs[s:s + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), block)), pa.array(np.arange(s, s + len(part), dtype=np.int32)),
                         pa.array(part), pa.array(docs[s:s + 50_000])], names=["block", "place", "pair", "docs"])

    return rows.filter("pairs IS NOT NULL").select("block", "pairs", "docs").mapInArrow(
        run, "block long, place int, pair long, docs long")


def digest(docs: DataFrame, a_path: str, b_path: str, pattern: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every whole text."""
    p = pair(a_path, b_path, pattern)
    na, nb = p.na, p.nb
    rows = materialize(aligned(docs, a_path, b_path, pattern), force=True)
    total = F.sum("docs").over(Window.partitionBy("pair"))
    counts = materialize(pair_rows(rows).select("block", "place", "pair", total.alias("count")), force=True)
    highest = np.zeros(na, np.int64)  # a number for each id of A
    for r in counts.groupBy(F.floor(F.col("pair") / nb).alias("a")).agg(F.max("count").alias("most")).collect():
        highest[r["a"]] = r["most"]

    # only arrays and numbers travel with the functions, not the tokenizers
    def finish(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        place = pairs.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        count[place] = pairs.column("count").to_numpy()
        best[place] = pairs.column("count").to_numpy() == highest[pairs.column("pair").to_numpy() // nb]
        links = [np.frombuffer(x, "<u4") for x in docs.column("links").to_pylist()]
        sums = pa.table({"n_best": pa.array([int(best[x].sum()) for x in links], pa.int64()),
                         "count_sum": pa.array([int(count[x].sum()) for x in links], pa.int64())})
        out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
        return pa.table([*out.columns, *sums.columns], names=[*out.column_names, *sums.column_names])

    texts = rows.filter("pairs IS NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    out = texts.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(
        finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
