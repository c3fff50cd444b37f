"""License scan by patience alignment of whole texts with notice templates.

Anchors are words unique to both the text and the template; the longest increasing subsequence of
their places is kept and the gaps are aligned the same way; a gap without anchors is matched from the side where an
anchor stands. A match covers ``COVERAGE`` of the template within
``SPREAD`` times its length and holds every word that names the license (``NAMED``): a notice of another version or
of another license is no match. Matches do not overlap (``best``). Null text counts as empty. ``TEMPLATES`` holds four
short notices, ``license_notices.covered`` the licenses that the registered query looks for.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: short license notices
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}
# fixed values: the words that tell a license from others of its family
NAMED = {"Apache-2.0": "Apache 2 0", "CC-BY-NC-4.0": "CC BY NC 4 0", "GPL-3.0": "GNU General 3", "MIT": "MIT"}
COVERAGE, SPREAD = 0.8, 2.0
STRAY = 0.25  # what a word between aligned ones takes from a match when far words at its ends are left off
_WORD = re.compile(r"[^\W_]+")


def tokens(text: str) -> list[str]:
    return [m.group().lower() for m in _WORD.finditer(text)]


def align(a: list[str], b: list[str], a0=0, a1=None, b0=0, b1=None, left=False, right=False) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), both increasing. ``left`` and ``right``: an anchor stands at that side."""
    a1, b1 = len(a) if a1 is None else a1, len(b) if b1 is None else b1
    if a0 >= a1 or b0 >= b1:
        return []
    in_b = Counter(b[b0:b1])
    in_a = Counter(w for w in a[a0:a1] if w in in_b)
    once = {w for w, n in in_b.items() if n == 1 and in_a[w] == 1}
    place = {b[j]: j for j in range(b0, b1) if b[j] in once}
    pairs = [(i, place[a[i]]) for i in range(a0, a1) if a[i] in once]
    tails, piles, back = [], [], []
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        tails[at:at + 1], piles[at:at + 1] = [j], [n]
        back.append(piles[at - 1] if at else -1)
    chain, n = [], piles[-1] if piles else -1
    while n >= 0:
        chain.append(pairs[n])
        n = back[n]
    chain = chain[::-1]
    if not chain:  # equal ends of a gap without anchors, those beside an anchor first; no anchor at one side: only the other
        head, tail, size = [], [], b1 - b0
        while right and a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            tail.append((a1, b1))
        while (left or not right) and a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            head.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while not left and not right and a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            tail.append((a1, b1))
        rest = align(a, b, a0, a1, b0, b1, left, right) if b1 - b0 < size else []
        return head + rest + tail[::-1]
    out, i0, j0 = [], a0, b0
    for i, j in [*chain, (a1, b1)]:
        out += align(a, b, i0, i, j0, j, left, right or i < a1)
        if i < a1:
            out.append((i, j))
        i0, j0, left = i + 1, j + 1, True
    return out


def dense(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The run of pairs with the most words aligned less ``STRAY`` for each word between: without far words at the ends."""
    most, value, first, run = 0.0, 0.0, 0, (0, 0)
    for n, (i, _) in enumerate(pairs):
        value -= STRAY * (i - pairs[n - 1][0] - 1) if n else 0
        if value < 0:
            value, first = 0.0, n
        value += 1
        if value >= most:
            most, run = value, (first, n + 1)
    return pairs[run[0]:run[1]]


def scan(words: list[str], template: list[str], named: list[str] = (), where: dict | None = None) -> list[tuple]:
    """Matches (first word, last word + 1, coverage), found around each place of the rarest word that a match must
    hold, or, where nothing is named, of as many template words as no match can miss all."""
    where = places_of(words) if where is None else where
    if len(words) < COVERAGE * len(template) or not all(w in where for w in named):
        return []
    need = Counter(template)
    if sum(min(n, len(where.get(w, ()))) for w, n in need.items()) < COVERAGE * len(template):
        return []
    by_rare = sorted(named or need, key=lambda w: (len(where.get(w, ())), w))
    rare, missed = [], 0
    for w in by_rare:
        rare.append(w)
        missed += need[w]
        if named or missed > len(template) - COVERAGE * len(template):
            break
    reach, out, end = int(SPREAD * len(template)), [], 0
    for at, w, left, right in sorted((at, w, left, right) for w in rare if w in where for at, left, right in
                                     zip(where[w], [-1, *where[w]], [*where[w][1:], len(words)])):
        apart = need[w] == 1  # then two places of the word belong to two notices
        lo, hi = (left + 1, right) if apart else (0, len(words))
        if at < end:
            continue
        lo, hi = max(end, lo, at - reach), min(hi, at + reach + 1)
        j = template.index(w)
        got = align(words, template, lo, at, 0, j, right=True) + [(at, j)]
        got += align(words, template, at + 1, hi, j + 1, left=True)
        if not apart:  # the place may be a later one of the word
            free = align(words, template, lo, hi)
            got = max(got, free, key=lambda pairs: len(dense(pairs)))
        for run in (dense(got), got):
            held = {template[j] for _, j in run}
            if (len(run) >= COVERAGE * len(template) and run[-1][0] - run[0][0] < SPREAD * len(template)
                    and all(n in held for n in named)):
                out.append((run[0][0], run[-1][0] + 1, len(run) / len(template)))
                end = run[-1][0] + 1
                break
    return out


def places_of(words: list[str]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(w, []).append(i)
    return out


def best(found: list[tuple]) -> list[tuple]:
    """Of overlapping matches (license, first, end, coverage, template words) the one with the most words matched
    less missing, less half of the inserted ones, stays."""
    def worth(m):
        _, first, end, coverage, n = m
        return coverage * n - (1 - coverage) * n - (end - first - coverage * n) / 2

    out = []
    for m in sorted(found, key=lambda m: (-round(worth(m), 6), m[2] - m[1], m[0], m[1])):
        if all(m[2] <= s or e <= m[1] for _, s, e, _, _ in out):
            out.append(m)
    return sorted(out, key=lambda m: m[1])


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, named: dict[str, str] = NAMED,
                  notices: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """One row per match: doc_id, license, start, end (code points), coverage. ``notices`` (license, text, words that
    must match) holds any number for a license and stands in for ``templates`` and ``named``. Each row is scanned on its
    own, whatever its id (null, repeated, any long); null and empty texts and empty tables give no rows; extra columns are
    ignored."""
    notices = notices or [(k, v, named.get(k, "")) for k, v in templates.items()]

    def run(batches):
        own = [(k, tokens(v), tokens(n)) for k, v, n in notices]
        for b in batches:
            out = []
            for row, text in enumerate(b.column("text").to_pylist()):
                places = list(_WORD.finditer(text or ""))
                words = [m.group().lower() for m in places]
                where = places_of(words)
                found = [(k, *m, len(t)) for k, t, n in own for m in scan(words, t, n, where)]
                out += [(row, k, places[s].start(), places[e - 1].end(), c) for k, s, e, c, _ in best(found)]
            if out:
                rows, *cols = zip(*out)
                types = (pa.string(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(rows)), *map(pa.array, cols, types)],
                                                 names=["doc_id", "license", "start", "end", "coverage"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, license string, start long, end long, coverage double")
