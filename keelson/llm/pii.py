"""Personal data by weak supervision, with DataFrame functions only.

Candidates are the base matches, base matches that fail a check, and looser ones (``(at)`` and ``(dot)``
addresses, phone numbers without a country code). Three labelers vote yes, no or abstain on each: the strict rule
(abstains on loose candidates), a gazetteer (top-level domains, address ranges, issuer prefixes, calling and area codes by
their numbering rules) and words before it (a kind's own words for, words of orders, invoices and versions against).
Expectation-maximisation over the counts of vote patterns (at most 96 rows, whatever the input) estimates priors
and reliabilities for each kind and form; its posteriors train a logistic span classifier, which is
applied as a column expression. Base matches stay; accepted candidates that touch no base match are
added. By the limits ``CAPS`` and ``PRIOR_MOST`` a failed check is not outvoted, and a loose number needs both other
votes; a loose address needs a known domain or a word for it. Null text counts as empty; a repeated row counts and
is answered as often as it comes; an empty table gives an empty result. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.plans.stages import materialize

KINDS = ("email", "ip", "card", "phone")
# possessive forms of the contract's patterns; the lookbehinds stop rescans of long runs
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
_DOMAIN = r"(?i)[.)\]] ?(?:com|org|net|edu|gov|mil|int|info|biz|name|pro|app|dev|[a-z]{2})$"
_CALLING = (r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
            r"|(?:2[1-689]|3[578]|42|5[09]|6[7-9]|8[058]|9[679])[0-9])")
# (yes, no) by kind, on the match without separators (emails as they are); neither: abstain
GAZETTEER = {
    "email": (_DOMAIN, "."),
    "ip": (r"^(?:10|127|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168)\.", r"^(?:0|22[4-9]|2[3-9][0-9]|[3-9][0-9][0-9])"),
    "card": (r"^(?:4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3[068]|35|6011|62|64[4-9]|65)", "."),
    "phone": (_CALLING, "."),
}
_AREA = (r"^[2-9](?!11)[0-8][0-9][2-9](?!11)[0-9]{6}", ".")  # ten digits without a country code
CONTEXT = {"email": r"mail|contact|write|reach", "ip": r"\bip\b|server|host|address", "card": r"card|visa|credit|payment",
           "phone": r"phone|call|\btel|mobile|fax|dial"}
AGAINST = r"order|invoice|ticket|serial|tracking|version|release|build|isbn|\bsku\b|\bitem|\bpart\b|\bsection|\blot\b|\bref\b|\bno\."
EM_ROUNDS, FIT_ROUNDS, PSEUDO = 50, 30, 20
# strict rule, gazetteer, context: reliability before any vote (``PSEUDO`` votes strong), least and most
BEFORE, LEAST, CAPS = (0.999, 0.75, 0.8), (0.95, 0.55, 0.55), (0.999, 0.9, 0.9)
PRIOR_MOST = {"email": 0.5, "phone": 0.2}  # of loose candidates; base forms: 0.9


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), value), F.lit(0), lambda a, v: a + v)
    return F.coalesce(total % 10 == 0, F.lit(False))


def _strict(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _near(kind: str, match: Column) -> Column:
    """Which matches of the base pattern are candidates at all."""
    if kind == "card":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(12, 19)
    return F.lit(True)


def _listed(kind: str, match: Column, strict: bool) -> Column:
    """Vote of the gazetteer: 1, -1 or 0 (abstains)."""
    yes, no = GAZETTEER[kind] if strict or kind == "email" else _AREA
    bare = F.regexp_replace(match, "[^0-9.]" if kind == "ip" else "[^0-9]", "") if kind != "email" else match
    return F.when(bare.rlike(yes), 1).when(bare.rlike(no), -1).otherwise(0)


def _said(kind: str, before: Column) -> Column:
    """Vote of the 32 characters before: the later of a word for and a word against decides."""
    words = F.lower(F.right(before, F.lit(32)))
    return F.when(words.rlike(f"(?s)(?:{CONTEXT[kind]})(?!.*(?:{AGAINST}))"), 1).when(words.rlike(AGAINST), -1).otherwise(0)


def _found(text: Column, kind: str, pattern: str, strict: bool) -> Column:
    """Candidates of one pattern with offsets: text between matches comes from split()."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zipped = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,loose:boolean,base:boolean,gaz:int,ctx:int>>")

    def step(acc, x):
        start = acc["pos"] + F.length(x["g"])
        end = start + F.length(x["h"])
        span = F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), end.alias("end"),
                        F.lit(not strict).alias("loose"), (_strict(kind, x["h"]) if strict else F.lit(False)).alias("base"),
                        _listed(kind, x["h"], strict).alias("gaz"), _said(kind, x["g"]).alias("ctx"))
        out = F.when(_near(kind, x["h"]), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("pos"), out.alias("out"))

    got = F.aggregate(zipped, F.struct(F.lit(0).cast("bigint").alias("pos"), empty.alias("out")), step)["out"]
    return F.when(F.size(hits) > 0, got).otherwise(empty)


def found_in(text: Column) -> Column:
    """Spans of a text, sorted by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    every = F.concat(*[_found(text, k, p, True) for k, p in BASE.items()], *[_found(text, k, p, False) for k, p in LOOSE.items()])
    names = ("start", "kind", "end", "loose", "base", "gaz", "ctx")
    return F.array_sort(F.transform(every, lambda s: F.struct(*[s[n].alias(n) for n in names])))


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def reliabilities(counts: dict) -> tuple[dict, dict]:
    """EM over {(kind, loose, votes of the three labelers): count}: posterior of each pattern, and reliabilities of the
    labelers by (kind, loose)."""
    post, forms = {}, {p[:2]: [p2 for p2 in counts if p2[:2] == p[:2]] for p in counts}
    r = {f: list(BEFORE) for f in forms}
    for f, patterns in forms.items():
        most = PRIOR_MOST[KINDS[f[0]]] if f[1] else 0.9
        prior, total = min(0.5, most), sum(counts[p] for p in patterns)
        for _ in range(EM_ROUNDS):
            for p in patterns:
                odds = prior / (1 - prior)
                for a, v in zip(r[f], p[2:]):
                    odds *= (a / (1 - a)) ** v
                post[p] = odds / (1 + odds)
            for i in range(3):
                voted = [p for p in patterns if p[2 + i]]
                agreed = sum(counts[p] * (post[p] if p[2 + i] > 0 else 1 - post[p]) for p in voted)
                got = (PSEUDO * BEFORE[i] + agreed) / (PSEUDO + sum(counts[p] for p in voted))
                r[f][i] = min(CAPS[i], max(LEAST[i], got))
            prior = min(most, max(0.05, (sum(counts[p] * post[p] for p in patterns) + 1) / (total + 2)))
    return post, r


def _clear(s: Column) -> Column:
    """The span touches no base match of ``found``."""
    return ~F.exists("found", lambda b: b["base"] & (b["start"] < s["end"]) & (s["start"] < b["end"]))


def train(found: DataFrame) -> list[list[float]]:
    """Weights of the span classifier, by kind and form (base, loose): bias, then one for each vote."""
    strict = F.when(F.col("loose"), 0).when(F.col("base"), 1).otherwise(-1).alias("strict")
    open_ = F.filter("found", lambda s: ~s["loose"] | _clear(s))  # loose ones on a base match can't be added
    votes = found.select(F.inline(open_)).groupBy("kind", F.col("loose").cast("int").alias("loose"), strict, "gaz", "ctx").agg(
        F.count("*").alias("n"))
    counts = {tuple(x[:5]): x["n"] for x in votes.collect()}
    post, _ = reliabilities(counts)
    weights = [[-1.0, 0.0, 0.0, 0.0] for _ in range(2 * len(KINDS))]
    for f in {p[:2] for p in counts}:
        patterns = sorted(p for p in counts if p[:2] == f)
        n = np.array([counts[p] for p in patterns], float)
        share = n / n.sum() / 2 + 1 / (2 * len(n))  # half by count, half for each pattern, so that rare ones are learned
        x, y = np.array([(1, *p[2:]) for p in patterns], float), np.array([post[p] for p in patterns])
        w = np.zeros(4)
        for _ in range(FIT_ROUNDS):
            q = np.array([_sigmoid(z) for z in x @ w])
            step = np.linalg.solve((x.T * (share * q * (1 - q))) @ x + 1e-4 * np.eye(4), x.T @ (share * (y - q)) - 1e-4 * w)
            w = w + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        weights[2 * f[0] + f[1]] = w.tolist()
    return weights


def spans(found: DataFrame) -> tuple[Column, Column]:
    """The base spans and all spans, as columns of ``found`` (a table with the column ``found``)."""
    w = train(found)

    def accepted(s):
        form = s["kind"] * 2 + s["loose"].cast("int") + 1
        weight = lambda i: F.element_at(F.array(*[F.lit(float(row[i])) for row in w]), form)
        strict = F.when(s["loose"], 0).when(s["base"], 1).otherwise(-1)
        return weight(0) + weight(1) * strict + weight(2) * s["gaz"] + weight(3) * s["ctx"] >= 0.0

    base = F.filter("found", lambda s: s["base"])
    return base, F.filter("found", lambda s: s["base"] | (accepted(s) & _clear(s)))


def _joined(a) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans; a row for every row of ``docs``."""
    found = materialize(docs.select("doc_id", found_in(F.col("text")).alias("found")), force=True)
    base, every = spans(found)
    rows = found.select("doc_id", base.alias("base"), every.alias("spans"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return rows.select("doc_id", *[count(k) for k in range(4)],
                       F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping spans by the first one's); n_chars follows a changed text. Rows travel whole
    beside their spans, so repeated or null ids and any extra columns stay as they are."""
    held = materialize(docs.select(F.struct("*").alias("doc"), found_in(F.col("text")).alias("found")), force=True)
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    old = F.col("doc").getField("text")

    def step(acc, s):
        new = F.concat(acc["out"], F.substring(old, acc["pos"] + 1, s["start"].cast("int") - acc["pos"]), F.element_at(marks, s["kind"] + 1))
        end = s["end"].cast("int")
        both = F.struct(F.greatest(acc["pos"], end).alias("pos"), acc["out"].alias("out"))  # overlapping spans go as one
        return F.when(s["start"] >= acc["pos"], F.struct(end.alias("pos"), new.alias("out"))).otherwise(both)

    rows = held.select("doc", spans(held)[1].alias("spans"))
    done = F.aggregate("spans", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step)
    changed = F.size("spans") > 0
    text = F.concat(done["out"], F.substring(old, done["pos"] + 1, F.length(old)))
    rows = rows.select("doc", F.when(changed, text).otherwise(old).alias("new"), changed.alias("changed"))
    out = {c: F.col("doc").getField(c) for c in docs.columns}
    if "n_chars" in out:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("changed"), F.length("new").cast(kind)).otherwise(out["n_chars"])
    return rows.select(*[c.alias(n) for n, c in (out | {"text": F.col("new")}).items()])
