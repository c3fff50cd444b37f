import hashlib
import re

from keelson.llm import langid, pii


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute(t):
    out = []
    pats = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for k, p in enumerate(pats):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            ok = [True, k == 1 and all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15][k]
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_base_spans_equal_brute_force(spark):
    texts = [None, "", "é mail a.b@c.d_x@y.z.w@q.r end", "ip 1.2.3.4.5 999.1.1.1 0001.2.3.0255 12345678901234567890.1.1.1",
             "card 4111 1111 1111 1111 and 4111111111111112, 79927398713", "+1 (706) 555-3138 +1 2 (706) 555-3138",
             "0" * 9000, "a" * 30000, "1 " * 5000, "x@y", "+12-", "4111-1111-1111-1111" * 3]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    for r in pii.digest(docs).collect():
        want = brute(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[r.doc_id][:60]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    clean = {r.doc_id: r.text for r in pii.redact(docs.drop("spans")).collect()}
    assert clean[5] == "[PHONE] [PHONE]" and clean[0] is None and clean[1] == ""
    assert pii.digest(docs.limit(0)).count() == 0


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    import keelson.llm.catalog as c
    got = c.op1_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95
    assert sum(r.rejected for r in got) < 0.02 * len(got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !!")], "doc_id long, text string")
    model = langid.train(langid.sample_of(docs))
    assert [(r.lang_pred, r.score) for r in langid.predict(odd, model).collect()] == [("und", 0.0)] * 3
    assert langid.train(langid.sample_of(docs.limit(0))) == {"langs": []}


def test_overlapping_spans_are_redacted_whole(spark):
    texts = ["+1 415-555-1234.jane@x.com", "4111 1111 1111 1111@x.com", "to +1 415-555-1234.jane@x.com or a@b.org now"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert got == {0: "[PHONE]", 1: "[CARD]", 2: "to [PHONE] or [EMAIL] now"}


def test_loose_spans_are_added_and_numbers_of_orders_are_not(spark):
    found = {"please mail jane (at) example.com now": "jane (at) example.com", "call our phone 415-555-2671 today": "415-555-2671",
             "write to bob.x [at] uni [dot] edu": "bob.x [at] uni [dot] edu", "tel (212) 555-0187": "(212) 555-0187",
             "é dial 303.555.0142": "303.555.0142"}
    none = ["order 415-555-2671", "call about invoice no. 415-555-2671", "lot 123-456-7890", "phone list, page 111-222-3333 of 9",
            "meet (at) noon.tomorrow-ish", "card 4111 1111 1111 1112", "server 999.10.10.10", "415-555-2671"]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = [*found, *none]
    planted = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for df in (planted, planted.unionByName(docs)):
        got = {r.doc_id: r.spans for r in pii.digest(df).filter("doc_id < 0").collect()}
        for i, t in enumerate(texts):
            at = [t[int(a):int(b)] for _, a, b in (x.split(":") for x in got[-1 - i].split(",") if x)]
            assert at == ([found[t]] if t in found else []), t
    clean = {r.doc_id: r.text for r in pii.redact(planted).collect()}
    assert clean[-1] == "please mail [EMAIL] now" and clean[-6] == none[0]


def test_reliabilities_follow_the_votes():
    """Simulated votes: the labeler that errs less is trusted more, and a failed check is not outvoted."""
    counts = {(2, 0, 1, 1, 1): 500, (2, 0, 1, 1, -1): 200, (2, 0, 1, -1, 1): 20, (2, 0, -1, -1, -1): 300, (2, 0, -1, 1, 1): 5}
    post, r = pii.reliabilities(counts)
    assert r[2, 0][0] > r[2, 0][1] > r[2, 0][2] >= 0.55
    assert post[2, 0, 1, -1, 1] > 0.5 > post[2, 0, -1, 1, 1] > post[2, 0, -1, -1, -1]
