import random

import pytest

pytest.importorskip("public_tokenizers")

from keelson.llm import catalog, license_notices, licenses  # noqa: E402

NOTICES = [(k, licenses.tokens(v), licenses.tokens(n)) for k, v, n in license_notices.covered()]


def look(words):
    where = licenses.places_of(words)
    return licenses.best([(k, *m, len(t)) for k, t, n in NOTICES for m in licenses.scan(words, t, n, where)])


def changed(template, named, how, rnd):
    out, free = list(template), [i for i, w in enumerate(template) if w not in named]
    count = max(1, len(template) // 20)
    if how == "same" or how != "inserted" and len(template) - count < licenses.COVERAGE * len(template):
        return out  # no word of the shortest notices may be lost
    for i in sorted(rnd.sample(free, min(count, len(free))), reverse=True):
        out[i:i + (how != "inserted")] = [] if how == "missing" else ["zzz"]
    return out


@pytest.mark.parametrize("how", ["same", "inserted", "missing", "changed"])
def test_every_covered_notice_is_found_and_named(how):
    rnd = random.Random(1)
    for license, template, named in NOTICES:
        got = look(["some", "text"] * 10 + changed(template, named, how, rnd) + ["more"] * 20)
        assert [m[0] for m in got] == [license], " ".join(template[:12])


def test_query_covers_full_texts_and_families(spark, tmp_path):
    texts = [(i, k, f"Some text. {v} More text.") for i, (k, v, _) in enumerate(license_notices.covered())]
    texts += [(10_000, None, "A license to the public. Licensed by the authors, version 2. " * 40), (10_001, None, None)]
    spark.createDataFrame(texts, "doc_id long, license string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.license) for r in catalog.op5_license_scan(spark, str(tmp_path)).collect())
    assert got == [(i, k) for i, k, _ in texts if k]
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1",
            "LGPL-3.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0"} <= {k for _, k in got}


def notices_side_by_side(notices):
    for first, a, _ in notices:
        for second, b, _ in notices:
            for between in ([], ["and"], ["see", "also", "the"]):
                at = len(a) + len(between)
                yield a + between + b, [(first, 0, len(a)), (second, at, at + len(b))]


def test_every_ordered_pair_of_notices_is_found_in_its_place():
    own = [(k, licenses.tokens(v), licenses.tokens(licenses.NAMED[k])) for k, v in licenses.TEMPLATES.items()]
    for words, want in notices_side_by_side(own):
        got = licenses.best([(k, *m, len(t)) for k, t, n in own for m in licenses.scan(words, t, n)])
        assert [m[:3] for m in got] == want, " ".join(words)
    one = {k: (k, t, n) for k, t, n in NOTICES[::-1] if len(t) < 50}
    for words, want in notices_side_by_side(list(one.values())):
        assert [m[:3] for m in look(words)] == want, " ".join(words)


def test_full_texts_side_by_side():
    full = [(k, t, n) for k, t, n in NOTICES if len(t) >= 100 and len(t) < 2500]
    for (first, a, _), (second, b, _) in zip(full, full[1:] + full[:1]):
        assert [m[:3] for m in look(a + b)] == [(first, 0, len(a)), (second, len(a), len(a) + len(b))], (first, second)
