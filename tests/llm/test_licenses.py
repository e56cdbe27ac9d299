import math
import re

import pytest
from fixtures import corpus, frame

from tripdeck.llm import licenses as lc


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return list(zip(w, w[1:], w[2:], strict=False))


def brute(rows, share=0.8):
    out = {}
    for name, text in lc.TEMPLATES:
        held = set(shingles(text))
        width = max(4, 2 ** math.ceil(math.log2(2 * len(held))))
        for i, t in rows:
            p = shingles(t)
            found = [(len(held & set(p[s:s + width])) / len(held), s)
                     for s in range(0, len(p), width // 2)]
            found = [(x, s) for x, s in found if x >= share]
            if found:
                out[i, name] = (round(max(found)[0], 6), min(s for _, s in found), len(found))
    return out


@pytest.mark.parametrize("limit", [50_000, 100])
def test_matches_exact_containment(spark, monkeypatch, limit):
    monkeypatch.setattr(lc, "LITERAL_SHINGLES", limit)
    rows = corpus(8, 30)
    for k, (_, text) in enumerate(lc.TEMPLATES):
        rows.append((2000 + k, f"some words before. {text.upper()} and some after " + "z " * k))
        rows.append((3000 + k, text.replace(" the ", " a ", 1)))
    rows += [(4000, "All rights reserved. " * 50), (4001, "all"), (4002, "rights reserved")]
    out = lc.scan_licenses(frame(spark, rows), lc.template_table(spark)).collect()
    got = {(r.doc_id, r.license): (r.containment, r.first_word, r.windows) for r in out}
    assert got == brute(rows) and len(out) == len(got)
    assert {n for i, n in got if 2000 <= i < 3000} == {n for n, _ in lc.TEMPLATES}


def test_native_plan_odd_rows_and_empty_tables(spark):
    docs = frame(spark, [(1, None), (None, "All rights reserved"), (2, "All rights reserved"),
                         (2, "All rights reserved")])
    out = lc.scan_licenses(docs, lc.template_table(spark))
    assert [(r.doc_id, r.license, r.windows) for r in out.collect()] == [(2, "all-rights-reserved", 1)]
    assert "Python" not in out._jdf.queryExecution().toString()
    assert lc.scan_licenses(frame(spark, []), lc.template_table(spark)).collect() == []
    none = spark.createDataFrame([(None, "a b c"), ("x", None), ("y", "one two")],
                                 "license string, text string")
    assert lc.scan_licenses(docs, none).collect() == []
