import itertools
import math
import random
import re
from collections import Counter

import pytest
import regex
from fixtures import frame
from pyspark.sql import functions as F

from tripdeck.llm import pii

RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return 14 <= len(digits) <= 19 and total % 10 == 0


def base(text):
    return sorted((m.start(), n, m.end(), k) for n, (k, p, ok) in enumerate(RULES)
                  for m in re.finditer(p, text or "") if ok(m[0]))


def test_base_spans_match_the_patterns(spark):
    rng = random.Random(1)
    parts = list("ab1230456789@@..+--  ()_%é\u0001\u0002\n𝒳") + [
        "255.", "4111 1111 1111 1111", "+1 (555) 123-4567", "a@b.co", "10.0.0.1", "0300.1.1.1"]
    rows = [(0, None), (1, ""), (2, "1" * 20_000), (3, "a" * 20_000 + "@"), (4, "1.1." * 5000)]
    rows += [(9 + k, "".join(rng.choices(parts, k=rng.randint(1, 90)))) for k in range(600)]
    out = frame(spark, rows).select("doc_id", pii.base_spans(F.coalesce("text", F.lit("")))
                                    .alias("s")).collect()
    texts = dict(rows)
    assert len(out) == len(rows)
    for r in out:
        assert [tuple(s) for s in r.s] == base(texts[r.doc_id]), texts[r.doc_id]


def sanitise(spark, rows, **more):
    found = pii.personal_data(frame(spark, rows), **more)
    assert found.schema["spans"].dataType.typeName() == "array" and "score" in found.columns
    return {(r.doc_id, r.text): (r.clean, [tuple(s) for s in r.spans]) for r in found.withColumn(
        "clean", pii.sanitised(F.col("text"), F.col("spans"))).collect()}


def test_terms_that_give_an_entity_away_are_removed_too(spark):
    fill = ["alpha beta gamma delta", "one two three four", "red green blue black", "up down left"]
    rows = [(k, f"{a} the Xyzzyx writes bob@example.org today {b}")
            for k, (a, b) in enumerate(zip(fill, reversed(fill), strict=True))]
    rows += [(10 + k, f"the plain text number {k} has no secret {fill[k % 4]}") for k in range(40)]
    rows += [(60, "only xyzzyx is here"), (61, "xyzzyxx and axyzzyx are other words")]
    out = sanitise(spark, rows)
    for k in range(4):
        assert out[rows[k]][0] == rows[k][1].replace("Xyzzyx", "[TERM]").replace(
            "bob@example.org", "[EMAIL]").replace("writes", "[TERM]").replace("today", "[TERM]")
    assert out[rows[-2]][0] == "only [TERM] is here"
    assert all(out[r] == (r[1], []) for r in [*rows[4:-2], rows[-1]])
    for r, (_, spans) in out.items():
        assert [s for s in spans if s[3] != pii.TERM] == base(r[1])


def test_overlapping_spans_copies_nulls_and_empty_table(spark):
    text = "call 4111 1111 1111 1111 or 1.2.3.4@x.org"
    out = sanitise(spark, [(1, text), (1, text), (2, None), (None, "a@b.co"), (3, "")])
    assert out[1, text][0] == "call [CARD] or [EMAIL]"
    assert out[2, None] == (None, []) and out[3, ""] == ("", [])
    assert out[None, "a@b.co"][0] == "[EMAIL]"
    assert sanitise(spark, []) == {}


@pytest.mark.parametrize("rows", [2, 200_000])
def test_term_spans_do_not_depend_on_the_join(spark, rows):
    docs = [(k, f"w{k} zorro {k}x a@b.co q{k}q") for k in range(5)] + [
        (9 + k, f"nothing here {k}") for k in range(30)]
    out = sanitise(spark, docs, broadcast_rows=rows)
    assert all("[TERM]" in out[d][0] for d in docs[:5])


def test_entities_of_one_document_are_estimated_too(spark):
    far = "which they say in all the plain text that has no secret in it at all"
    rows = [(0, f"Qwertz {far}, and writes zed@example.org, {far} Plimsoll. {far} {far} Yonder. Bye"),
            (1, f"the Vbnm\n+1 555 123 4567\n{far}"), (2, f"{far} a@b.co c@d.org Hjkl")]
    rows += [(10 + k, f"{far}, and the number {k} writes") for k in range(60)]
    out = sanitise(spark, rows)
    assert out[rows[0]][0] == rows[0][1].replace("Qwertz", "[TERM]").replace(
        "Plimsoll", "[TERM]").replace("zed@example.org", "[EMAIL]")
    assert out[rows[1]][0] == rows[1][1].replace("Vbnm", "[TERM]").replace(
        "+1 555 123 4567", "[PHONE]")
    assert out[rows[2]][0] == f"{far} [EMAIL] [EMAIL] [TERM]"
    assert all(out[r] == (r[1], []) for r in rows[3:])


def test_chance_is_no_evidence(spark):
    fill = "this is said by all"
    rows = [(k, f"{fill} info@example.org own{k}word") for k in range(10)]
    rows += [(10 + k, fill) for k in range(20)]
    assert all("[TERM]" not in clean for clean, _ in sanitise(spark, rows).values())


def estimated(rows, threshold=0.9, significance=0.05, reach=40):
    """Disclosing terms by counts in dictionaries, in plain Python."""
    docs = {(i, t) for i, t in rows}
    word, letter = regex.compile(r"[^\p{L}\p{N}]+"), r"[\p{L}\p{N}]"
    split = lambda t: {w for w in word.split(t.lower()) if len(w) >= 3}
    n_e, n_te, n_t = Counter(), Counter(), Counter()
    for _, text in docs:
        text = text or ""
        n_t.update(split(text))
        spans, pairs, ends = base(text), set(), [m.end() for m in regex.finditer(pii.BOUNDARY, text)]
        for lo, hi in itertools.pairwise([0, *ends, len(text)]):
            if not any(lo <= s[0] < hi for s in spans):
                continue
            a, b = max(lo - reach - 1, 0), hi + reach + 1
            wide = text[a:b]
            wide = regex.sub(f"^{letter}+", "", wide) if a > 0 else wide
            wide = regex.sub(f"(?<!{letter}){letter}+$", "", wide) if b < len(text) else wide
            for s in reversed(base(wide)):
                wide = wide[:s[0]] + " " * (s[2] - s[0]) + wide[s[2]:]
            pairs |= {(text[lo:hi][s[0]:s[2]].lower(), w) for s in base(text[lo:hi])
                      for w in split(wide) | {None}}
        n_e.update({e for e, _ in pairs})
        n_te.update(p for p in pairs if p[1])
    total, found = len(docs), set()

    def evidence(k, draws, share):
        rest = draws - k
        return k * math.log(k / (draws * share)) + (
            rest * math.log(rest / (draws * max(1 - share, 1e-12))) if rest else 0.0)
    for (e, t), k in n_te.items():
        info = math.log2(total / n_e[e])
        if info > 0 and math.log2(total * k / (n_t[t] * n_e[e])) >= threshold * info and max(
                evidence(k, n_e[e], n_t[t] / total),
                evidence(k, n_t[t], n_e[e] / total)) >= -math.log(significance):
            found.add(t)
    return found


@pytest.mark.parametrize("seed", [0, 1])
def test_terms_equal_counts_in_dictionaries(spark, seed):
    rng = random.Random(seed)
    common = ["the", "and", "says", "with", "über", "number", "plain"]
    rare = [f"name{k}" for k in range(12)]
    people = [f"p{k}@site{k}.org" for k in range(5)] + ["10.0.0.7", "+49 30 123 456 78"]
    rows = []
    for k in range(120):
        words = rng.choices(common, k=rng.randint(3, 40))
        if rng.random() < 0.4:
            p = rng.randrange(len(people))
            at = rng.randrange(len(words))
            words[at:at] = [people[p], rare[p] if rng.random() < 0.8 else rng.choice(rare)]
        if rng.random() < 0.1:
            words.append(rng.choice(rare))
        rows.append((k // 2 * 2 if rng.random() < 0.1 else k,
                     rng.choice([" ", " ", ". ", "! "]).join(words)))
    rows += [rows[3], rows[3], rows[8], (500, None), (501, "")]
    want = estimated(rows)
    assert want
    found = sanitise(spark, rows)
    marked = {t[s[0]:s[2]].lower() for (_, t), (_, spans) in found.items() for s in spans
              if s[3] == pii.TERM}
    assert marked == want
    for (_, t), (_, spans) in found.items():
        own = [s[0] for s in spans if s[3] == pii.TERM]
        assert own == [m.start() for m in regex.finditer(r"[\p{L}\p{N}]+", t or "")
                       if m[0].lower() in want]
