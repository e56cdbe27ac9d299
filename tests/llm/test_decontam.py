import itertools
import random
import re

import numpy as np
import pytest
from fixtures import frame

from tripdeck.llm import decontam as dc

RNG = random.Random(2)
VOCABULARY = ["".join(RNG.choices("abcdefgh", k=RNG.randint(2, 7))) for _ in range(800)]


def make(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


ITEMS = [(k, " ".join(make(n))) for k, n in enumerate([40, 60, 15, 7, 4, 30])]


def normal(text):
    return re.findall("[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def brute(rows, items, least, identity, shortest):
    """Best region of every diagonal of every pair."""
    out = {}
    for i, t in rows:
        doc = normal(t)
        for item_id, text in items:
            own = normal(text)
            for d in range(-len(own) + 1, len(doc)) if len(own) >= shortest else ():
                lo, hi = max(0, d), min(len(doc), d + len(own))
                best = (0, 0, 0)
                score, start = 0, lo
                for k in range(lo, hi):
                    score += 1 if doc[k] == own[k - d] else dc.MISMATCH
                    if score < 0:
                        score, start = 0, k + 1
                    if score > best[0]:
                        best = (score, k + 1 - start, start)
                _, length, start = best
                matches = sum(doc[k] == own[k - d] for k in range(start, start + length))
                if matches >= min(least, len(own)) and matches >= identity * length:
                    out[i, item_id] = max(out.get((i, item_id), 0), matches)
    return out


def any_region(rows, items, least, identity, shortest):
    """Pairs of which some region of some diagonal passes, all regions tried."""
    out = set()
    for i, t in rows:
        doc = normal(t)
        for item_id, text in items:
            own = normal(text)
            for d in range(-len(own) + 1, len(doc)) if len(own) >= shortest else ():
                lo, hi = max(0, d), min(len(doc), d + len(own))
                upto = np.cumsum([0] + [doc[k] == own[k - d] for k in range(lo, hi)])
                if upto[-1] < min(least, len(own)):
                    continue
                matches = upto[None, :] - upto[:, None]
                length = np.arange(len(upto))[None, :] - np.arange(len(upto))[:, None]
                if ((matches >= min(least, len(own))) & (matches >= identity * length)).any():
                    out.add((i, item_id))
    return out


def rows():
    out = [(1, None), (2, ""), (3, " ".join(make(3000)))]
    for k in range(30):
        own = make(RNG.randint(0, 80))
        passage = ITEMS[k % 6][1].split()
        for _ in range(k % 5):
            passage[RNG.randrange(len(passage))] = "changed"
        at = RNG.randint(0, len(own))
        text = " ".join(own[:at] + passage[k % 3:] + own[at:])
        out.append((10 + k, text.upper().replace(" ", ", ") if k % 2 else text))
    return out


@pytest.mark.parametrize("size", [16 << 20, 300])
def test_finds_substituted_passages(spark, monkeypatch, size):
    monkeypatch.setattr(dc, "BENCHMARK_BYTES", size)
    data = rows()
    items = spark.createDataFrame([*ITEMS, (None, "x y"), (9, None), (1, ITEMS[1][1])],
                                  "item_id long, text string")
    out = dc.find_overlaps(frame(spark, data), items).collect()
    got = {(r.doc_id, x.item_id): x.matches for r in out for x in r.leaks}
    exp = brute(data, ITEMS, 12, 0.8, 5)
    assert {k: v for k, v in got.items() if k in exp} == exp and len(exp) >= 15
    assert set(got) == any_region(data, ITEMS, 12, 0.8, 5)
    assert len(out) == len(data) and all(r.source == "s" for r in out)
    for r in out:
        doc = normal(r.text)
        for x in r.leaks:
            assert len(doc[x.start:x.start + x.length]) == x.length


def test_clean_repeated_and_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    data = [(1, ITEMS[0][1]), (1, ITEMS[0][1]), (None, ITEMS[0][1]), (2, " ".join(make(200)))]
    out = dc.find_overlaps(frame(spark, data), items).collect()
    assert sorted(len(r.leaks) for r in out) == [0, 1, 1, 1]
    assert dc.find_overlaps(frame(spark, []), items).collect() == []
    out = dc.find_overlaps(frame(spark, data), items.where("false")).collect()
    assert [r.leaks for r in out] == [[]] * 4


def test_a_region_that_passes_is_found_in_any_diagonal():
    rng = random.Random(5)
    lost = 0
    for _ in range(400):
        n, p = rng.randint(1, 59), rng.choice([0.1, 0.2, 0.25, 0.4])
        equal = np.array([rng.random() > p for _ in range(n)])
        most = max(int(equal[a:b].sum()) for a in range(n) for b in range(a, n + 1)
                   if equal[a:b].sum() >= 0.8 * (b - a) - 1e-9)
        a, b = dc.widest_region(equal, 0.8)
        assert equal[a:b].sum() == most and most >= 0.8 * (b - a) - 1e-9
        a, b = dc.best_region(equal)
        lost += most >= 12 and equal[a:b].sum() < 0.8 * (b - a)
    assert lost > 5


@pytest.mark.parametrize("runs", [(13, 6, 13, 6, 13), (20, 9, 20, 9, 20), (10, 3, 2)])
def test_regions_beside_the_best_scoring_one(spark, runs):
    own = make(sum(runs))
    copy = [w if k % 2 == 0 else "changed" for w, k in zip(
        own, [k for k, n in enumerate(runs) for _ in range(n)], strict=True)]
    items = spark.createDataFrame([(1, " ".join(own))], "item_id long, text string")
    out = dc.find_overlaps(frame(spark, [(1, " ".join(copy)), (2, " ".join(make(90)))]), items)
    found = {r.doc_id: r.leaks for r in out.collect()}
    assert found[2] == [] and len(found[1]) == 1
    x = found[1][0]
    assert x.matches >= 12 and x.matches >= 0.8 * x.length


def test_every_pattern_of_substitutions_meets_a_mask():
    """All ways to substitute words that leave 12 matches and 80 %, in regions of 12 to 20 words
    and, by chance, in longer ones."""
    def met(length, patterns):
        hit = np.zeros(len(patterns), bool)
        for mask in dc.MASKS:
            ones = sum(1 << k for k, c in enumerate(mask) if c == "1")
            for at in range(length - len(mask) + 1):
                hit |= patterns & (ones << at) == ones << at
        return hit.all()
    rng = random.Random(3)
    for length in range(12, 60):
        most = max(k for k in range(length) if length - k >= 12 and length - k >= 0.8 * length)
        ways = itertools.combinations(range(length), most) if length <= 20 else (
            rng.sample(range(length), most) for _ in range(20_000))
        full = (1 << length) - 1
        assert met(length, np.array([full - sum(1 << k for k in c) for c in ways], np.int64))
