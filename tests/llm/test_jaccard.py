import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import corpus, frame, lowered, words

from tripdeck.llm import jaccard as jc
from tripdeck.llm.stages import components


def classes(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = words(lowered(t))
        grams = [tuple(w[k:k + n]) for k in range(len(w) - n + 1)] or ([tuple(w)] if w else [])
        sets[i] = frozenset(grams)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    index = defaultdict(list)
    for i in sorted(sets):
        for j, both in Counter(j for g in sets[i] for j in index[g]).items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for g in sets[i]:
            index[g].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("n,percent,seed", [(4, 85, 0), (5, 80, 1), (2, 60, 2), (1, 40, 3)])
def test_classes_match_brute_force(spark, n, percent, seed):
    rows = corpus(seed, 90)
    out = jc.near_duplicate_classes(frame(spark, rows), n, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == classes(rows, n, percent)
    assert len(out) == len(rows)


def test_lists_of_differences_are_written_once_and_keys_are_short(spark, monkeypatch):
    kept = {}
    write = jc.written

    def noted(df, name):
        kept[name] = [c for c, kind in df.dtypes if kind.startswith("array")]
        return write(df, name)
    monkeypatch.setattr(jc, "written", noted)
    monkeypatch.setattr(jc, "small", lambda df: df)  # as with many rows: all joins are shuffled
    monkeypatch.setattr(jc, "SMALL_ROWS", -1, raising=False)
    rows = corpus(4, 90)
    out = jc.near_duplicate_classes(frame(spark, rows), 2, 60).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == classes(rows, 2, 60)
    assert [k for k, lists in kept.items() if "lack" in lists] == [
        "star-overlaps", "consensus-differences"]
    assert max(jc.segment_keys(np.arange(1, 200, dtype=np.uint64) << np.uint64(55), 80)) < 2**48


def test_differences_are_kept_for_groups_only_and_dealt_by_bucket(spark, monkeypatch):
    kept, plans = {}, {}
    write = jc.written

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        kept[name] = write(df, name)
        return kept[name]
    monkeypatch.setattr(jc, "written", noted)
    monkeypatch.setattr(jc, "small", lambda df: df)  # as with many rows: all joins are shuffled
    monkeypatch.setattr(jc, "BUCKET", 2, raising=False)
    common = [f"c{i}" for i in range(60)]
    rows = [(1, " ".join(common)), (2, " ".join([*common, "p"])),  # a segment of two documents
            *((10 + k, " ".join(f"g{k if i % 20 < k % 4 else ''}x{i}" for i in range(60)))
              for k in range(12))]
    rows += [(100 + i, t) for i, t in corpus(7, 60)]
    out = jc.near_duplicate_classes(frame(spark, rows), 2, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == classes(rows, 2, 85)
    near = {(r.a, r.b): r for r in kept["star-overlaps"].collect()}
    assert near[1, 2].both == 59 and near[1, 2].lack is None and near[1, 2].extra is None
    assert any(r.lack is not None for r in near.values())
    assert not [k for k, p in plans.items()
                if re.search(r"hashpartitioning\(l#\d+L, e#\d+L, \d+\)", p)]


def test_shared_differences_whatever_the_buckets(spark):
    rows = [(5, x, x % 3, [100 * x, -7], [9, x // 2]) for x in range(1, 30)]
    rows += [(6, 1, 1, [4], []), (6, 2, 2, [], [4]), (6, 3, 2, [8], []), (6, 4, 2, [8], [])]
    found = []
    for buckets in (1, 4):
        at = spark.createDataFrame([(*r, buckets) for r in rows],
                                   "l long, x long, cx long, lack array<long>, "
                                   "extra array<long>, buckets long")
        found.append({(r.l, r.x): list(r.d) for r in jc.shared_differences(at).collect()})
    mask = (1 << jc.ELEMENT_BITS) - 1
    each = [(l, x, cx, e & mask) for l, x, cx, lack, extra in rows for e in lack + extra]
    holders = defaultdict(list)
    for l, x, cx, e in each:
        holders[l, e].append(cx)
    want = defaultdict(list)
    for l, x, _, e in each:
        if len(set(holders[l, e])) > 1:
            want[l, x].append(len(holders[l, e]) << jc.ELEMENT_BITS | e)
    assert found == [{k: sorted(d) for k, d in want.items()}] * 2


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "A b c D e"), (3, None)]
    out = jc.near_duplicate_classes(frame(spark, rows), 4, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == [
        (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert jc.near_duplicate_classes(frame(spark, []), 4, 85).collect() == []


@pytest.mark.parametrize("percent", [30, 50, 60, 80, 85])
def test_linked_sets_share_a_segment_key(percent):
    rng = np.random.default_rng(5)
    for _ in range(300):
        size = int(rng.integers(1, 400))
        u = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
        keep = u[rng.random(len(u)) > rng.random() * (1 - percent / 100) * 1.2]
        v = np.union1d(keep, rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64))
        both = len(np.intersect1d(u, v))
        if len(v) and 100 * both >= percent * (len(u) + len(v) - both):
            assert np.intersect1d(jc.segment_keys(u, percent), jc.segment_keys(v, percent)).size


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(20, 60)] + [(5, 5)]
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r.node: r.component for r in out}
    assert got == {**{k: 100 for k in range(100, 141)}, 7: 7, **{k: 7 for k in range(20, 60)}}
    assert len(out) == len(got)
