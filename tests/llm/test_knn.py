import math

import numpy as np

from tripdeck.llm.knn import integer_vectors, nearest_neighbours


def brute(rows, queries, k):
    ok = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in rows
          if i is not None and v and all(c is not None and math.isfinite(c) for c in v)}
    out = set()
    for q in queries:
        if q in ok:
            found = sorted((-sum(a * b for a, b in zip(ok[q], v, strict=True)), i)
                           for i, v in ok.items() if i != q and len(v) == len(ok[q]))
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)}
    return out


def run(spark, rows, every, k, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int")
    v = integer_vectors(df, "vec_id", "embedding", 256)
    out = nearest_neighbours(v, v.where(f"id % {every} = 0"), k, **more).collect()
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in out}
    assert len(got) == len(out)
    return got


def test_matches_brute_force_with_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 8))
    data = [(i, (centres[i % 6] + 0.2 * rng.normal(size=8)).tolist()) for i in range(400)]
    data += [(400 + i, [0.5] * 8) for i in range(200)]
    data += [(700, None), (705, [None] * 8), (710, [math.nan] * 8), (715, [math.inf] * 8),
             (720, []), (None, [0.1] * 8), (725, [0.5, 0.25]), (730, [0.5, 0.5])]
    got = run(spark, [(i, v, 1) for i, v in data], 5, 3, pivots=7, block=50, query_block=30)
    assert got == brute(data, [i for i, _ in data if i is not None and i % 5 == 0], 3)


def test_few_or_no_candidates(spark):
    assert run(spark, [(0, [1.0], 1), (50, [2.0], 1)], 50, 5) == {(0, 1, 50, 131072),
                                                                  (50, 1, 0, 131072)}
    assert run(spark, [(0, [1.0], 1)], 50, 5) == set()
    assert run(spark, [], 50, 5) == set()
