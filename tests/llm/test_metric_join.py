import math

import numpy as np
import pytest

from tripdeck.llm import metric_join as mj

SCHEMA = "vec_id long, embedding array<double>, label int, id int, w string, cell int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, 1, "x", None) for i, v, k in rows], SCHEMA)


def brute(rows, least):
    """(id, n_links, component) of all rows with an id, from all pairs."""
    rows = [r for r in rows if r[0] is not None]
    ok = [v is not None and k is not None and any(v)
          and all(c is not None and math.isfinite(c) for c in v) for _, v, k in rows]
    parent = {i: i for i, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = [0] * len(rows)
    for a, (i, v, k) in enumerate(rows):
        for b, (j, u, m) in enumerate(rows[:a]):
            if ok[a] and ok[b] and k == m and len(u) == len(v):
                x, y = np.array(u), np.array(v)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((find(i), find(j)))
                    parent[high] = low
    return sorted((i, n, find(i)) for (i, _, _), n in zip(rows, links, strict=True))


def clustered(seed, dims=6, size=260):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = []
    for k in range(size):
        v = centres[k % 12] + rng.choice([0.01, 0.1, 0.4]) * rng.normal(size=dims)
        rows.append((int(rng.integers(0, 10_000)), v.tolist(), int(k % 3)))
    dense = rng.normal(size=dims)
    rows += [(20_000 + k, (dense + 0.02 * rng.normal(size=dims)).tolist(), 1) for k in range(120)]
    rows += [(30_000 + k, rows[5][1], rows[5][2]) for k in range(40)]
    return rows


@pytest.mark.parametrize("seed,least,most,block", [(0, 0.98, 16, 20), (1, 0.9, 4, 16),
                                                   (2, 0.98, 1024, 4096)])
def test_matches_all_pairs(spark, seed, least, most, block):
    rows = clustered(seed)
    rows += [(40_001, None, 1), (40_002, [0.0] * 6, 1), (40_003, [math.nan] * 6, 1),
             (40_004, [None] + [1.0] * 5, 1), (40_005, rows[0][1], None), (None, rows[0][1], 0),
             (40_006, [1.0, 2.0], 1), (40_007, [2.0, 4.0], 1), (40_008, [], 1),
             (40_009, [1e200 * x for x in rows[1][1]], rows[1][2]),
             (40_010, [1e-200 * x for x in rows[1][1]], rows[1][2]),
             (rows[0][0], rows[3][1], rows[3][2]), rows[7], rows[7]]
    out = mj.cosine_classes(table(spark, rows), "vec_id", "embedding", "label", least, most,
                            block).collect()
    assert sorted((r.id, r.n_links, r.component_id) for r in out) == brute(rows, least)
    assert all(r.kept == (r.id == r.component_id) for r in out)


def test_dense_cores_are_counted_without_comparing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, (np.eye(8)[0] + 1e-3 * rng.normal(size=8)).tolist(), 1) for k in range(300)]
    out = mj.cosine_classes(table(spark, rows), "vec_id", "embedding", "label", block=32).collect()
    assert {(r.n_links, r.component_id) for r in out} == {(299, 0)}
    df = mj.usable_vectors(table(spark, rows), "vec_id", "embedding", "label")
    x = np.array([r.v for r in df.collect()])
    cells = mj.Cells(x / np.linalg.norm(x, axis=1)[:, None], 0.2, 16, 32)
    d2, goes, home = cells.near(x / np.linalg.norm(x, axis=1)[:, None], cells.sets[0])
    assert np.sqrt(d2).max() < 0.1


def test_partners_are_always_in_the_home_cell():
    rng = np.random.default_rng(5)
    for dims in (2, 5, 20):
        x = rng.normal(size=(600, dims))
        x[300:] = x[:300] + 0.1 * rng.normal(size=(300, dims))
        x /= np.linalg.norm(x, axis=1)[:, None]
        eps = math.sqrt(0.04)
        cells = mj.Cells(x[:400], eps, 64, 16)
        for centres in cells.sets:
            _, goes, home = cells.near(x, centres)
            a, b = np.nonzero(x @ x.T >= 0.98)
            assert goes[b, home[a]].all()


def test_empty_table_and_bad_threshold(spark):
    assert mj.cosine_classes(table(spark, []), "vec_id", "embedding", "label").collect() == []
    with pytest.raises(ValueError):
        mj.cosine_classes(table(spark, []), "vec_id", "embedding", "label", least=0.0)
