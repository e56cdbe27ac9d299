"""Distributed exact order statistics against NumPy."""

import numpy as np
import pytest

from tripdeck.operators.selection import OrderStatistics, kth_smallest, percentiles


@pytest.mark.parametrize("final_rows", [5, 20_000])
def test_kth_smallest_doubles_with_duplicates(spark, final_rows):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(500, 0.25), [np.nan]])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    srt = np.sort(vals[~np.isnan(vals)])
    ranks = [0, 1, 999, 1700, 1750, 3499]
    got = kth_smallest(df, "x", ranks, bins=16, final_rows=final_rows)
    assert [got[r] for r in ranks] == [srt[r] for r in ranks]


def test_kth_smallest_longs_exact(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(0, 2 ** 60, size=2000, dtype=np.int64)
    vals[:300] = vals[0]
    df = spark.createDataFrame([(int(v),) for v in vals], "x long")
    srt = np.sort(vals)
    got = kth_smallest(df, "x", [0, 150, 299, 300, 1999], bins=8, final_rows=10)
    assert [got[r] for r in [0, 150, 299, 300, 1999]] == [int(srt[r]) for r in
                                                         [0, 150, 299, 300, 1999]]


def test_percentiles_match_numpy_linear(spark):
    rng = np.random.default_rng(11)
    vals = rng.exponential(size=1234)
    df = spark.createDataFrame([(float(v),) for v in vals], "r double")
    got = percentiles(df, "r", [0.05, 0.5, 0.95], bins=32, final_rows=50)
    for p in (0.05, 0.5, 0.95):
        assert got[p] == pytest.approx(np.percentile(vals, p * 100), rel=1e-12)


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300), st.data())
def test_kth_smallest_property(spark, values, data):
    """Any rank of any small integer multiset (heavy duplicates included) equals the sort."""
    ranks = data.draw(st.lists(st.integers(0, len(values) - 1), min_size=1, max_size=4))
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = kth_smallest(df, "x", ranks, bins=4, final_rows=3)
    srt = sorted(values)
    assert [got[r] for r in ranks] == [srt[r] for r in ranks]


def test_infinite_values_and_the_widest_range_end(spark):
    rows = [float(k) for k in range(98)] + [float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in rows], "x double")
    got = kth_smallest(df, "x", [0, 1, 50, 98, 99], bins=8, final_rows=5)
    assert got == {0: float("-inf"), 1: 0.0, 50: 49.0, 98: 97.0, 99: float("inf")}
    wide = [-1.7e308, 1.7e308, *map(float, range(50))]
    df = spark.createDataFrame([(v,) for v in wide], "x double")
    assert kth_smallest(df, "x", [0, 25, 51], bins=8, final_rows=5) == {
        0: -1.7e308, 25: 24.0, 51: 1.7e308}


def test_large_columns_are_bracketed_by_the_sketch(spark):
    """More values than are ever collected: brackets are narrow, ranks exact, ties included."""
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(size=40_000), np.full(20_000, 0.125),
                           [np.inf, -np.inf, -np.inf]])
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(vals)], "x double")
    srt = np.sort(vals)
    ranks = [0, 1, 2, 300, 20_000, 30_000, 45_000, 60_000, 60_002]
    with OrderStatistics(df, "x", final_rows=200) as st:
        inner = st.brackets([300, 30_000])
        assert len(inner) == 2 and sum(((vals >= a) & (vals <= b)).sum() for a, b in inner) < 30_000
        assert st.values_at(ranks) == {r: srt[r] for r in ranks}
    longs = rng.integers(-2 ** 62, 2 ** 62, size=30_000)
    df = spark.createDataFrame([(int(v),) for v in longs], "x long")
    got = kth_smallest(df, "x", [0, 9_999, 29_999], final_rows=100)
    assert got == {r: int(np.sort(longs)[r]) for r in (0, 9_999, 29_999)}


def test_a_bracket_that_misses_its_rank_is_made_good(spark, monkeypatch):
    vals = list(range(5000))
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    with OrderStatistics(df, "x", bins=16, final_rows=50) as st:
        monkeypatch.setattr(st, "brackets", lambda ranks: [(100, 120), (4000, 4003)])
        assert st.values_at([5, 110, 130, 4001, 4999]) == {5: 5, 110: 110, 130: 130, 4001: 4001,
                                                           4999: 4999}


def test_the_column_is_scanned_at_most_twice(spark):
    """Counted by an accumulator in the column's own plan, for any number of ranks."""
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        scans.add(1)
        yield from batches
    df = spark.range(0, 50_000, 1, 3).mapInArrow(count, "id long")
    with OrderStatistics(df, "id", final_rows=100, keep=False) as st:
        assert st.values_at([7, 25_000, 49_999]) == {7: 7, 25_000: 25_000, 49_999: 49_999}
    assert scans.value == 2 * 3
