"""Partition spec rules, manifest, ledger and run summaries."""

import pytest
from pyspark.sql import functions as F

from tripdeck.operators.partitions import (PartitionSet, PartitionSpec, ledger, parse_months,
                                           parse_services, run_summary_by_year, run_totals)


def test_months_and_services_are_validated_deduplicated_sorted():
    assert parse_months(["3,1", "3", " 12 "]) == [1, 3, 12]
    assert parse_services(["Yellow", "green,yellow"]) == ["yellow", "green"]
    with pytest.raises(ValueError):
        parse_months(["13"])
    with pytest.raises(ValueError):
        parse_months(["x"])
    with pytest.raises(ValueError):
        parse_services(["blue"])
    assert parse_months(None) == parse_services([None, " ,"]) == []


def test_resolve_full_mode_forces_everything_and_overwrite():
    s = PartitionSpec.resolve(mode="full", year_start=2020, year_end=2020, months=["1"],
                              services=["green"], overwrite=False)
    assert (s.year_start, s.year_end) == (2015, 2025)
    assert s.months == tuple(range(1, 13)) and s.services == ("yellow", "green")
    assert s.overwrite and s.size() == 264


def test_resolve_explicit_values_win_and_bad_range_raises():
    s = PartitionSpec.resolve(year_start=2019, year_end=2020, months=["2", "1"])
    assert s.years == [2019, 2020] and s.months == (1, 2) and not s.overwrite
    with pytest.raises(ValueError):
        PartitionSpec.resolve(year_start=2021, year_end=2020)


def test_manifest_has_one_row_per_partition_without_join(spark):
    spec = PartitionSpec(2000, 2002, (1, 6), ("yellow", "green"))
    m = spec.manifest(spark)
    assert m.count() == spec.size() == 12
    assert m.distinct().count() == 12
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_ledger_reports_empty_partitions_as_zero(spark):
    spec = PartitionSpec(2000, 2000, (1, 2), ("yellow",))
    counts = spark.createDataFrame([("yellow", 2000, 1, 5)],
                                   "service_type string, source_year int, source_month int, "
                                   "rows long")
    led = ledger(spec.manifest(spark), counts)
    got = {r["source_month"]: r["rows"] for r in led.collect()}
    assert got == {1: 5, 2: 0}
    tot = run_totals(led).first()
    assert (tot["partitions"], tot["partitions_with_rows"], tot["rows"]) == (2, 1, 5)
    by_year = run_summary_by_year(led).first()
    assert by_year["rows"] == 5 and by_year["partitions"] == 2


def test_partition_set_predicate(spark):
    df = spark.createDataFrame([("yellow", 2000, 1), ("green", 2000, 1), ("yellow", 2000, 2)],
                               "service_type string, source_year int, source_month int")
    ps = PartitionSet.of(df.where(F.col("source_month") == 1))
    assert ps.size() == 2
    assert df.where(ps.predicate()).count() == 2


from hypothesis import given, strategies as st  # noqa: E402


@given(st.lists(st.integers(1, 12), max_size=30), st.sampled_from([",", " ,", ", "]))
def test_month_tokens_property(months, sep):
    """Comma-joined or separate tokens give the same sorted, de-duplicated months."""
    joined = sep.join(str(m) for m in months)
    assert parse_months([joined]) == sorted(set(months)) == parse_months([str(m) for m in months])


@given(st.integers(13, 10_000) | st.integers(-10_000, 0))
def test_out_of_range_month_raises(m):
    with pytest.raises(ValueError):
        parse_months([str(m)])
