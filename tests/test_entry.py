"""Driver contract: entry smoke, registry/oracle consistency, and every oracle query against
DuckDB on the smallest test tables (same comparison as the correctness gate)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_harness import compare, duck

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) >= {"service_type", "source_year", "source_month", "trips"}


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 50


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    exp = con.sql(ORACLE[name]).df()
    res = compare(got, exp)
    assert res["cols"], res
    assert res["rows"][0] == res["rows"][1], res
    assert res["approx"], res
