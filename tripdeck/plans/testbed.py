"""Building blocks shared by the registered queries: raw tables and the OBT over the test data.

Lineage literals are fixed so that results can be compared with SQL run elsewhere.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.operators.ingest import ingest
from tripdeck.operators.obt import obt_from_raw, union_services
from tripdeck.sources import testdata
from tripdeck.sources.schemas import SERVICES, align, raw_table_schema

# Fixed lineage values of the test runs.
RAW_RUN_ID = "ingest-20240101T000000Z"
OBT_RUN_ID = "obt-20240101T000000Z"
INGESTED_AT = datetime(2024, 1, 1, 0, 0, 0)


def raw_table(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """``raw.<service>_taxi_trip`` as ingest would have written it."""
    return ingest(testdata.raw_trips(spark, sf_dir, service), service, RAW_RUN_ID, INGESTED_AT)


# Lazy plans (not data) built once per session and state of the tables: a DataFrame is an immutable
# description, so every query can start from the same analysed plan instead of re-analysing it.
_PLANS: dict[tuple, DataFrame] = {}


def _plan(spark: SparkSession, sf_dir: str, key: tuple, build) -> DataFrame:
    full = (spark.sparkContext.applicationId, sf_dir, testdata.version(spark, sf_dir), *key)
    if full not in _PLANS:
        _PLANS[full] = build()
    return _PLANS[full]


def _both_raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both raw tables in one frame, from one pass over the order lines: what the union of the
    two tables holds (``tests/test_obt.py`` compares them)."""
    empty = [spark.createDataFrame([], raw_table_schema(s)) for s in SERVICES]
    rows = testdata.trips_of_all_services(spark, sf_dir).withColumns(
        {"run_id": F.lit(RAW_RUN_ID), "ingested_at_utc": F.lit(INGESTED_AT).cast("timestamp_ntz")})
    return align(rows, union_services(*empty).schema)


def raw_tables(spark: SparkSession, sf_dir: str, services=SERVICES) -> DataFrame:
    def build():
        if tuple(services) == tuple(SERVICES):
            return _both_raw_tables(spark, sf_dir)
        return union_services(*[raw_table(spark, sf_dir, s) for s in services])
    return _plan(spark, sf_dir, ("raw", tuple(services)), build)


def obt(spark: SparkSession, sf_dir: str, run_id: str = OBT_RUN_ID) -> DataFrame:
    return _plan(spark, sf_dir, ("obt", run_id),
                 lambda: obt_from_raw(raw_tables(spark, sf_dir), testdata.zones(spark, sf_dir),
                                      run_id))
