"""Batch jobs: ingest of monthly files into raw tables (idempotent) and the zone load."""

import uuid
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import zones_df
from tripdeck.operators.partitions import PartitionSpec
from tripdeck.plans import ingest_job
from tripdeck.session import scratch_path
from tripdeck.sinks import tables
from tripdeck.sources import files, testdata


def test_ingest_job_is_idempotent_and_reports_empty_months(spark):
    root = scratch_path(spark, "land")
    rows = testdata.raw_trips(spark, SF_SMALL, "green").withColumn("service_type", F.lit("green"))
    files.write_monthly_files(rows.where(F.col("source_year") == 1996), root)
    db = f"j_{uuid.uuid4().hex[:8]}"
    tables.ensure_database(spark, db, scratch_path(spark, "jdb"))
    raw = {"green": f"{db}.green_taxi_trip"}
    spec = PartitionSpec(1996, 1997, services=("green",))
    first = sorted(map(tuple, ingest_job.run(spark, root, raw, spec, "ingest-1",
                                             datetime(2024, 1, 1)).collect()))
    again = sorted(map(tuple, ingest_job.run(spark, root, raw, spec, "ingest-2",
                                             datetime(2024, 1, 2)).collect()))
    assert first == again and len(first) == 24
    assert sum(r[3] for r in first if r[1] == 1996) == rows.where("source_year = 1996").count()
    assert all(r[3] == 0 for r in first if r[1] == 1997)
    assert {r[0] for r in spark.table(raw["green"]).select("run_id").distinct().collect()} == \
        {"ingest-2"}


def test_load_zones_adds_lineage_and_replaces(spark):
    path = scratch_path(spark, "zcsv")
    zones_df(spark).coalesce(1).write.option("header", True).csv(path)
    db = f"z_{uuid.uuid4().hex[:8]}"
    tables.ensure_database(spark, db, scratch_path(spark, "zdb"))
    t = f"{db}.taxi_zone_lookup"
    ingest_job.load_zones(spark, path, t, "zones-1", datetime(2024, 1, 1))
    out = ingest_job.load_zones(spark, path, t, "zones-2", datetime(2024, 1, 2))
    assert out.count() == 3 and {r["run_id"] for r in out.collect()} == {"zones-2"}


def test_wrong_root_raises_and_leaves_the_table(spark):
    root = scratch_path(spark, "land-ok")
    rows = testdata.raw_trips(spark, SF_SMALL, "green").withColumn("service_type", F.lit("green"))
    files.write_monthly_files(rows.where(F.col("source_year") == 1996), root)
    db = f"w_{uuid.uuid4().hex[:8]}"
    tables.ensure_database(spark, db, scratch_path(spark, "wdb"))
    raw = {"green": f"{db}.green_taxi_trip"}
    spec = PartitionSpec(1996, 1996, services=("green",))
    ingest_job.run(spark, root, raw, spec, "ingest-1", datetime(2024, 1, 1))
    before = spark.table(raw["green"]).count()
    with pytest.raises(AnalysisException):
        ingest_job.run(spark, root + "-mistyped", raw, spec, "ingest-2", datetime(2024, 1, 1))
    assert spark.table(raw["green"]).count() == before > 0
    # files nested deeper are found as well; an empty file clears its month, an absent one not
    deep = scratch_path(spark, "land-deep")
    name = files.monthly_file_name("green", 1996, 1)
    rows.where("false").drop("service_type", "source_year", "source_month").write.parquet(
        f"{deep}/a/b/{name}")
    out = {r["source_month"]: (r["rows"], r["state"]) for r in ingest_job.run(
        spark, deep, raw, spec, "ingest-3", datetime(2024, 1, 1)).collect()}
    assert out[1] == (0, "landed")
    assert sum(n for n, _ in out.values()) == before - rows.where(
        "source_year = 1996 and source_month = 1").count()
    assert all(state == "absent" for m, (_, state) in out.items() if m > 1)
