"""Incremental build: restart resumes from the checkpoint, a newly landed month is processed
alone."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripdeck.session import scratch_path
from tripdeck.sinks import tables
from tripdeck.sources import files, testdata
from tripdeck.streaming import monthly_ingest


def _rows(spark, year, month):
    return (testdata.raw_trips(spark, SF_SMALL, "yellow")
            .where((F.col("source_year") == year) & (F.col("source_month") == month))
            .withColumn("service_type", F.lit("yellow")))


def _run(spark, root, table, ckpt):
    q = monthly_ingest.start(spark, root, "yellow", testdata.zones(spark, SF_SMALL), table,
                             checkpoint=ckpt, ingested_at=datetime(2024, 1, 1))
    q.awaitTermination()
    return q


def test_stream_resumes_and_processes_only_new_files(spark):
    root = scratch_path(spark, "land")
    ckpt = scratch_path(spark, "ckpt")
    db = f"s_{uuid.uuid4().hex[:8]}"
    tables.ensure_database(spark, db, scratch_path(spark, "sdb"))
    table = f"{db}.obt"
    files.write_monthly_files(_rows(spark, 1996, 1), root)
    _run(spark, root, table, ckpt)
    first = {tuple(r) for r in spark.table(table).groupBy("source_year", "source_month",
                                                         "run_id").count().collect()}
    assert {(r[0], r[1]) for r in first} == {(1996, 1)}
    # restart with nothing new: no batch, table unchanged
    q = _run(spark, root, table, ckpt)
    assert {tuple(r) for r in spark.table(table).groupBy(
        "source_year", "source_month", "run_id").count().collect()} == first
    # a new month lands: only it is processed, under a new batch id
    files.write_monthly_files(_rows(spark, 1996, 2), root)
    _run(spark, root, table, ckpt)
    got = {tuple(r) for r in spark.table(table).groupBy("source_year", "source_month",
                                                       "run_id").count().collect()}
    assert first <= got
    new = got - first
    assert {(r[0], r[1]) for r in new} == {(1996, 2)}
    assert all(r[2] != next(iter(first))[2] for r in new)
    assert q is not None
