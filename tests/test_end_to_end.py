"""Landed monthly files → ingest job → OBT job → regression grid, against the direct build."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripdeck.operators import features as fe
from tripdeck.operators import models as md
from tripdeck.operators.partitions import PartitionSpec
from tripdeck.plans import ingest_job, obt_job, regression, testbed
from tripdeck.session import scratch_path
from tripdeck.sinks import tables
from tripdeck.sources import files, testdata


def test_files_to_models(spark):
    root = scratch_path(spark, "e2e-land")
    for s in ("yellow", "green"):
        files.write_monthly_files(
            testdata.raw_trips(spark, SF_SMALL, s).withColumn("service_type", F.lit(s)), root)
    db = f"e2e_{uuid.uuid4().hex[:8]}"
    tables.ensure_database(spark, db, scratch_path(spark, "e2e-db"))
    raw = {s: f"{db}.{s}_taxi_trip" for s in ("yellow", "green")}
    spec = PartitionSpec(1995, 2001)
    ingest_job.run(spark, root, raw, spec, testbed.RAW_RUN_ID, testbed.INGESTED_AT)

    res = obt_job.run(spark, obt_job.read_raw(spark, raw, spec), testdata.zones(spark, SF_SMALL),
                      f"{db}.obt_trips", spec, testbed.OBT_RUN_ID)
    assert res.totals.first()["rows"] == 3185 == res.rows_written
    stored = spark.table(f"{db}.obt_trips")
    direct = testbed.obt(spark, SF_SMALL)
    cols = sorted(direct.columns)
    assert stored.select(cols).exceptAll(direct.select(cols)).count() == 0
    assert direct.select(cols).exceptAll(stored.select(cols)).count() == 0

    with regression.prepare(stored, fe.TESTDATA_SPLIT, persist=True) as prep:
        grid = md.moment_grid_search(spark, prep.scaled, prep.features,
                                     [md.Setting("linear"), md.Setting("lasso", 1e-4, 1.0)])
        rows = grid.collect()
    assert len(rows) == 2 and all(0.0 < r["r2_train"] <= 1.0 for r in rows)
