"""Monthly-file scan with keys from the file name, zone CSV, ingest lineage, JDBC options."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import zones_df
from tripdeck.operators.ingest import add_lineage, default_run_id, ingest, rename_times
from tripdeck.operators.partitions import PartitionSpec
from tripdeck.session import scratch_path
from tripdeck.sources import files, testdata
from tripdeck.sources.schemas import raw_table_schema


def test_monthly_files_round_trip_keys_and_path(spark):
    root = scratch_path(spark, "landing")
    rows = testdata.raw_trips(spark, SF_SMALL, "green").withColumn("service_type", F.lit("green"))
    files.write_monthly_files(rows, root)
    spec = PartitionSpec(1996, 1996, (2, 3), ("green",))
    scanned = files.read_monthly_files(spark, root, "green", spec, with_source_path=True)
    got = scanned.groupBy("source_year", "source_month").count().collect()
    expect = rows.where(spec.predicate()).groupBy("source_year", "source_month").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expect))
    r = scanned.first()
    assert files.monthly_file_name("green", r["source_year"], r["source_month"]) in r["source_path"]


def test_zone_csv_keeps_na_text(spark):
    path = scratch_path(spark, "zones")
    zones_df(spark).coalesce(1).write.option("header", True).csv(path)
    z = files.read_zone_csv(spark, path)
    assert z.where(F.col("Borough") == "N/A").count() == 1
    assert dict(z.dtypes)["LocationID"] == "int"


def test_ingest_renames_adds_lineage_and_rejects_unknown_service(spark):
    raw = testdata.raw_trips(spark, SF_SMALL, "yellow")
    out = ingest(raw, "yellow", "ingest-1", datetime(2024, 5, 1))
    assert out.columns == raw_table_schema("yellow").fieldNames()
    r = out.first()
    assert r["service_type"] == "yellow" and r["run_id"] == "ingest-1"
    assert r["ingested_at_utc"] == datetime(2024, 5, 1)
    with pytest.raises(ValueError):
        rename_times(raw, "blue")
    with pytest.raises(ValueError):
        add_lineage(raw.drop("source_year"), "x", datetime(2024, 1, 1), "yellow")
    assert default_run_id("obt", datetime(2024, 1, 2, 3, 4, 5)) == "obt-20240102T030405Z"


def test_jdbc_options_need_bounds_for_parallel_reads():
    o = files.jdbc_options("jdbc:postgresql://h/db", "(SELECT 1) t", partition_column="id",
                           lower_bound=0, upper_bound=100, num_partitions=8, truncate=True)
    assert o["numPartitions"] == "8" and o["truncate"] == "true" and o["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        files.jdbc_options("u", "t", partition_column="id")


def test_monthly_scan_lists_only_the_specs_files(spark):
    root = scratch_path(spark, "landing2")
    rows = testdata.raw_trips(spark, SF_SMALL, "yellow").withColumn("service_type",
                                                                    F.lit("yellow"))
    files.write_monthly_files(rows, root)
    spec = PartitionSpec(1997, 1997, (5,), ("yellow",))
    scanned = files.read_monthly_files(spark, root, "yellow", spec)
    assert scanned.inputFiles() and all("yellow_tripdata_1997-05.parquet" in f
                                        for f in scanned.inputFiles())
    assert scanned.count() == rows.where(spec.predicate()).count()
    none = files.read_monthly_files(spark, root, "yellow", PartitionSpec(2030, 2030, (1,)))
    assert none.count() == 0 and "source_year" in none.columns


def test_files_are_grouped_by_the_types_in_their_footers(spark):
    """Months whose types change back and forth: few groups, every file in one, none opened by
    the driver; many small files are one listing and some jobs."""
    root = scratch_path(spark, "landing-types")
    base = spark.range(0, 600, 1, 1).selectExpr(
        "timestamp_ntz'2020-01-01 00:00:00' as lpep_pickup_datetime", "id as PULocationID",
        "cast(id % 40 as int) as n")
    for k, kind in enumerate(("int", "bigint", "double", "int")):
        name = "format_string('green_tripdata_%04d-%02d.parquet', 2000 + n div 12, 1 + n % 12)"
        (base.withColumn("PULocationID", F.col("PULocationID").cast(kind))
         .where(f"n div 10 = {k}").withColumn("f", F.expr(name)).drop("n")
         .write.mode("append").option("maxRecordsPerFile", 1).partitionBy("f").parquet(root))
    landed = files.landed_files(spark, root, "green")
    paths = [p for key in sorted(landed) for p in landed[key]]
    assert len(paths) == 600 and len(landed) == 40
    groups = files.schema_groups(spark, paths)
    assert sorted(map(len, groups)) == [150, 150, 300]
    out = files.read_monthly_files(spark, root, "green", landed=landed)
    assert out.count() == 600 and out.agg(F.sum("PULocationID")).first()[0] == sum(range(600))
