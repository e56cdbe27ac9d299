"""The ingest job: landed monthly files of a spec → raw tables, and the zone lookup → its table.

Per service one scan of the spec's files (keys from the file names), one projection (rename,
lineage, declared types) and one idempotent partition replace of ``raw.<service>_taxi_trip``.
Only months of which a file has landed are replaced: re-running a month replaces it, a file
without rows clears it, and a month without a file is left alone and reported as ``absent``. A
landing root that doesn't exist raises. No driver loop over months.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.operators.ingest import default_run_id, ingest
from tripdeck.operators.partitions import PartitionSet, PartitionSpec
from tripdeck.sinks import tables
from tripdeck.sources.files import landed_files, read_monthly_files, read_zone_csv


def run(spark: SparkSession, landing_root: str, raw_tables: dict[str, str], spec: PartitionSpec,
        run_id: str | None = None, ingested_at: datetime | None = None) -> DataFrame:
    """Ingest the spec's monthly files of every service; returns the raw-table ledger: rows per
    partition of the spec as stored, and its ``state`` in this run, ``landed`` or ``absent``."""
    run_id = run_id or default_run_id("ingest")
    at = ingested_at or datetime.now(timezone.utc)
    ledgers = []
    for service in spec.services:
        service_spec = PartitionSpec(spec.year_start, spec.year_end, spec.months, (service,))
        landed = landed_files(spark, landing_root, service, service_spec)
        found = PartitionSet(tuple(sorted(landed)))
        if landed:
            rows = ingest(read_monthly_files(spark, landing_root, service, landed=landed), service,
                          run_id, at)
            tables.replace_partitions(rows, raw_tables[service], found, run_id)
        elif not spark.catalog.tableExists(raw_tables[service]):
            empty = read_monthly_files(spark, landing_root, service, landed={})
            tables.append(ingest(empty, service, run_id, at), raw_tables[service])
        state = F.when(found.predicate(), "landed").otherwise("absent").alias("state")
        ledgers.append(tables.post_write_ledger(spark, raw_tables[service], service_spec)
                       .select("*", state))
    out = ledgers[0]
    for led in ledgers[1:]:
        out = out.unionByName(led)
    return out


def load_zones(spark: SparkSession, csv_path: str, table: str, run_id: str | None = None,
               ingested_at: datetime | None = None) -> DataFrame:
    """Zone lookup CSV → a small table replaced whole, with lineage columns."""
    run_id = run_id or default_run_id("zones")
    at = ingested_at or datetime.now(timezone.utc)
    at = at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at
    zones = read_zone_csv(spark, csv_path).withColumns(
        {"ingested_at_utc": F.lit(at).cast("timestamp_ntz"), "run_id": F.lit(run_id)})
    tables.overwrite(zones, table)
    return spark.table(table)
