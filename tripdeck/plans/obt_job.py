"""The OBT builder job: spec → raw partitions → OBT → partition replace → run ledger.

One Spark job chain for the whole spec instead of a driver loop over (service, year, month):
the raw tables are read with the spec's partition predicate (directory pruning), the OBT is
derived and joined in one narrow stage, written with dynamic partition overwrite, and the
ledger comes from one grouped count of the stored partitions joined to the spec's manifest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripdeck.operators.ingest import default_run_id
from tripdeck.operators.obt import obt_from_raw, union_services
from tripdeck.operators.partitions import PartitionSpec, run_report, run_totals
from tripdeck.sinks import tables


@dataclass
class RunResult:
    run_id: str
    rows_written: int | None
    ledger: DataFrame
    totals: DataFrame
    report: DataFrame


def read_raw(spark: SparkSession, raw_tables: dict[str, str], spec: PartitionSpec) -> DataFrame:
    """The spec's partitions of every service's raw table, unioned by name."""
    frames = [spark.table(raw_tables[s]).where(spec.predicate()) for s in spec.services]
    return union_services(*frames)


def run(spark: SparkSession, raw: DataFrame, zones: DataFrame, obt_table: str,
        spec: PartitionSpec, run_id: str | None = None) -> RunResult:
    """Build and store the OBT for ``spec``; returns the run's ledger and totals."""
    run_id = run_id or default_run_id("obt")
    obt = obt_from_raw(raw.where(spec.predicate()), zones, run_id)
    obs = tables.write_obt(obt, obt_table, spec, run_id)
    rows = None
    if obs is not None:
        rows = int(obs.get.get("rows", 0))
    ledger = tables.post_write_ledger(spark, obt_table, spec)
    return RunResult(run_id, rows, ledger, run_totals(ledger), run_report(ledger))
