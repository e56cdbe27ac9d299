"""Incremental OBT build from a landing folder of monthly trip files (Structured Streaming).

The file source tells which ``<service>_tripdata_YYYY-MM.parquet`` files are new. For each
partition that a micro-batch touches, all landed files of that month are read again, ingested
(rename, lineage), built into OBT rows and written with the idempotent partition replace of the
batch builder. A month that arrives in several files, over any number of batches, so ends with
the rows of all of them, and a batch that is run again after a failure rewrites the same
partitions. Progress lives in the checkpoint below the shared ``spark.checkpoint.dir``.
``availableNow`` processes the backlog and stops.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripdeck.operators.ingest import ingest
from tripdeck.operators.obt import obt_from_raw
from tripdeck.operators.partitions import PartitionSet
from tripdeck.session import scratch_path
from tripdeck.sinks import tables
from tripdeck.sources.files import keys_from_path, read_monthly_files
from tripdeck.sources.schemas import raw_file_schema


def monthly_file_stream(spark: SparkSession, landing_root: str, service: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming path of every row of the newly landed files (of any service)."""
    reader = (spark.readStream.schema(raw_file_schema(service))
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # only paths are used: no column is read, so types that drift don't matter
    return reader.parquet(landing_root).select(F.col("_metadata.file_path").alias("path"))


def touched_partitions(batch: DataFrame, service: str) -> PartitionSet:
    """The partitions of ``service`` that a batch of paths touches; a path is parsed once."""
    keyed = batch.select("path").distinct().withColumns(keys_from_path(F.col("path")))
    return PartitionSet.of(keyed.where(F.col("service_type") == service))


def start(spark: SparkSession, landing_root: str, service: str, zones: DataFrame,
          obt_table: str, checkpoint: str | None = None, run_prefix: str = "obt-stream",
          available_now: bool = True, ingested_at: datetime | None = None,
          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental build of one service; returns the running query."""
    checkpoint = checkpoint or scratch_path(spark, f"stream-{service}")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{run_prefix}-{batch_id}"
        at = ingested_at or datetime.now(timezone.utc)
        touched = touched_partitions(batch, service)
        if touched.size():
            rows = read_monthly_files(spark, landing_root, service, touched)
            raw = ingest(rows, service, run_id, at)
            tables.replace_partitions(obt_from_raw(raw, zones, run_id), obt_table, touched, run_id)

    writer = (monthly_file_stream(spark, landing_root, service, max_files_per_trigger).writeStream
              .foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint)
              .queryName(f"obt_{service}_{abs(hash(checkpoint)) % 10**8}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
