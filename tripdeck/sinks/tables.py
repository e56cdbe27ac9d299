"""Table writes: append, overwrite, idempotent partition replace, truncate-and-reload,
post-write counts, round trip, and CSV export of small result tables.

Partitioned tables are catalog tables partitioned by ``(service_type, source_year,
source_month)``. Replacing partitions writes the new ones beside the table and moves them in by a
plan that a later run can finish, and partitions of the run's spec that the new data does not
contain are dropped by the same plan, so an empty source clears its partition as the delete in the
original workflow did. Tables are readable throughout; a reader may meet some partitions before and
some after their move.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripdeck.operators.partitions import PartitionSpec, ledger, partition_counts
from tripdeck.sources.schemas import PARTITION_KEYS

MAX_RECORDS_PER_FILE = 5_000_000


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    """Set a SQL conf for the duration of one write (``insertInto`` reads the overwrite mode
    from the session, not from writer options)."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
PLAN = "plan.json"
V1_SOURCES = "spark.sql.sources.useV1SourceList"
COUNT_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


def _writer(df: DataFrame, fmt: str = "parquet"):
    return df.write.format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def _table_order(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """``insertInto`` matches by position: select in the table's column order."""
    return df.select(*spark.table(table).columns)


def balanced(df: DataFrame, partition_keys=PARTITION_KEYS) -> DataFrame:
    """Rows brought together by table partition for the writers: a partition above the advisory
    size goes to several tasks, small ones share one (``REBALANCE``, decided at run time), so the
    number of files follows the data and not the tasks of the input."""
    return df.hint("rebalance", *[F.col(k) for k in partition_keys])


def append(df: DataFrame, table: str, partition_keys=PARTITION_KEYS) -> None:
    """Append rows; creates the table (partitioned) on first use. The input may have any
    partitioning: writers are balanced by table partition."""
    spark = df.sparkSession
    df = balanced(df, partition_keys)
    if spark.catalog.tableExists(table):
        _table_order(spark, table, df).write.insertInto(table, overwrite=False)
    else:
        _writer(df).partitionBy(*partition_keys).saveAsTable(table)


def overwrite(df: DataFrame, table: str, partition_keys=()) -> None:
    """Replace a whole (small) table."""
    w = _writer(df).mode("overwrite")
    if partition_keys:
        w = w.partitionBy(*partition_keys)
    w.saveAsTable(table)


def _partition_clause(row) -> str:
    parts = []
    for k in PARTITION_KEYS:
        v = row[k]
        parts.append(f"{k}='{v}'" if isinstance(v, str) else f"{k}={int(v)}")
    return "PARTITION (" + ", ".join(parts) + ")"


def drop_partitions(spark: SparkSession, table: str, rows) -> int:
    rows = list(rows)
    if rows:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS "
                  + ", ".join(_partition_clause(r) for r in rows))
    return len(rows)


def catalog_partitions(spark: SparkSession, table: str) -> list[tuple[str, int, int]]:
    """Partition keys the catalog holds for ``table`` (metadata only, no data read)."""
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        kv = dict(part.split("=", 1) for part in row[0].split("/"))
        out.append((unquote(kv["service_type"]), int(kv["source_year"]),
                    int(kv["source_month"])))
    return out


def _plan_path(spark: SparkSession, table: str):
    """The table's file system, and where a replace keeps its plan (a name that scans skip)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table_location(spark, table)}/_replace")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _partition_folder(key) -> str:
    return "/".join(f"{k}={v}" for k, v in zip(PARTITION_KEYS, key, strict=True))


def finish_replace(spark: SparkSession, table: str) -> bool:
    """Carry out the plan of a replace, this run's or one that a killed run left; False if there
    is none. Every step may be repeated: a staged partition is moved while it is there, partitions
    are added if missing and dropped if present, and the plan goes last."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, home = _plan_path(spark, table)
    plan_file = path(home, PLAN)
    if not fs.exists(plan_file):
        return False
    lines = spark.read.text(plan_file.toString()).collect()
    plan = json.loads("".join(r["value"] for r in lines))
    stage, root = path(home, plan["stage"]), home.getParent()
    for key in plan["set"]:
        staged, target = (path(p, _partition_folder(key)) for p in (stage, root))
        if fs.exists(staged):
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(staged, target):
                raise OSError(f"could not move {staged.toString()}")
    known = set(catalog_partitions(spark, table))
    rows = [dict(zip(PARTITION_KEYS, k, strict=True)) for k in plan["set"] if tuple(k) not in known]
    if rows:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS "
                  + " ".join(_partition_clause(r) for r in rows))
    drop_partitions(spark, table, [dict(zip(PARTITION_KEYS, k, strict=True)) for k in plan["drop"]])
    fs.delete(stage, True)
    fs.delete(plan_file, False)
    spark.catalog.refreshTable(table)
    return True


def replace_partitions(df: DataFrame, table: str, spec, run_id: str,
                       fail_outside: bool = False) -> Observation:
    """Idempotent replace of the spec's partitions with ``df``: all of them or, until the plan is
    written, none.

    1. The rows are written beside the table; the write itself observes their number and the set
       of partition keys (at most ``spec.size()``, merged as task metrics, no second pass).
    2. A plan is put in place by one rename: which staged partitions to move in, and which of the
       spec that the catalog holds received no rows and are dropped, so that an empty source
       clears its partition. A job killed before this leaves the table as it was.
    3. The plan is carried out (``finish_replace``). If the job is killed on the way, the next
       replace of the table, or a call of ``finish_replace``, completes it first.

    ``run_id`` is the lineage value the rows carry. Rows of ``df`` outside the spec are not
    written; they are counted, or with ``fail_outside`` fail the write. Runs that replace
    partitions of one table must not overlap. Returns the ``Observation`` (``rows``, ``outside``,
    ``partitions``).
    """
    spark = df.sparkSession
    obs = Observation(f"replace_{table.replace('.', '_')}_{run_id}")
    keys = F.struct(*[F.col(k) for k in PARTITION_KEYS])
    inside = F.coalesce(spec.predicate(), F.lit(False))
    if fail_outside:
        df = df.where(F.assert_true(inside, "a row lies outside the run's partitions").isNull())
    # the predicate is evaluated once a row; metrics and filter read its flag
    flag = F.col("_inside")
    observed = df.withColumn("_inside", inside).observe(
        obs, F.count_if(flag).alias("rows"), F.count_if(~flag).alias("outside"),
        F.collect_set(F.when(flag, keys)).alias("partitions")).where(flag).drop("_inside")
    if not spark.catalog.tableExists(table):
        _writer(observed).partitionBy(*PARTITION_KEYS).saveAsTable(table)
        return obs
    finish_replace(spark, table)
    fs, home = _plan_path(spark, table)
    path = spark._jvm.org.apache.hadoop.fs.Path
    stage = uuid.uuid4().hex
    typed = observed.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(table).schema])
    _writer(typed).partitionBy(*PARTITION_KEYS).save(path(home, stage).toString())
    written = sorted((r[0], int(r[1]), int(r[2])) for r in obs.get["partitions"])
    stale = [k for k in catalog_partitions(spark, table)
             if spec.contains(k) and k not in set(written)]
    plan = json.dumps({"stage": stage, "run_id": run_id, "set": written, "drop": stale})
    draft = path(home, f"draft-{stage}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(plan.encode()))
    finally:
        out.close()
    if not fs.rename(draft, path(home, PLAN)):
        raise OSError(f"another replace of {table} is under way")
    finish_replace(spark, table)
    return obs


def truncate_reload(df: DataFrame, table: str) -> None:
    """Replace the whole table's content in one overwrite (static mode)."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        with session_conf(spark, OVERWRITE_MODE, "static"):
            _table_order(spark, table, df).write.insertInto(table, overwrite=True)
    else:
        _writer(df).partitionBy(*PARTITION_KEYS).saveAsTable(table)


def write_obt(df: DataFrame, table: str, spec: PartitionSpec, run_id: str) -> Observation | None:
    """The builder's write: full reload when the spec says overwrite, else partition replace."""
    if spec.overwrite:
        truncate_reload(df.where(spec.predicate()), table)
        return None
    return replace_partitions(df, table, spec, run_id)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def stored_counts(spark: SparkSession, table: str, spec: PartitionSpec) -> DataFrame:
    """Rows per stored partition of the spec from the footers of its Parquet files: the count is
    pushed into the scan, no row group is read. At most ``spec.size()`` rows."""
    with (session_conf(spark, V1_SOURCES, "avro,csv,json,kafka,orc,text"),
          session_conf(spark, COUNT_PUSHDOWN, "true")):
        counts = partition_counts(spark.read.schema(spark.table(table).schema)
                                  .parquet(table_location(spark, table)).where(spec.predicate()))
        rows = counts.collect()     # planned and run while the settings hold
    return spark.createDataFrame(rows, counts.schema)


def post_write_ledger(spark: SparkSession, table: str, spec: PartitionSpec) -> DataFrame:
    """Rows per partition of the spec as stored, 0 for partitions without rows; from metadata."""
    return ledger(spec.manifest(spark), stored_counts(spark, table, spec))


def round_trip(df: DataFrame, path: str, order_by: str) -> DataFrame:
    """Write, read back, order: the read-back frame."""
    _writer(df).mode("overwrite").save(path)
    return df.sparkSession.read.parquet(path).orderBy(order_by)


def export_csv(df: DataFrame, path: str, files: int | None = 1, max_rows: int = 100_000) -> None:
    """A result table (leaderboards, coefficients) as CSV with header, in ``files`` files (None:
    one per partition of ``df``). The form never depends on the size: a table of more than
    ``max_rows`` rows in one file raises, as one task would have to write it."""
    if files == 1 and df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows in one file: state a number of files")
    if files is not None:
        df = df.coalesce(1) if files == 1 else df.repartition(files)
    df.write.mode("overwrite").option("header", True).csv(path)


def write_jdbc(df: DataFrame, mode: str = "append", **jdbc_kwargs) -> None:
    """Write through JDBC (batched inserts; ``truncate=True`` with ``mode="overwrite"`` keeps
    the target table and empties it, as a full reload does). Writers = partitions of ``df``:
    cap them with ``num_partitions`` rather than a coalesce of the data."""
    from tripdeck.sources.files import jdbc_options
    df.write.format("jdbc").options(**jdbc_options(**jdbc_kwargs)).mode(mode).save()
