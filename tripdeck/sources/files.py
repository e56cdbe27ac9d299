"""Readers: monthly trip files, the zone CSV, partitioned tables, the analytic read, JDBC.

Monthly files follow ``<service>_tripdata_YYYY-MM.parquet``. All files of a run that state the
same types are read in one scan; the keys of each row come from its file path
(``_metadata.file_path``), so there is no Spark job per month or file.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdeck.sources.schemas import PARTITION_KEYS, ZONE_SCHEMA, align, raw_file_schema

# The monthly file name rule and the pattern that reads it back.
FILE_TEMPLATE = "{service}_tripdata_{year:04d}-{month:02d}.parquet"
MONTH_MARK = "_tripdata_"
FILE_PATTERN = r"(yellow|green)_tripdata_(\d{4})-(\d{2})\.parquet"


def monthly_file_name(service: str, year: int, month: int) -> str:
    return FILE_TEMPLATE.format(service=service, year=year, month=month)


def file_name_column(service: Column, year: Column, month: Column) -> Column:
    """The monthly file name as a column (used to lay out files with one partitioned write)."""
    return F.format_string("%s_tripdata_%04d-%02d.parquet", service, year, month)


def keys_from_path(path: Column) -> dict[str, Column]:
    """The partition keys that a path names (an empty service and null numbers if none): the
    pattern is searched once a row, the keys are cut from the name it finds."""
    name = F.regexp_extract(path, FILE_PATTERN, 0)
    return {"service_type": F.substring_index(name, "_", 1),
            "source_year": F.substring(name, -15, 4).try_cast("int"),
            "source_month": F.substring(name, -10, 2).try_cast("int")}


def keys_of_paths(path: Column, service: str, paths: list[str]) -> dict[str, Column]:
    """The keys of rows of ``paths``, files of one service, by their path column. Where the last
    ``_tripdata_`` of every path stands before its month, the month is cut there; a search by
    pattern costs more than all else that a row of a narrow scan needs."""
    plain = all((m := re.search(FILE_PATTERN, p)) and p.rsplit(MONTH_MARK, 1)[1].startswith(
        f"{m[2]}-{m[3]}.parquet") for p in paths)
    if not plain:
        return keys_from_path(path)
    month = F.substring_index(path, MONTH_MARK, -1)
    return {"service_type": F.lit(service),
            "source_year": F.substring(month, 1, 4).try_cast("int"),
            "source_month": F.substring(month, 6, 2).try_cast("int")}


def landed_files(spark: SparkSession, root: str, service: str, spec=None
                 ) -> dict[tuple[str, int, int], list[str]]:
    """The monthly files of ``service`` below ``root``, at any depth: paths per partition key.

    Only names are listed (one listing, no file is opened). A month may be one file or a folder of
    part files, and several of either. A ``root`` that does not exist raises; a month without a
    file has no entry, which is not the same as a file without rows.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").load(root).select("path"))
    keyed = listed.withColumns(keys_from_path(F.col("path"))).where(F.col("service_type") == service)
    if spec is not None:
        keyed = keyed.where(spec.predicate())
    found: dict[tuple[str, int, int], list[str]] = {}
    for r in keyed.orderBy("path").collect():
        key = (r["service_type"], r["source_year"], r["source_month"])
        found.setdefault(key, []).append(r["path"])
    return found


def stated_schema(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The schema that the footers of all ``paths`` state, or None where they differ in a type.
    Footers are read by tasks of one Spark job, none by the driver."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        return None


def schema_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """``paths`` in groups whose footers state the same types, by halving what does not agree.

    Types drift between releases, so in the order of time files with the same types stand
    together: with k changes among n files about k log n jobs read all footers, in parallel. A part
    that does not agree shows as a failed job in the log, which is expected."""
    groups: dict[str, list[str]] = {}

    def divide(part: list[str]) -> None:
        schema = stated_schema(spark, part)
        if schema is None:
            divide(part[:len(part) // 2])
            divide(part[len(part) // 2:])
        else:
            groups.setdefault(schema.json(), []).extend(part)
    if paths:
        divide(paths)
    return list(groups.values())


def read_monthly_files(spark: SparkSession, root: str, service: str, spec=None,
                       with_source_path: bool = False, landed=None) -> DataFrame:
    """All monthly files of ``service`` below ``root`` (of ``spec``, if given) in the declared
    schema, with ``service_type, source_year, source_month`` (and ``source_path``) from the path.

    Column types drift between months. Files are grouped by the types in their footers
    (``schema_groups``), each of the few groups is one scan with its own types, aligned to the
    declared ones. A root that
    doesn't exist raises; a spec without any file gives no rows. ``landed`` may pass a listing
    that ``landed_files`` gave.
    """
    landed = landed_files(spark, root, service, spec) if landed is None else landed
    out = None
    for paths in schema_groups(spark, [p for key in sorted(landed) for p in landed[key]]):
        df = spark.read.option("mergeSchema", "true").parquet(*paths)
        path = F.col("_metadata.file_path")
        keys = {**keys_of_paths(path, service, paths), **({"source_path": path} if with_source_path else {})}
        df = df.withColumns(keys)
        target = T.StructType([*raw_file_schema(service).fields,
                               *[f for f in df.schema.fields if f.name in keys]])
        df = align(df, target)
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], raw_file_schema(service, with_keys=True)).withColumns(
            {"service_type": F.lit(service),
             **({"source_path": F.lit(None).cast("string")} if with_source_path else {})})
    return out


def write_monthly_files(df: DataFrame, root: str, mode: str = "append") -> None:
    """Lay out rows (with file keys) as monthly files in one distributed write: each
    ``<service>_tripdata_YYYY-MM.parquet`` becomes a directory holding that month's file.

    Rows are brought together by file name first (``REBALANCE``, decided at run time): each task
    writes one or a few months or a part of one, so a month is a handful of part files, and a
    month too large for one task is split instead of landing in a single task. Unlike ranges
    this needs no sample, for which the rows would be made a second time."""
    name = file_name_column(F.col("service_type"), F.col("source_year"), F.col("source_month"))
    named = df.withColumn("monthly_file", name).drop(*PARTITION_KEYS)
    (named.hint("rebalance", F.col("monthly_file"))
     .write.mode(mode).partitionBy("monthly_file").parquet(root))


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with header and a declared schema; the text ``N/A`` stays text."""
    return align(spark.read.option("header", True).option("nullValue", "")
                 .schema(ZONE_SCHEMA).csv(path), ZONE_SCHEMA)


ANALYTIC_COLUMNS = ("pickup_hour", "pickup_dow", "month", "year", "trip_distance",
                    "passenger_count", "service_type", "pu_borough", "do_borough", "total_amount")


def analytic_read(obt: DataFrame, year_start: int, year_end: int,
                  sample_fraction: float | None = None, seed: int = 42,
                  key_cols: list[str] | None = None) -> DataFrame:
    """The regression input: a year range of the OBT, an optional reproducible Bernoulli sample
    (hash threshold), and the 10 analytic columns."""
    from tripdeck.operators.features import hash_sample
    df = obt.where(F.col("source_year").between(year_start, year_end))
    if sample_fraction is not None and sample_fraction < 1.0:
        df = hash_sample(df, sample_fraction, seed, key_cols)
    return df.select(*ANALYTIC_COLUMNS)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 fetch_size: int = 10_000, batch_size: int = 10_000,
                 partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 truncate: bool | None = None) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")`` / ``df.write.format("jdbc")``.

    ``table`` may be a sub-query ``(SELECT ...) t``. Give ``partition_column`` with bounds to
    read in parallel; without it a JDBC read is one task, which does not scale.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size),
            "batchsize": str(batch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound, num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    elif num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    if truncate is not None:
        opts["truncate"] = "true" if truncate else "false"
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
