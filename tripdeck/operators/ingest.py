"""Ingest: monthly file rows → raw table rows (rename per service, lineage columns)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdeck.sources.schemas import SERVICE_TIME_COLUMNS, _q, raw_table_schema


def default_run_id(prefix: str, now: datetime | None = None) -> str:
    """``<prefix>-YYYYMMDDTHHMMSSZ`` from the UTC clock (ingest-, zones-, obt- runs)."""
    now = now or datetime.now(timezone.utc)
    return f"{prefix}-{now.strftime('%Y%m%dT%H%M%SZ')}"


def rename_times(df: DataFrame, service: str) -> DataFrame:
    """``tpep_*`` / ``lpep_*`` → ``pickup_datetime`` / ``dropoff_datetime``."""
    if service not in SERVICE_TIME_COLUMNS:
        raise ValueError(f"unsupported service {service!r}")
    pickup, dropoff = SERVICE_TIME_COLUMNS[service]
    return df.withColumnsRenamed({pickup: "pickup_datetime", dropoff: "dropoff_datetime"})


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def add_lineage(df: DataFrame, run_id: str | Column, ingested_at: datetime | Column,
                service: str | Column | None = None, year: int | Column | None = None,
                month: int | Column | None = None) -> DataFrame:
    """Add ``service_type, source_year, source_month, ingested_at_utc, run_id``.

    Keys given as ``None`` must already be columns of ``df`` (for instance parsed from the
    file path by the scan), so a multi-file read gets per-row keys in the same projection.
    ``ingested_at`` is a UTC wall-clock time stored as TIMESTAMP_NTZ.
    """
    if isinstance(ingested_at, datetime) and ingested_at.tzinfo is not None:
        ingested_at = ingested_at.astimezone(timezone.utc).replace(tzinfo=None)
    cols = {"ingested_at_utc": _value(ingested_at).cast("timestamp_ntz"),
            "run_id": _value(run_id).cast("string")}
    for name, v, dtype in (("service_type", service, "string"), ("source_year", year, "int"),
                           ("source_month", month, "int")):
        if v is not None:
            cols[name] = _value(v).cast(dtype)
        elif name not in df.columns:
            raise ValueError(f"lineage key {name!r} neither given nor present")
    return df.withColumns(cols)


def ingest(df: DataFrame, service: str, run_id: str, ingested_at: datetime,
           year: int | None = None, month: int | None = None,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """File rows of one service → raw-table rows with the declared raw schema (plus the
    ``keep`` columns, e.g. ``source_path``): rename, lineage and casts in one projection."""
    if service not in SERVICE_TIME_COLUMNS:
        raise ValueError(f"unsupported service {service!r}")
    pickup, dropoff = SERVICE_TIME_COLUMNS[service]
    if isinstance(ingested_at, datetime) and ingested_at.tzinfo is not None:
        ingested_at = ingested_at.astimezone(timezone.utc).replace(tzinfo=None)
    given = {"service_type": service, "source_year": year, "source_month": month,
             "ingested_at_utc": ingested_at, "run_id": run_id}
    fields = {f.name.lower(): f for f in df.schema.fields}
    renamed = {"pickup_datetime": pickup.lower(), "dropoff_datetime": dropoff.lower()}
    target = raw_table_schema(service)
    if keep:
        target = T.StructType(target.fields + [fields[c.lower()] for c in keep])
    exprs = []
    for f in target.fields:
        t = f.dataType.simpleString()
        v = given.get(f.name)
        if v is not None:
            lit = (f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'" if isinstance(v, datetime)
                   else _sql_string(v) if isinstance(v, str) else str(int(v)))
            exprs.append(f"CAST({lit} AS {t}) AS {_q(f.name)}")
            continue
        src = fields.get(renamed.get(f.name, f.name.lower()))
        if src is None:
            if f.name in given:
                raise ValueError(f"lineage key {f.name!r} neither given nor present")
            exprs.append(f"CAST(NULL AS {t}) AS {_q(f.name)}")
        elif src.dataType == f.dataType:
            exprs.append(f"{_q(src.name)} AS {_q(f.name)}")
        else:
            exprs.append(f"try_cast({_q(src.name)} AS {t}) AS {_q(f.name)}")
    return df.selectExpr(*exprs)


def _sql_string(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_run_id(df: DataFrame, run_id: str) -> DataFrame:
    """The builder's run id replaces the one carried from ingest."""
    return df.withColumn("run_id", F.lit(run_id))
