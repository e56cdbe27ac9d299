"""Declared schemas: raw monthly trip files per service, the zone lookup, and the 39-column OBT.

Raw files drift from month to month (int vs long vs double codes, ``Airport_fee`` vs
``airport_fee``); every read goes through :func:`align` so that the rest of the library sees
one schema per service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SERVICES = ("yellow", "green")
PARTITION_KEYS = ("service_type", "source_year", "source_month")

# Per-service pickup/dropoff column names in the monthly files (fixed values).
SERVICE_TIME_COLUMNS = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
}

# Column names of the monthly trip files (types are our declaration).
_COMMON_RAW = [
    ("VendorID", T.LongType()),
    ("store_and_fwd_flag", T.StringType()),
    ("RatecodeID", T.DoubleType()),
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("payment_type", T.LongType()),
    ("congestion_surcharge", T.DoubleType()),
]


def raw_file_schema(service: str, with_keys: bool = False) -> T.StructType:
    """Schema of one monthly file of ``service`` as stored on disk; ``with_keys`` appends the
    file keys ``source_year`` / ``source_month`` (taken from the file name at read time)."""
    if service not in SERVICE_TIME_COLUMNS:
        raise ValueError(f"unknown service {service!r}; expected one of {SERVICES}")
    pickup, dropoff = SERVICE_TIME_COLUMNS[service]
    fields = [T.StructField(pickup, T.TimestampNTZType()),
              T.StructField(dropoff, T.TimestampNTZType())]
    fields += [T.StructField(n, t) for n, t in _COMMON_RAW]
    if service == "yellow":
        fields.append(T.StructField("airport_fee", T.DoubleType()))
    else:
        fields.append(T.StructField("trip_type", T.DoubleType()))
    if with_keys:
        fields += [T.StructField("source_year", T.IntegerType()),
                   T.StructField("source_month", T.IntegerType())]
    return T.StructType(fields)


LINEAGE_FIELDS = [
    T.StructField("service_type", T.StringType()),
    T.StructField("source_year", T.IntegerType()),
    T.StructField("source_month", T.IntegerType()),
    T.StructField("ingested_at_utc", T.TimestampNTZType()),
    T.StructField("run_id", T.StringType()),
]


def raw_table_schema(service: str) -> T.StructType:
    """Schema of ``raw.<service>_taxi_trip`` after ingest: renamed times plus lineage."""
    fields = []
    for f in raw_file_schema(service).fields:
        name = f.name
        if name in SERVICE_TIME_COLUMNS[service]:
            name = "pickup_datetime" if name.endswith("pickup_datetime") else "dropoff_datetime"
        fields.append(T.StructField(name, f.dataType))
    return T.StructType(fields + LINEAGE_FIELDS)


ZONE_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

# The 39 OBT columns, names and order as the analytic table defines them.
OBT_SCHEMA = T.StructType([
    # time
    T.StructField("pickup_datetime", T.TimestampNTZType()),
    T.StructField("dropoff_datetime", T.TimestampNTZType()),
    T.StructField("pickup_hour", T.ShortType()),
    T.StructField("pickup_dow", T.ShortType()),
    T.StructField("month", T.ShortType()),
    T.StructField("year", T.ShortType()),
    # location
    T.StructField("pu_location_id", T.IntegerType()),
    T.StructField("pu_zone", T.StringType()),
    T.StructField("pu_borough", T.StringType()),
    T.StructField("do_location_id", T.IntegerType()),
    T.StructField("do_zone", T.StringType()),
    T.StructField("do_borough", T.StringType()),
    # codes
    T.StructField("service_type", T.StringType()),
    T.StructField("vendor_id", T.IntegerType()),
    T.StructField("vendor_name", T.StringType()),
    T.StructField("rate_code_id", T.IntegerType()),
    T.StructField("rate_code_desc", T.StringType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("payment_type_desc", T.StringType()),
    T.StructField("trip_type", T.IntegerType()),
    # trip and money
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    # derived
    T.StructField("trip_duration_min", T.DoubleType()),
    T.StructField("avg_speed_mph", T.DoubleType()),
    T.StructField("tip_pct", T.DoubleType()),
    # lineage
    T.StructField("run_id", T.StringType()),
    T.StructField("source_year", T.IntegerType()),
    T.StructField("source_month", T.IntegerType()),
    T.StructField("ingested_at_utc", T.TimestampNTZType()),
])

OBT_COLUMNS = [f.name for f in OBT_SCHEMA.fields]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def align(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: match names case-insensitively, cast each column to its
    declared type (``try_cast``: values that do not fit become NULL instead of failing the
    job), and fill columns the input lacks with a typed NULL.

    With ``strict`` an input column that is missing raises instead of becoming NULL.
    Extra input columns are dropped. One projection, written as SQL expressions so that
    building it costs one call into the JVM; Catalyst prunes what is not used.
    """
    current_schema = df.schema  # one round trip; the loop below must not re-analyse the plan
    by_lower = {f.name.lower(): f for f in current_schema.fields}
    exprs = []
    for field in schema.fields:
        found = by_lower.get(field.name.lower())
        target = field.dataType.simpleString()
        if found is None:
            if strict:
                raise ValueError(f"column {field.name!r} missing from input "
                                 f"{current_schema.fieldNames()}")
            exprs.append(f"CAST(NULL AS {target}) AS {_q(field.name)}")
        elif found.dataType == field.dataType:
            exprs.append(f"{_q(found.name)} AS {_q(field.name)}")
        else:
            exprs.append(f"try_cast({_q(found.name)} AS {target}) AS {_q(field.name)}")
    return df.selectExpr(*exprs)
