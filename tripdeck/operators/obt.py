"""One big table: raw trips of both services → 39 decoded, derived, zone-joined columns.

Plan shape (checked with ``explain``): partition-pruned scan with the duration predicate pushed
down → one projection (codegen) → two broadcast hash joins against the checked zone dimension
→ final projection. No shuffle: the build is a narrow transformation of the raw partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdeck.functions import codes, measures
from tripdeck.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, dimension_for_join, skew_join
from tripdeck.sources.schemas import OBT_SCHEMA, ZONE_SCHEMA, align


def union_services(*frames: DataFrame) -> DataFrame:
    """Raw tables of several services in one frame; columns one service lacks become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def valid_duration(df: DataFrame) -> DataFrame:
    """Keep ``dropoff >= pickup``; equal times stay, NULL times go."""
    return df.where(F.col("dropoff_datetime") >= F.col("pickup_datetime"))


def derive(df: DataFrame) -> DataFrame:
    """Time parts, code casts and decodes, duration, speed and tip percentage."""
    present = {c.lower() for c in df.columns}
    missing = {name: F.lit(None).cast(dtype)
               for name, dtype in (("trip_type", "double"), ("airport_fee", "double"))
               if name not in present}
    if missing:
        df = df.withColumns(missing)
    duration = measures.trip_duration_min("pickup_datetime", "dropoff_datetime")
    payment = measures.code_int("payment_type")
    return df.withColumns({
        "pickup_hour": measures.pickup_hour("pickup_datetime"),
        "pickup_dow": measures.pickup_dow("pickup_datetime"),
        "month": measures.key_part("source_month"),
        "year": measures.key_part("source_year"),
        "pu_location_id": measures.code_int("PULocationID"),
        "do_location_id": measures.code_int("DOLocationID"),
        "vendor_id": measures.code_int("VendorID"),
        "vendor_name": codes.vendor_name(F.col("VendorID")),
        "rate_code_id": measures.code_int("RatecodeID"),
        "rate_code_desc": codes.rate_code_desc(F.col("RatecodeID")),
        # payment is decoded from the already cast code
        "payment_type_desc": codes.payment_type_desc(payment),
        "payment_type": payment,
        "trip_type": measures.code_int("trip_type"),
        "passenger_count": measures.code_int("passenger_count"),
        "trip_duration_min": duration,
        "avg_speed_mph": measures.avg_speed_mph("trip_distance", duration),
        "tip_pct": measures.tip_pct("tip_amount", "fare_amount"),
    })


def zone_roles(zones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The zone dimension in its pickup and dropoff roles."""
    z = align(zones, ZONE_SCHEMA)
    return _roles(z)


def _roles(z: DataFrame) -> tuple[DataFrame, DataFrame]:
    pu = z.select(F.col("LocationID").alias("pu_location_id"), F.col("Zone").alias("pu_zone"),
                  F.col("Borough").alias("pu_borough"))
    do = z.select(F.col("LocationID").alias("do_location_id"), F.col("Zone").alias("do_zone"),
                  F.col("Borough").alias("do_borough"))
    return pu, do


def join_zones(df: DataFrame, zones: DataFrame,
               max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Left joins to the zone dimension on pickup and dropoff ids (unmatched → NULL names).

    One bounded read of the dimension serves both roles; a dimension above the bound is joined by
    key, its hot keys spread."""
    z, small = dimension_for_join(align(zones, ZONE_SCHEMA), "LocationID", max_broadcast_rows)
    pu, do = _roles(z)
    if small:
        return df.join(pu, "pu_location_id", "left").join(do, "do_location_id", "left")
    pu, do = (r.withColumnRenamed(k, f"_{k}") for r, k in ((pu, "pu_location_id"),
                                                           (do, "do_location_id")))
    return skew_join(skew_join(df, pu, "pu_location_id", "_pu_location_id"),
                     do, "do_location_id", "_do_location_id")


def obt_from_raw(raw: DataFrame, zones: DataFrame, run_id: str | None = None,
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Raw rows (pickup/dropoff already renamed, lineage present) → the 39 OBT columns."""
    df = derive(valid_duration(raw))
    if run_id is not None:
        df = df.withColumn("run_id", F.lit(run_id))
    df = join_zones(df, zones, max_broadcast_rows)
    return align(df, OBT_SCHEMA, strict=True)
