"""DuckDB SQL that computes the same results as the registered Spark queries.

Written by hand, independently of the Spark code, over the pre-registered test tables.
``RAW`` puts the star schema into raw trip shape (both services), ``OBT`` builds the 39
columns; query texts start from these common table expressions.

Engine differences handled here: DuckDB's ``dayofweek`` is 0 = Sunday (add 1); casting a
double to an integer rounds in DuckDB and truncates in Spark (``trunc`` first); decimal
literals are cast to DOUBLE so the arithmetic matches Spark's double arithmetic step by step.
"""

from __future__ import annotations

LINES = """
lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus, l.l_shipdate, o.o_orderdate, o.o_orderpriority,
         c.c_nationkey, s.s_nationkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

RAW = LINES + """,
raw AS (
  SELECT
    o_orderdate AS pickup_datetime,
    l_shipdate AS dropoff_datetime,
    CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 WHEN 'N' THEN 3 END AS BIGINT) AS VendorID,
    'N' AS store_and_fwd_flag,
    CAST(l_linenumber AS DOUBLE) AS RatecodeID,
    CAST(c_nationkey AS INTEGER) AS PULocationID,
    CAST(s_nationkey AS INTEGER) AS DOLocationID,
    CAST(CAST(trunc(l_quantity) AS INTEGER) % 8 AS DOUBLE) AS passenger_count,
    l_quantity AS trip_distance,
    l_extendedprice / 200.0::DOUBLE AS fare_amount,
    0.5::DOUBLE AS extra,
    l_extendedprice / 200.0::DOUBLE * l_tax + 0.0::DOUBLE AS mta_tax,
    l_extendedprice / 200.0::DOUBLE * l_discount + 0.0::DOUBLE AS tip_amount,
    0.0::DOUBLE AS tolls_amount,
    0.3::DOUBLE AS improvement_surcharge,
    l_extendedprice / 200.0::DOUBLE * (1 + l_discount + l_tax) AS total_amount,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
    2.5::DOUBLE AS congestion_surcharge,
    CASE WHEN l_linestatus = 'O' THEN 1.25::DOUBLE END AS airport_fee,
    CASE WHEN l_linestatus <> 'O' THEN CAST(l_linenumber % 2 + 1 AS DOUBLE) END AS trip_type,
    CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS service_type,
    CAST(year(o_orderdate) AS INTEGER) AS source_year,
    CAST(month(o_orderdate) AS INTEGER) AS source_month,
    TIMESTAMP '2024-01-01 00:00:00' AS ingested_at_utc,
    'ingest-20240101T000000Z' AS run_id
  FROM lines
)"""

ZONES = """
zones AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS locationid, r.r_name AS borough, n.n_name AS zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

DERIVED = RAW + "," + ZONES + """,
valid AS (
  SELECT *,
    (floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60.0::DOUBLE AS dur
  FROM raw
  WHERE dropoff_datetime >= pickup_datetime
)"""

OBT_SELECT = """
  SELECT
    v.pickup_datetime,
    v.dropoff_datetime,
    CAST(hour(v.pickup_datetime) AS SMALLINT) AS pickup_hour,
    CAST(dayofweek(v.pickup_datetime) + 1 AS SMALLINT) AS pickup_dow,
    CAST(v.source_month AS SMALLINT) AS month,
    CAST(v.source_year AS SMALLINT) AS year,
    v.PULocationID AS pu_location_id,
    pz.zone AS pu_zone,
    pz.borough AS pu_borough,
    v.DOLocationID AS do_location_id,
    dz.zone AS do_zone,
    dz.borough AS do_borough,
    v.service_type,
    TRY_CAST(v.VendorID AS INTEGER) AS vendor_id,
    CASE WHEN v.VendorID = 1 THEN 'Creative Mobile Technologies'
         WHEN v.VendorID = 2 THEN 'VeriFone Inc' ELSE 'Other' END AS vendor_name,
    TRY_CAST(trunc(v.RatecodeID) AS INTEGER) AS rate_code_id,
    CASE WHEN v.RatecodeID = 1 THEN 'Standard rate'
         WHEN v.RatecodeID = 2 THEN 'JFK'
         WHEN v.RatecodeID = 3 THEN 'Newark'
         WHEN v.RatecodeID = 4 THEN 'Nassau or Westchester'
         WHEN v.RatecodeID = 5 THEN 'Negotiated fare'
         WHEN v.RatecodeID = 6 THEN 'Group ride' ELSE 'Other' END AS rate_code_desc,
    TRY_CAST(v.payment_type AS INTEGER) AS payment_type,
    CASE WHEN TRY_CAST(v.payment_type AS INTEGER) = 1 THEN 'Credit card'
         WHEN TRY_CAST(v.payment_type AS INTEGER) = 2 THEN 'Cash'
         WHEN TRY_CAST(v.payment_type AS INTEGER) = 3 THEN 'No charge'
         WHEN TRY_CAST(v.payment_type AS INTEGER) = 4 THEN 'Dispute'
         WHEN TRY_CAST(v.payment_type AS INTEGER) = 5 THEN 'Unknown'
         WHEN TRY_CAST(v.payment_type AS INTEGER) = 6 THEN 'Voided trip'
         ELSE 'Other' END AS payment_type_desc,
    TRY_CAST(trunc(v.trip_type) AS INTEGER) AS trip_type,
    TRY_CAST(trunc(v.passenger_count) AS INTEGER) AS passenger_count,
    v.trip_distance,
    v.fare_amount,
    v.extra,
    v.mta_tax,
    v.tip_amount,
    v.tolls_amount,
    v.improvement_surcharge,
    v.congestion_surcharge,
    v.airport_fee,
    v.total_amount,
    v.store_and_fwd_flag,
    v.dur AS trip_duration_min,
    CASE WHEN v.trip_distance > 0 AND v.dur > 0
         THEN v.trip_distance / (v.dur / 60.0::DOUBLE) END AS avg_speed_mph,
    CASE WHEN v.fare_amount > 0
         THEN (v.tip_amount / v.fare_amount) * 100.0::DOUBLE END AS tip_pct,
    'obt-20240101T000000Z' AS run_id,
    v.source_year,
    v.source_month,
    v.ingested_at_utc
  FROM valid v
  LEFT JOIN zones pz ON v.PULocationID = pz.locationid
  LEFT JOIN zones dz ON v.DOLocationID = dz.locationid"""

# Common table expressions ending in ``obt`` (the 39 columns).
OBT = DERIVED + """,
obt AS (""" + OBT_SELECT + """
)"""


def with_obt(body: str) -> str:
    return "WITH " + OBT + "\n" + body


def with_raw(body: str) -> str:
    return "WITH " + RAW + "\n" + body
