"""Small hand-made inputs for unit tests (the rules of the OBT need rows the test tables lack)."""

from __future__ import annotations

from datetime import datetime

from tripdeck.sources.schemas import raw_table_schema

BASE = {
    "pickup_datetime": datetime(2020, 3, 1, 8, 0, 0),
    "dropoff_datetime": datetime(2020, 3, 1, 8, 30, 0),
    "VendorID": 1, "store_and_fwd_flag": "N", "RatecodeID": 1.0, "PULocationID": 1,
    "DOLocationID": 2, "passenger_count": 1.0, "trip_distance": 5.0, "fare_amount": 20.0,
    "extra": 0.5, "mta_tax": 0.5, "tip_amount": 4.0, "tolls_amount": 0.0,
    "improvement_surcharge": 0.3, "total_amount": 25.3, "payment_type": 1,
    "congestion_surcharge": 2.5, "airport_fee": 0.0, "trip_type": 1.0,
    "service_type": "yellow", "source_year": 2020, "source_month": 3,
    "ingested_at_utc": datetime(2024, 1, 1), "run_id": "ingest-test",
}


def raw_rows(spark, service: str, rows: list[dict]):
    schema = raw_table_schema(service)
    data = []
    for r in rows:
        full = {**BASE, "service_type": service, **r}
        data.append(tuple(full.get(f.name) for f in schema.fields))
    return spark.createDataFrame(data, schema)


def zones_df(spark, rows=None):
    rows = rows or [(1, "Manhattan", "Alphabet City", "Yellow Zone"),
                    (2, "Queens", "Astoria", "Boro Zone"),
                    (3, "N/A", "NV", "N/A")]
    return spark.createDataFrame(rows, "LocationID int, Borough string, Zone string, "
                                       "service_zone string")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
