"""Scalar expressions: decodes, time parts, casts, duration, speed, tip percentage."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripdeck.functions import codes, measures


def test_decodes_null_and_unknown_are_other(spark):
    df = spark.createDataFrame([(1,), (2,), (6,), (7,), (None,)], "c long")
    out = df.select("c", codes.vendor_name(F.col("c")).alias("v"),
                    codes.rate_code_desc(F.col("c")).alias("r"),
                    codes.payment_type_desc(F.col("c")).alias("p")).collect()
    got = {r["c"]: (r["v"], r["r"], r["p"]) for r in out}
    assert got[1] == ("Creative Mobile Technologies", "Standard rate", "Credit card")
    assert got[2] == ("VeriFone Inc", "JFK", "Cash")
    assert got[6] == ("Other", "Group ride", "Voided trip")
    assert got[7] == ("Other", "Other", "Other")
    assert got[None] == ("Other", "Other", "Other")


def test_time_parts_sunday_is_one(spark):
    # 2024-01-07 was a Sunday, 2024-01-13 a Saturday
    df = spark.createDataFrame([(datetime(2024, 1, 7, 23, 59, 59),),
                                (datetime(2024, 1, 13, 0, 0, 1),)], "ts timestamp_ntz")
    r = df.select(measures.pickup_hour("ts").alias("h"), measures.pickup_dow("ts").alias("d"))
    rows = r.collect()
    assert [(x["h"], x["d"]) for x in rows] == [(23, 1), (0, 7)]
    assert dict(r.dtypes) == {"h": "smallint", "d": "smallint"}


def test_code_int_truncates_and_nulls_misfits(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (1e12,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(measures.code_int("x")).collect()]
    assert got == [2, -2, None, None, None]


def test_duration_drops_fractions_first(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 1, 0, 100000))],
        "p timestamp_ntz, d timestamp_ntz")
    # whole seconds 0 → 60: exactly one minute although only 59.2 s elapsed
    assert df.select(measures.trip_duration_min("p", "d")).first()[0] == pytest.approx(1.0)


def test_speed_and_tip_guards(spark):
    df = spark.createDataFrame([(3.0, 30.0, 2.0, 10.0), (3.0, 0.0, 2.0, 0.0),
                                (0.0, 10.0, 1.0, -5.0)],
                               "dist double, mins double, tip double, fare double")
    rows = df.select(measures.avg_speed_mph("dist", "mins").alias("s"),
                     measures.tip_pct("tip", "fare").alias("t")).collect()
    assert rows[0]["s"] == pytest.approx(6.0) and rows[0]["t"] == pytest.approx(20.0)
    assert rows[1]["s"] is None and rows[1]["t"] is None      # zero duration, zero fare
    assert rows[2]["s"] is None and rows[2]["t"] is None      # zero distance, negative fare
